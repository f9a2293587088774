"""Column functions on cells, titles, sections and chunk ids. Built-in expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it, and the four information separators.
SPACE = r"[\s\x1c-\x1f]"

# Words that stand for an empty cell.
EMPTY_WORDS = ["", "-", "–", "N/A", "해당없음", "해당사항없음", "해당 없음"]
NUMBER = r"^-?\d{1,3}(,\d{3})*(\.\d+)?$"
CORRECTION = "[기재정정]"


#: Words of plain characters with single spaces between them, or nothing: what no cleaning changes. Most texts are so, and one
#: match, which never steps back, is cheaper than several replacements.
TIDY = r"^(?:[!-~가-힣]++(?: [!-~가-힣]++)*+)?+\z"


def unless_tidy(c: Column, cleaned: Callable[[Column], Column]) -> Column:
    return F.when(c.rlike(TIDY), c).otherwise(cleaned(c))


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)^{SPACE}+|{SPACE}+\z", "")


def strip(c: Column) -> Column:
    return unless_tidy(c, stripped)


def clean_text(c: Column) -> Column:
    """All white space collapsed to single spaces, none at the ends; null is empty."""
    return F.coalesce(unless_tidy(c, lambda x: stripped(F.regexp_replace(x, rf"(?U){SPACE}+", " "))), F.lit(""))


def clean_cell(c: Column) -> Column:
    """As clean_text, but line breaks stay; blank lines go."""
    plain = lambda x: F.translate(x, " 　", "  ")
    return unless_tidy(c, lambda x: stripped(F.regexp_replace(F.regexp_replace(plain(x), r"[ \t]+", " "), rf"(?U)\n{SPACE}*\n+", "\n")))


# Characters that markup can't hold, and ampersands that begin no entity which it knows.
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
BARE_AMPERSAND = r"&(?!amp;|lt;|gt;|quot;|apos;|#\d+;|#x[0-9a-fA-F]+;)"


def sanitize_markup(c: Column) -> Column:
    """Control characters dropped, bare ampersands escaped."""
    return F.regexp_replace(F.regexp_replace(c, CONTROL, ""), BARE_AMPERSAND, "&amp;")


def iso_date(c: Column) -> Column:
    return F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))


def scalar_kind(t: Column, unit_value: Column) -> Column:
    """null, empty, date, number or text, in this precedence; t: the stripped text."""
    from_unit = F.coalesce(unit_value.rlike(r"^\d{8}$"), F.lit(False))
    return (
        F.when(t.isNull(), "null").when(t.isin(EMPTY_WORDS), "empty").when(from_unit, "date")
        .when(t.rlike(r"^(19|20)\d{6}$"), "date").when(t.rlike(NUMBER), "number").otherwise("text")
    )


def scalar_date(t: Column, unit_value: Column) -> Column:
    return F.when(F.coalesce(unit_value.rlike(r"^\d{8}$"), F.lit(False)), iso_date(unit_value)).otherwise(iso_date(t))


def scalar_value(kind: Column, t: Column, unit_value: Column) -> Column:
    return F.when(kind.isin("null", "empty"), None).when(kind == "date", scalar_date(t, unit_value)).when(kind == "number", F.replace(t, F.lit(","), F.lit(""))).otherwise(t)


def normalize_scalar(text: Column, unit_value: Column) -> Column:
    """struct(value, value_num, value_date, value_type), by its kind."""
    t = strip(text)
    kind = scalar_kind(t, unit_value)
    return F.struct(
        scalar_value(kind, t, unit_value).alias("value"), F.when(kind == "number", F.replace(t, F.lit(","), F.lit("")).try_cast("double")).alias("value_num"),
        F.when(kind == "date", F.try_to_date(scalar_date(t, unit_value))).alias("value_date"), kind.alias("value_type"),
    )


def split_title(title: Column) -> Column:
    """struct(company_name, report_name): the first two parts around "/", if there are two."""
    clean = clean_text(title)
    parts = F.filter(F.transform(F.split(clean, "/"), strip), lambda p: p != "")
    two = F.size(parts) >= 2
    return F.struct(F.when(two, F.get(parts, F.lit(0))).otherwise(F.lit("")).alias("company_name"), F.when(two, F.get(parts, F.lit(1))).otherwise(clean).alias("report_name"))


HEADER = rf"(?U)^\d+[.)]{SPACE}*[^:]+$"


def section_header(cell: Column) -> Column:
    """Whether a row's first cell opens a section: a numbered name without a colon, below 80 characters."""
    return cell.rlike(HEADER) & (F.length(cell) < 80)


def format_row(cells: Column) -> Column:
    """One cell "- v", two "- k: v", more joined by " | "; null without cells."""
    first = F.get(cells, F.lit(0))
    bare = F.when(F.startswith(first, F.lit("-")), F.regexp_replace(first, rf"(?U)^-{SPACE}*", "")).otherwise(first)
    return F.when(F.size(cells) == 1, F.concat(F.lit("- "), bare)).when(F.size(cells) == 2, F.concat(F.lit("- "), bare, F.lit(": "), F.get(cells, F.lit(1)))).when(F.size(cells) > 2, F.array_join(cells, " | "))


def section_code(name: Column, idx: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(name, r"^(\d+)", 1), F.lit("")), idx.cast("string"))


def embedding_text(heading_path: Column, text: Column) -> Column:
    return F.when(heading_path != "", F.concat(F.lit("["), heading_path, F.lit("]\n"), text)).otherwise(text)


def context_text(corp: Column, report: Column, date: Column, section: Column, body: Column) -> Column:
    blank = lambda c: F.coalesce(c, F.lit(""))
    header = strip(F.concat(F.lit("["), blank(corp), F.lit("] "), blank(report), F.lit(" ("), blank(date), F.lit(")")))
    return strip(F.concat(header, F.lit("\n섹션: "), section, F.lit("\n"), strip(body)))


def numbered_id(rcept_no: Column, idx: Column) -> Column:
    return F.concat(rcept_no, F.lit("_"), F.format_string("%04d", idx))


def escape_cell(c: Column, style: str) -> Column:
    """For a pipe table: periodic turns line breaks into spaces and blanks into one space, pipeline writes <br>."""
    piped = F.replace(c, F.lit("|"), F.lit("\\|"))
    if style == "pipeline":
        return F.replace(piped, F.lit("\n"), F.lit("<br>"))
    return F.coalesce(F.nullif(strip(F.replace(piped, F.lit("\n"), F.lit(" "))), F.lit("")), F.lit(" "))


# Characters after which white space ends a sentence.
SENTENCE_ENDS = {"markdown": ".!?다요음함", "periodic": ".?!다음:"}


def split_sentences(c: Column, style: str) -> Column:
    pattern = rf"(?U)(?<=[{SENTENCE_ENDS[style]}]){SPACE}+" + (r"|\n" if style == "markdown" else "")
    return F.split(c, pattern, -1)


def joined_labels(labels: Column) -> Column:
    return F.array_join(F.array_distinct(labels), " / ")
