"""Filings that follow a form: each form is read once, and what it gives is filled in for every filing.

A filing's form is its markup with a mark in the place of each number in its texts, and in the attributes of NUMBERED. The blocks, tables
and sections of a form, texts with marks among them, become those of a filing when its own numbers take the marks' places. So the
reader and the steps on nested arrays see a form once, however many filings follow it. Filings whose markup leaves in doubt what is text
are forms of their own without marks: rows are the same in all cases, and only filings that share forms are cheaper.

No step before the filling may look into numbers: what does (scalars, equal labels, lengths) comes after it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingloom.sources import staged

KEY = "rcept_no"
#: A mark is a number's place between two characters of private use. SPLIT stands between texts, and between tags.
OPEN, CLOSE, SPLIT = "\ue000", "\ue001", "\ue002"
MARK = f"{OPEN}[0-9]+{CLOSE}"
TAG = re.compile("<([^<>]*)>")
#: Digits, perhaps with commas. Those before ")", "&" or a "." that ends them stay: they may number a heading, or belong to a reference.
NUMBER = re.compile(r"([0-9](?<![0-9,][0-9])[0-9]*(?:,[0-9]+)*(?![0-9)&]|,[0-9]|\.(?![0-9])))")
#: Attributes whose numbers differ between filings of one form.
NUMBERED = re.compile(r"(A(?:UNITVALUE=\"|ASSOCNOTE=\"L-))([0-9]+)(?=\")")
REFERENCE = re.compile(rf"&[^<>&;\s{SPLIT}]*{OPEN}")
#: Forms that a task remembers at most.
FORMS = 20_000


def parts_of(markup: str) -> list[str]:
    """Texts and tags in turns, as TAG.split gives them. Where brackets plainly take turns, splitting by a character is several times as fast."""
    pieces = markup.split("<")
    if ">" not in pieces[0] and all(p.count(">") == 1 for p in pieces[1:]):
        return markup.replace(">", "<").split("<")
    return TAG.split(markup)


def attributes(tags: str) -> tuple[list[str], list[str]]:
    """tags around the numbers of NUMBERED, and these. Patterns that begin with a plain character are found fastest."""
    parts = NUMBERED.split(tags)
    return [*map("".join, zip(parts[::3], parts[1::3])), parts[-1]], parts[2::3]


def numbered(text: str, first: int) -> str:
    """text with a number in each mark, from first."""
    head, *rest = text.split(OPEN)
    return head + "".join(f"{OPEN}{i}{x}" for i, x in enumerate(rest, first))


def form_of(texts: str, tags: str, count: int) -> str | None:
    """The markup of a form from its texts and tags; None where tags and texts don't plainly take turns, or where a number
    may be part of a reference."""
    if "<" in texts or ">" in texts or REFERENCE.search(texts) or any(t.count('"') % 2 or t.count("'") % 2 for t in tags.split(SPLIT)):
        return None
    some, between = numbered(texts, 1).split(SPLIT), numbered(tags, count + 1).split(SPLIT)
    return some[0] + "".join(f"<{tag}>{text}" for tag, text in zip(between, some[1:]))


def formed(filings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of filings (rcept_no, markup): cases (rcept_no, form, numbers), and their forms (rcept_no: the form's
    key, markup). A task gives a form's markup with the first filing that follows it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], str | None] = {}
        for b in batches:
            keys, every, new = [], [], []
            for markup in b.column("markup").to_pylist():
                key = form = None
                numbers = []
                if OPEN not in markup and CLOSE not in markup and SPLIT not in markup:
                    parts = parts_of(markup)
                    texts, (tags, values) = NUMBER.split(SPLIT.join(parts[::2])), attributes(SPLIT.join(parts[1::2]))
                    shape = (f"{OPEN}{CLOSE}".join(texts[::2]), f"{OPEN}{CLOSE}".join(tags))
                    if shape in known:
                        key = known[shape]
                    else:
                        if len(known) >= FORMS:
                            known.clear()
                        form = form_of(*shape, len(texts) // 2)
                        key = known[shape] = None if form is None else hashlib.sha256(form.encode()).hexdigest()
                    numbers = texts[1::2] + values if key else []
                if key is None:
                    form, key = markup, hashlib.sha256(markup.encode()).hexdigest()
                keys.append(key)
                every.append(SPLIT.join(numbers))
                new.append(form)
            yield pa.RecordBatch.from_arrays([b.column(KEY), pa.array(keys, pa.string()), pa.array(every, pa.string()), pa.array(new, pa.string())], [KEY, "form", "numbers", "marked"])

    rows = filings.select(KEY, F.coalesce("markup", F.lit("")).alias("markup"))
    cases = staged(rows.mapInArrow(read, f"{KEY} string, form string, numbers string, marked string"))
    forms = cases.where("marked is not null").select(F.col("form").alias(KEY), F.col("marked").alias("markup")).distinct()
    numbers = F.when(F.col("numbers") == "", F.array().cast("array<string>")).otherwise(F.split("numbers", SPLIT, -1))
    return cases.select(KEY, "form", numbers.alias("numbers")), staged(forms)


def apart(filings: DataFrame, cases: DataFrame, some: DataFrame) -> tuple[DataFrame, DataFrame]:
    """cases in which filings that follow some forms (rcept_no) are forms of their own, and these forms, without marks."""
    form = some.select(F.col(KEY).alias("form"))
    own = staged(filings.join(cases.join(form, "form", "left_semi").select(KEY), KEY, "left_semi").select(KEY, "markup"))
    key = F.concat(F.lit("="), KEY)
    more = own.select(KEY, key.alias("form"), F.array().cast("array<string>").alias("numbers"))
    return cases.join(form, "form", "left_anti").select(KEY, "form", "numbers").union(more), own.select(key.alias(KEY), "markup")


def cut_at_marks(text: Column) -> Column:
    """A form's text as pieces (number, text after it); null stays null."""
    piece = lambda x, i: F.struct(F.when(i > 0, F.regexp_extract(x, "^[0-9]+", 0).cast("int")).alias("no"), F.when(i > 0, F.substring_index(x, CLOSE, -1)).otherwise(x).alias("after"))
    return F.transform(F.split(text, OPEN, -1), piece)


def filled(pieces: Column) -> Column:
    """The text of pieces with the numbers of a row (column numbers)."""
    return F.array_join(F.transform(pieces, lambda p: F.concat(F.coalesce(F.get("numbers", p["no"] - 1), F.lit("")), p["after"])), "")


def leaves(value: Column, kind: T.DataType, made: Callable[[Column], Column]) -> Column:
    """value with made of each string in it."""
    if isinstance(kind, T.StringType):
        return made(value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: leaves(x, kind.elementType, made))
    if isinstance(kind, T.StructType):
        return F.struct(*(leaves(value[f.name], f.dataType, made).alias(f.name) for f in kind))
    return value


def refilled(rows: DataFrame, cases: DataFrame, texts: tuple[str, ...] = (), lists: tuple[str, ...] = (), kept: tuple[str, ...] = ()) -> DataFrame:
    """rows of forms as rows of the filings that follow them: columns texts, and arrays lists of texts, or of records with texts, with the
    filing's own numbers. kept: further columns of cases."""
    names = [c for c in rows.columns if c != KEY]
    every = lambda c, made: leaves(F.col(c), rows.schema[c].dataType, made) if c in (*texts, *lists) else F.col(c)
    made = rows.select(F.col(KEY).alias("form"), F.struct(*(every(c, cut_at_marks).alias(c) for c in names)).alias("_row"))
    each = staged(made.groupBy("form").agg(F.collect_list("_row").alias("_rows")))  # few: Spark broadcasts them by their size
    out = cases.join(each, "form").select(KEY, "numbers", *kept, F.inline("_rows"))
    return out.select(KEY, *kept, *(every(c, filled).alias(c) for c in names))
