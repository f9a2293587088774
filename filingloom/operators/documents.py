"""Documents from events and blocks: contents sections, headers, paragraphs, markdown."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingloom.functions import clean_cell, clean_text
from filingloom.operators.tables import let, table_text

KEY = "rcept_no"


def once(rows: DataFrame, kept: Callable[[Column], Column]) -> DataFrame:
    """The rows of which kept is true. As a filter it would be moved below the columns' making, and make them a second time."""
    return rows.select(F.inline(F.filter(F.array(F.struct(*rows.columns)), kept)))


def in_order(rows: DataFrame, keys: list[str], pos: str, text: str, sep: str) -> DataFrame:
    """Texts of a group, joined in the order of pos."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct(pos, text))), lambda x: x[text])
    return rows.groupBy(*keys).agg(F.array_join(parts, sep).alias("joined"))


def toc_sections(events: DataFrame) -> DataFrame:
    """(rcept_no, section_no, section_id, title, text, char_count): a text belongs to the latest contents title before it."""
    w = Window.partitionBy(KEY).orderBy("seq")
    e = events.where("kind in ('title', 'text')").withColumn("section_no", F.sum((F.col("kind") == "title").cast("int")).over(w)).where("section_no > 0")
    texts = F.transform(F.sort_array(F.collect_list(F.when(F.col("kind") == "text", F.struct("seq", "text")))), lambda x: x["text"])
    title = lambda c: F.max(F.when(F.col("kind") == "title", F.col(c)))
    s = e.groupBy(KEY, "section_no").agg(title("section_id").alias("section_id"), title("text").alias("title"), F.array_join(texts, " ").alias("text"))
    return s.withColumn("char_count", F.length("text"))


def document_header(blocks: DataFrame) -> DataFrame:
    """(rcept_no, document_name, document_acode, formula_version, company_name, company_regcik) of every filing."""
    pick = lambda tag, c: F.max(F.when((F.col("type") == "header") & (F.col("tag") == tag), c))
    text = clean_cell(F.col("text"))
    return blocks.groupBy(KEY).agg(pick("document-name", text).alias("document_name"), pick("document-name", F.col("aclass")).alias("document_acode"), pick("formula-version", text).alias("formula_version"), pick("company-name", text).alias("company_name"), pick("company-name", F.col("aclass")).alias("company_regcik"))


def summary_items(blocks: DataFrame) -> DataFrame:
    return blocks.where("type = 'summary'").select(KEY, "block_no", F.col("tag").alias("acode"), F.col("aclass").alias("afeature"), clean_cell(F.col("text")).alias("value"))


def paragraphs(blocks: DataFrame) -> DataFrame:
    text = clean_cell(F.col("text"))
    return blocks.where("type = 'paragraph'").select(KEY, "block_no", F.transform("section_path", clean_cell).alias("section_path"), text.alias("text")).where("text <> ''")


def to_markdown(meta: DataFrame, grids: DataFrame) -> DataFrame:
    """(rcept_no, markdown) of pipeline blocks with shared grids: title, correction notice, company, nested headings capped at six."""
    b = grids.where("type in ('section', 'paragraph', 'table')").withColumn("table_text", table_text("shared"))
    text = clean_cell(F.col("text"))
    part = F.when((F.col("type") == "section") & (text != ""), F.concat(F.repeat(F.lit("#"), F.least(F.col("level") + 1, F.lit(6))), F.lit(" "), text)).when((F.col("type") == "paragraph") & (text != ""), text).when(F.col("type") == "table", F.col("table_text"))
    parts = once(b.select(KEY, "block_no", part.alias("part")), lambda x: x["part"].isNotNull())
    bodies = in_order(parts, [KEY], "block_no", "part", "\n\n")
    head = F.concat(F.lit("# "), "document_name", F.when(F.col("is_correction"), F.lit("\n\n> ⚠️ 본 문서는 [기재정정] 정정공시입니다.")).otherwise(F.lit("")), F.lit("\n\n**제출인/회사명:** "), "company_name")
    out = meta.join(bodies, KEY, "left").select(KEY, F.concat_ws("\n\n", head, F.nullif("joined", F.lit(""))).alias("markdown"))
    return out.withColumn("markdown", F.regexp_replace("markdown", "\n{3,}", "\n\n"))


def changed_path(path: Column, last: Column) -> Column:
    """Components of path after the prefix that it shares with the path before."""
    same = F.zip_with(path, last, lambda a, b: a.eqNullSafe(b) & a.isNotNull())
    shared = F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, F.size(path)).cast("int")
    return F.slice(F.transform(path, lambda t, i: F.struct(i.alias("i"), t.alias("t"))), shared + 1, F.greatest(F.size(path) - shared, F.lit(0)))


def gathered(blocks: DataFrame) -> DataFrame:
    """(rcept_no, blocks): the periodic blocks (rendered) of a filing in order, in its row."""
    block = F.struct("block_no", (F.col("type") == "table").alias("table"), "section_path", "text")
    return blocks.groupBy(KEY).agg(F.sort_array(F.collect_list(block)).alias("blocks"))


def rendered(docs: DataFrame) -> DataFrame:
    """(rcept_no, markdown) of filings (company_name, document_name, blocks as gathered, null for none), headings only where the path changes."""
    none = F.array().cast("array<string>")

    def text(blocks: Column) -> Column:
        def part(b: Column, i: Column) -> Column:
            last = F.coalesce(F.when(i > 0, F.get(blocks, i - 1)["section_path"]), none)
            heads = F.flatten(F.transform(changed_path(b["section_path"], last), lambda x: F.array(F.lit(""), F.concat(F.repeat(F.lit("#"), F.least(x["i"] + 2, F.lit(6))), F.lit(" "), x["t"]))))
            body = F.when(b["table"], F.array(F.lit(""), b["text"], F.lit(""))).otherwise(F.array(b["text"]))
            return F.array_join(F.concat(heads, body), "\n")

        return F.array_join(F.transform(blocks, part), "\n")

    title = F.concat(F.lit("# "), F.coalesce("company_name", F.lit("")), F.lit(" - "), F.coalesce("document_name", F.lit("")), F.lit("\n"))
    return docs.select(KEY, F.concat_ws("\n", title, let(F.col("blocks"), text)).alias("markdown"))


def render_document(names: DataFrame, blocks: DataFrame) -> DataFrame:
    """(rcept_no, markdown) of periodic blocks (text or table, rendered), headings only where the path changes."""
    return rendered(names.join(gathered(blocks), KEY, "left"))


def periodic_texts(grids: DataFrame) -> DataFrame:
    """Periodic blocks with their text, from repeat grids: paragraphs cleaned, tables as pipe tables; empty ones dropped, rows
    with an error kept."""
    text = F.when(F.col("type") == "table", table_text("repeat")).otherwise(clean_text(F.col("text")))
    b = grids.where("type in ('text', 'table') or error is not null").select(KEY, "block_no", "type", "section_path", text.alias("text"), "error")
    return once(b, lambda x: (F.coalesce(x["text"], F.lit("")) != "") | x["error"].isNotNull())
