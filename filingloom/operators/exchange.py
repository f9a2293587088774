"""Exchange filings: rows to sections, sections to markdown and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingloom.functions import HEADER, context_text, format_row, numbered_id, section_code, section_header, split_title, strip
from filingloom.operators.failures import isolated, parted
from filingloom.operators.forms import MARK, OPEN
from filingloom.operators.tables import exchange_rows

KEY = "rcept_no"
#: Fixed value: the section of rows before the first header.
DEFAULT_SECTION = "기본사항"


def exchange_titles(blocks: DataFrame) -> DataFrame:
    """(rcept_no, company_name, report_name, error) of every filing."""
    return blocks.groupBy(KEY).agg(F.max(F.when(F.col("type") == "title", F.col("text"))).alias("t"), F.max("error").alias("error")).select(KEY, split_title(F.col("t")).alias("s"), "error").select(KEY, "s.*", "error")


def marked_headers(rows: DataFrame) -> DataFrame:
    """The keys of forms (operators.forms) in which a mark decides on a section's name: a header holds one, or may be one by it."""
    first = F.get(F.col("cells"), F.lit(0))
    return rows.where(F.contains(first, F.lit(OPEN)) & F.regexp_replace(first, MARK, "0").rlike(HEADER)).select(KEY).distinct()


def carry_section(rows: DataFrame) -> DataFrame:
    """rows with section, opened (this row opens it) and line (null for a bare header): the section runs on over rows and tables."""
    first = F.get("cells", F.lit(0))
    r = rows.withColumn("opened", section_header(first))
    w = Window.partitionBy(KEY).orderBy("block_no", "row").rowsBetween(Window.unboundedPreceding, 0)
    r = r.withColumn("section", F.coalesce(F.last(F.when(F.col("opened"), strip(first)), ignorenulls=True).over(w), F.lit(DEFAULT_SECTION)))
    rest = F.when(F.col("opened"), F.slice("cells", 2, F.greatest(F.size("cells") - 1, F.lit(1)))).otherwise(F.col("cells"))
    return r.withColumn("line", format_row(rest))


def collect_sections(lines: DataFrame) -> DataFrame:
    """(rcept_no, section_no, section, lines): a section seen again goes on; order by first header, the default one first;
    sections without lines are dropped, and numbers count what is left."""
    pos = F.when(F.col("section") == DEFAULT_SECTION, F.struct(F.lit(-1).alias("block_no"), F.lit(-1).alias("row"))).otherwise(F.struct("block_no", "row"))
    found = F.sort_array(F.collect_list(F.when(F.col("line").isNotNull(), F.struct("block_no", "row", "line"))))
    s = lines.groupBy(KEY, "section").agg(F.min(pos).alias("pos"), F.transform(found, lambda x: x["line"]).alias("lines")).where(F.size("lines") > 0)
    return s.withColumn("section_no", F.row_number().over(Window.partitionBy(KEY).orderBy("pos"))).select(KEY, "section_no", "section", "lines")


def exchange_markdown(titles: DataFrame, sections: DataFrame) -> DataFrame:
    """(rcept_no, markdown): # [company] report, then ## section and its lines."""
    one = F.concat(F.lit("## "), "section", F.lit("\n"), F.array_join("lines", "\n"), F.lit("\n"))
    body = sections.groupBy(KEY).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("section_no", one.alias("part")))), lambda x: x["part"]), "\n").alias("body"))
    named = (F.col("company_name") != "") | (F.col("report_name") != "")
    head = F.when(named, F.concat(strip(F.concat(F.lit("# ["), "company_name", F.lit("] "), "report_name")), F.lit("\n")))
    return titles.join(body, KEY, "left").select(KEY, strip(F.concat_ws("\n", head, "body")).alias("markdown"))


def exchange_sections(grids: DataFrame, on_error: str = "warn") -> tuple[DataFrame, DataFrame]:
    """The sections of every filing with origin grids whose tables are all right, and (rcept_no, error) of the others."""
    good, bad = parted(grids, on_error=on_error)
    return collect_sections(carry_section(exchange_rows(good))), bad


def chunk_exchange(sections: DataFrame, meta: DataFrame | list[str], on_error: str = "raise") -> DataFrame:
    """One chunk per section, its text led by the document's context; meta: document_metadata of family exchange, or its columns where
    sections have them. sections may hold rows with an error: see failures.isolated."""
    body = F.array_join("lines", "\n")
    text = context_text(F.col("corp_name"), F.col("report_nm"), F.col("rcept_dt"), F.col("section"), body)

    kept = meta if isinstance(meta, list) else meta.columns

    def chunks(good: DataFrame) -> DataFrame:
        known = good if isinstance(meta, list) else good.join(meta, KEY)
        return known.withColumn("text", text).select(
            numbered_id(F.col(KEY), F.col("section_no")).alias("chunk_id"), F.col("section_no").alias("chunk_index"), F.lit("text").alias("chunk_type"), "section", F.col("section").alias("section_path"),
            section_code(F.col("section"), F.col("section_no")).alias("section_code"), F.lit(None).cast("int").alias("page"), F.length("text").alias("n_chars"), "text", *kept,
        )

    return isolated(sections, chunks, on_error, pos="section_no")
