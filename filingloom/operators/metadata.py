"""Manifest filters, lookups, resume, and the metadata that chunks carry."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingloom.functions import CORRECTION, SPACE, strip

# Labels of document groups, default group of each family, metadata that embeddings keep.
GROUP_LABELS = {"periodic": "정기공시", "major": "주요사항보고서", "exchange": "거래소공시", "holding": "지분공시"}
KEPT = ["chunk_id", "doc_id", "corp_name", "listed_name", "stock_code", "industry", "sector", "doc_group", "doc_subtype", "report_nm", "rcept_dt", "is_correction", "heading_path", "has_table", "char_count"]
CHUNK_META = ["corp_name", "listed_name", "stock_code", "industry", "sector", "doc_group", "doc_subtype", "report_nm", "rcept_dt", "is_correction"]


def filter_manifest(manifest: DataFrame, **conditions: Any | Callable[[Column], Column]) -> DataFrame:
    """All conditions hold: a value equals the column (None equals null), a function of the column is true."""
    tests = [c(F.col(n)) if callable(c) else F.col(n).eqNullSafe(F.lit(c)) for n, c in conditions.items()]
    return manifest.where(reduce(and_, tests)) if tests else manifest


def attach_manifest(filings: DataFrame, manifest: DataFrame, key: str = "rcept_no") -> DataFrame:
    """filings with manifest columns (m_<name>) and manifest_matched; Spark broadcasts the manifest if it is small enough."""
    known = manifest.select(F.col(key).cast("string").alias("_key"), *(F.col(c).alias(f"m_{c}") for c in manifest.columns if c != key))
    return filings.join(known, F.col(key) == F.col("_key"), "left").withColumn("manifest_matched", F.col("_key").isNotNull()).drop("_key")


def join_chunk_metadata(chunks: DataFrame, manifest: DataFrame) -> DataFrame:
    """Ten manifest fields by doc_id; columns that the chunks have win."""
    extra = [c for c in CHUNK_META if c not in chunks.columns]
    return chunks.join(manifest.select("doc_id", *extra), "doc_id", "left")


def resolve_files(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(manifest row, path, file_id) by directory: doc_id for one file, doc_id_<i> in path order for several; no file, no path."""
    placed = files.withColumn("_dir", F.regexp_replace("path", r"/[^/]*$", ""))
    both = manifest.join(placed, F.col("file_path") == F.col("_dir"), "left").drop("_dir")
    each = Window.partitionBy("doc_id")
    i, n = F.row_number().over(each.orderBy("path")) - 1, F.count("path").over(each)
    return both.withColumn("file_id", F.when(n == 1, F.col("doc_id")).when(n > 1, F.concat_ws("_", "doc_id", i.cast("string"))))


def skip_existing(filings: DataFrame, done: DataFrame, limit: int | None = None) -> DataFrame:
    """Filings without an output; a limit by path comes first, so a second run over it has nothing to do."""
    first = filings.orderBy("path").limit(limit) if limit is not None else filings
    return first.join(done.select("rcept_no").distinct(), "rcept_no", "left_anti")


def resume_candidates(chunks: DataFrame, store: DataFrame, once: bool = False) -> DataFrame:
    """Chunks that aren't in the store; once: repeated ids within this run are dropped too."""
    rows = chunks.join(store.where("chunk_id is not null").select("chunk_id").distinct(), "chunk_id", "left_anti")
    return rows.dropDuplicates(["chunk_id"]) if once else rows


def or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def embedding_candidates(chunks: DataFrame) -> DataFrame:
    """chunks with embed_text and skip_reason (null: to be embedded); empty texts count as absent."""
    text = F.coalesce(F.nullif(or_null(chunks, "embedding_text"), F.lit("")), F.nullif(or_null(chunks, "text"), F.lit("")))
    no_id = F.col("chunk_id").isNull() | (F.col("chunk_id") == "")
    return chunks.withColumn("embed_text", text).withColumn("skip_reason", F.when(no_id, "no_chunk_id").when(F.col("embed_text").isNull(), "no_text"))


def keep_metadata(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*(c for c in KEPT if c in df.columns), *more)


def source_file(family: str, folder: Column, name: Column, path: Column | None = None) -> Column:
    if family == "exchange":
        return F.concat(F.lit("corpus/"), F.coalesce(folder, F.lit("")), F.lit("/"), name)
    return F.concat(F.coalesce(folder, path), F.lit("/"), name)


def document_metadata(docs: DataFrame, family: str) -> DataFrame:
    """The base columns of chunks, from docs that attach_manifest completed: rcept_no, company_name, report_name, file_name.

    The manifest's value comes before the parsed one. From a manifest with `given`, a null that a record states stays null and only
    a missing key takes the default; else both take it. Labels and folders have no null: there it always takes the default.
    """
    label = F.create_map(*(F.lit(x) for pair in GROUP_LABELS.items() for x in pair))
    stated = lambda c: F.coalesce(F.array_contains("m_given", c), F.lit(False)) if "m_given" in docs.columns else F.lit(False)
    known = lambda c, other: F.when(stated(c), F.col(f"m_{c}")).otherwise(F.coalesce(F.col(f"m_{c}"), other)).alias(c)
    blank = lambda c: known(c, F.lit(""))
    base = [
        F.coalesce(F.try_element_at(label, F.coalesce("m_doc_group", F.lit(family))), F.lit(GROUP_LABELS[family])).alias("source_doc_type"),
        blank("doc_subtype"), known("corp_name", F.col("company_name")), blank("corp_code"), blank("stock_code"), blank("industry"), blank("sector"),
        F.col("rcept_no"), blank("rcept_dt"), known("report_nm", F.col("report_name")), known("is_correction", F.lit(False)),
    ]
    if family != "exchange":
        base += [F.col("m_base_year").alias("base_year"), F.col("m_base_month").alias("base_month")]
    return docs.select(*base, source_file(family, F.col("m_file_path"), F.col("file_name"), F.col("path") if "path" in docs.columns else F.lit("")).alias("source_file"))


def document_meta(docs: DataFrame) -> DataFrame:
    """docs (document_name, company_name) with is_correction and the cleaned names."""
    name, company = F.coalesce("document_name", F.lit("")), strip(F.coalesce("company_name", F.lit("")))
    return docs.withColumns({
        "document_name": name,
        "document_name_clean": strip(F.replace(name, F.lit(CORRECTION), F.lit(""))),
        "is_correction": F.startswith(strip(name), F.lit(CORRECTION)),
        "company_name": company,
        "company_name_clean": strip(F.regexp_replace(company, rf"(?U){SPACE}*\(주\){SPACE}*\z|^{SPACE}*\(주\){SPACE}*", "")),
    })
