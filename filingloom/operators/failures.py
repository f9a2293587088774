"""Failures of single documents: kept beside the rows, reduced to one a document, and taken out of what goes on."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingloom.sources import staged

KEY = "rcept_no"


def first_errors(rows: DataFrame, key: str = KEY, pos: str = "block_no") -> DataFrame:
    """(key, error) of every document with an error in any row: the first by pos, and by its text."""
    return rows.where("error is not null").groupBy(key).agg(F.min(F.struct(F.coalesce(pos, F.lit(-1)).alias("pos"), "error"))["error"].alias("error"))


def parted(rows: DataFrame, key: str = KEY, pos: str = "block_no", on_error: str = "warn") -> tuple[DataFrame, DataFrame]:
    """The rows of documents without an error anywhere, without the column error; and first_errors of the others.

    on_error "raise": the first row with an error fails the job instead. Both results read rows, so rows whose making is dear are
    staged by the caller. Documents without a key stand for one another only if they fail.
    """
    if on_error == "raise":
        failed = F.raise_error(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("?")), F.lit(": "), "error")).cast("boolean")
        return rows.where(F.when(F.col("error").isNotNull(), failed).otherwise(True)).drop("error"), rows.limit(0).select(key, "error")
    bad = first_errors(rows, key, pos)
    gone = bad.select(F.col(key).alias("_failed"))
    return rows.where("error is null").join(gone, F.col(key).eqNullSafe(F.col("_failed")), "left_anti").drop("error"), bad


def with_errors(docs: DataFrame, *stages: DataFrame, key: str = KEY) -> DataFrame:
    """docs with error: that of the first stage (first_errors each) in which the document failed; its own comes before."""
    own = docs if "error" in docs.columns else docs.withColumn("error", F.lit(None).cast("string"))
    some = [s.select(F.col(key).alias("_key"), F.lit(i).alias("_stage"), F.col("error").alias("_error")) for i, s in enumerate(stages)]
    first = reduce(lambda a, b: a.union(b), some).groupBy("_key").agg(F.min_by("_error", "_stage").alias("_error"))
    return own.join(first, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn("error", F.coalesce("error", "_error")).drop("_key", "_error")


def isolated(rows: DataFrame, job: Callable[[DataFrame], DataFrame], on_error: str, key: str = KEY, pos: str = "block_no", made_pos: str = "chunk_index") -> DataFrame:
    """job(rows of the documents without an error). "warn" adds a column error and, for each failed document, one row of its key
    and error; a document that fails within the job (a column error in what it makes) leaves that row alone too."""
    own = rows if "error" in rows.columns else rows.withColumn("error", F.lit(None).cast("string"))
    good, bad = parted(own, key, pos, on_error)
    made = job(good)
    if on_error == "raise":
        return made
    if "error" in made.columns:
        made, more = parted(staged(made), key, made_pos)
        bad = bad.union(more)
    return made.withColumn("error", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)
