"""A corpus pipeline: good documents, one of each near-duplicate group, without secrets, mixed, as token ids.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the docs of the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingloom.llm.common import cut, small, table, taken
from filingloom.llm.jaccard_join import SOME, jaccard_classes
from filingloom.llm.mixing import mix
from filingloom.llm.quality_classifier import train
from filingloom.llm.secret_scan import redact_secrets
from filingloom.llm.sentencepiece_trie import encode, load


#: Rows of an Arrow batch at most while the pipeline runs: texts are long, and a batch stands in the JVM and in Python at once.
BATCH = 1000


def bounded(spark: SparkSession) -> None:
    """Holds the session's Arrow batches to BATCH rows, unless it asks for fewer. Batches are made when a stage's result is
    written, so the setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH:
        spark.conf.set(name, str(BATCH))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more; a null or empty text is scored as any other. Repeated rows, and rows
    without an id, are scored each; an empty table stays empty."""
    bounded(spark)
    model = train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return docs.where(model.score() >= 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group joined by links (five words, Jaccard 0.8) the document of the smallest id stays.

    Each row is a document of its own, also where ids repeat or are null (null comes last, ties go to the row read first), so no
    text goes that isn't linked with one that stays. Documents without words link with nothing and stay.
    """
    bounded(spark)
    unclear = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()
    (row,) = taken(docs, "row")
    rows = cut(docs.withColumn(row, F.monotonically_increasing_id())) if unclear else docs.withColumn(row, F.col("doc_id"))
    classes = cut(jaccard_classes(rows.select(F.col(row).alias("doc_id"), "text"), n=5, num=80, den=100).select(F.col("doc_id").alias(row), F.col("component_id").alias("_c")))
    gone = classes.where(F.col(row) != F.col("_c"))
    if unclear:  # a component is named by its first row, which needn't have its smallest id
        groups = small(cut(gone.select("_c").distinct()), SOME)
        members = cut(classes.join(groups, "_c").join(rows.select(row, "doc_id"), row))
        first = members.groupBy("_c").agg(F.min_by(row, F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("_first"))
        gone = members.join(small(cut(first), SOME), "_c").where(F.col(row) != F.col("_first"))
    return rows.join(small(cut(gone.select(row)), SOME), row, "left_anti").select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets in its text redacted; null and empty texts and repeated rows stay, an empty table stays empty."""
    return redact_secrets(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it. Rows without an id, or with that of others, are decided one by one, by a hash of id and
    text, so reruns differ in equal rows at most. Null and empty texts have size 0; an empty table stays empty."""
    row, copies, copy = taken(docs, "row", "copies", "copy")
    rows = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    often = mix(rows.select("doc_id", "source", "text", F.col(row).alias("row")), keep=("row",)).where("copies > 0").select(F.col("keep_row").alias(row), F.col("copies").alias(copies))
    both = rows.join(small(cut(often), SOME), row)
    return both.withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col(copies).cast("int")))).select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and ids of every row, repeated ones and those without an id too; a null or empty text has no
    ids, an empty table no rows."""
    bounded(spark)
    coded = encode(docs, load(), keep=("doc_id", "source"))
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixture", mixture), ("token_ids", token_ids)]

#: Scores, forests, tilted rates and segmentations are no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir) if name == STAGES[-1][0] else cut(stage(spark, docs, sf_dir))
    return docs
