"""Embedding of new chunks by a function that the user gives."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingloom.operators.metadata import embedding_candidates, keep_metadata, resume_candidates
from filingloom.sources import append_embeddings, shared_dir, small_batches

Embedder = Callable[[list[str]], list[list[float]]]


def embed_chunks(chunks: DataFrame, embedder: Embedder, max_retries: int = 5, batch: int = 64, parallel: int | None = None, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """chunks with embedding, outcome (done, failed, skipped) and error.

    Texts go to the embedder in batches; a failing batch is tried again after min(2^k, 30) s, then text by text, so one
    bad text fails alone. `parallel` bounds the tasks that call the service at once.
    """
    small_batches(chunks.sparkSession)
    rows = embedding_candidates(chunks)
    rows = rows.repartition(parallel) if parallel else rows

    def call(texts: list[str]) -> tuple[list | None, str | None]:
        error = None
        for k in range(max_retries):
            try:
                return embedder(texts), None
            except Exception as e:  # any failure is tried again
                error = f"{type(e).__name__}: {e}"
                if k + 1 < max_retries:
                    wait(min(2**k, 30))
        return None, error

    def embed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            vectors, errors = [None] * len(b), [None] * len(b)
            todo = [i for i, (t, s) in enumerate(zip(b["embed_text"], b["skip_reason"])) if s is None]
            texts = b["embed_text"].tolist()
            for at in range(0, len(todo), batch):
                some = todo[at : at + batch]
                found, error = call([texts[i] for i in some])
                for i, v in zip(some, found or []):
                    vectors[i] = v
                for i in some if found is None and len(some) > 1 else []:
                    one, errors[i] = call([texts[i]])
                    vectors[i] = one[0] if one else None
                if found is None and len(some) == 1:
                    errors[some[0]] = error
            outcome = ["skipped" if s is not None else "failed" if v is None else "done" for s, v in zip(b["skip_reason"], vectors)]
            yield b.assign(embedding=vectors, outcome=outcome, error=errors)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(embed, f"{kinds}, embedding array<float>, outcome string, error string")


OUTCOMES = ("done", "skipped", "failed")


def outcome_counts() -> list[Column]:
    return [F.count("*").alias("total"), *(F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES)]


def embedding_summary(outcomes: DataFrame) -> DataFrame:
    """total, done, skipped, failed, from the outcomes (read them back from the store, or embedding runs again)."""
    return outcomes.agg(*outcome_counts())


def embed_and_append(chunks: DataFrame, embedder: Embedder, path: str, **how: Any) -> dict[str, int]:
    """Embeds chunks and appends what is done to the store at path; returns embedding_summary, counted in the same job."""
    seen = Observation()
    out = embed_chunks(chunks, embedder, **how).observe(seen, *outcome_counts())
    append_embeddings(keep_metadata(out.where("outcome = 'done'"), "embedding"), path)
    return seen.get


def embed_in_waves(chunks: DataFrame, embedder: Embedder, path: str, waves: int = 16, **how: Any) -> dict[str, int]:
    """embed_and_append of the chunks that aren't in the store at path yet, in waves by a hash of their ids: each is appended before
    the next one starts, so a run that breaks off loses its last wave only, and the next run asks for the rest.

    Chunks without an id are in the first wave, which skips them. Chunks that repeat an id are in one wave, and each is embedded.
    """
    spark = chunks.sparkSession
    wave = F.coalesce(F.pmod(F.xxhash64("chunk_id"), F.lit(waves)), F.lit(0)).cast("int")
    where = f"{shared_dir(spark)}/staged-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    chunks.withColumn("_wave", wave).write.partitionBy("_wave").parquet(where)  # each wave reads its own folder
    rows = spark.read.schema(T.StructType([*chunks.schema.fields, T.StructField("_wave", T.IntegerType())])).parquet(where)
    total = dict.fromkeys(("total", *OUTCOMES), 0)
    for i in range(waves):
        mine = rows.where(F.col("_wave") == i).drop("_wave")
        done = embed_and_append(resume_candidates(mine, stored(spark, path)), embedder, path, **how)
        total = {k: n + done[k] for k, n in total.items()}
    return total


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The store's ids; none where there is no store yet."""
    ids = spark.createDataFrame([], "chunk_id string")
    try:
        return spark.read.parquet(path).select("chunk_id")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return ids
        raise
