"""Reading and writing manifests, filings, markdown, chunks and reports."""

from __future__ import annotations

import fnmatch
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXTS = ["doc_id", "rcept_no", "corp_name", "listed_name", "corp_code", "stock_code", "industry", "sector", "doc_group", "doc_subtype", "report_nm", "rcept_dt", "file_path"]
MANIFEST = T.StructType([T.StructField(n, T.StringType()) for n in TEXTS] + [T.StructField("is_correction", T.BooleanType()), T.StructField("base_year", T.IntegerType()), T.StructField("base_month", T.IntegerType())])
CHUNKS = T.StructType([T.StructField(n, T.StringType()) for n in ["chunk_id", "text", "embedding_text", "section", "heading_path", "chunk_type", *TEXTS]] + [T.StructField("chunk_index", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("char_count", T.LongType()), T.StructField("has_table", T.BooleanType()), T.StructField("is_correction", T.BooleanType())])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one that the session names. Only where all run on one machine, as
    in tests, one of our own takes its place."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="checkpoints-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def staged(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it back: it is computed once, and lost executors don't matter."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Deletes what this application has staged. Results that still read it must have been written before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/staged-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Rows and bytes of an Arrow batch of long texts: a batch stands in the JVM and in Python at once, there several times as large.
BATCH_ROWS, BATCH_BYTES = 1024, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Holds the session's Arrow batches to these sizes, unless it asks for smaller ones. Batches are made when results are
    written, so the settings stay."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    given = str(spark.conf.get(size)).lower().removesuffix("b")
    if not (given.isdigit() and 0 < int(given) <= BATCH_BYTES):
        spark.conf.set(size, f"{BATCH_BYTES}b")


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """rows dealt by a key to as many tasks as the session can run at once, and more: cheap rows whose work is dear. A stated
    number isn't coalesced by their size."""
    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return rows.repartition(n, *by)


def parsed_lines(lines: DataFrame) -> DataFrame:
    """Lines (value, position) that aren't blank as (position, _bad, the manifest's columns, given): _bad is a line that is no
    record; given names the keys that a record has, those whose value is null too."""
    row = F.from_json("value", T.StructType([*MANIFEST.fields, T.StructField("_bad", T.StringType())]), {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    named = [F.when(F.expr(f"variant_get(_v, '$.{n}', 'variant')").isNotNull() | F.col(f"r.{n}").isNotNull(), F.lit(n)) for n in MANIFEST.names]
    rows = lines.where(F.trim("value") != "").select("position", row.alias("r"), F.try_parse_json("value").alias("_v"))
    return rows.select("position", "r.*", F.array_compact(F.array(*named)).alias("given"))


def bad_lines(lines: DataFrame) -> DataFrame:
    """(lines, bad): how many lines (value) aren't blank, and how many of them are no JSON record, which "skip" leaves out."""
    return parsed_lines(lines.withColumn("position", F.lit(0))).agg(F.count("*").alias("lines"), F.count("_bad").alias("bad"))


def last_records(rows: DataFrame, key: str, given: bool = False) -> DataFrame:
    """Of parsed_lines, the last record of each key; records without a key are dropped. given keeps the column of that name."""
    last = F.max_by(F.struct(*MANIFEST.names, *["given"] * given), "position").alias("r")
    return rows.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(F.col(key).alias("_key")).agg(last).select("r.*")


def parse_manifest(lines: DataFrame, key: str = "rcept_no", on_bad: str = "fail", given: bool = False) -> DataFrame:
    """Lines (value, position) of JSON to one record per key, the last of each; records without a key are dropped. given: see
    parsed_lines; with it document_metadata tells a null from a key that is missing."""
    rows = parsed_lines(lines)
    if on_bad == "fail":
        rows = rows.withColumn(key, F.when(F.col("_bad").isNotNull(), F.raise_error(F.concat(F.lit("bad manifest line: "), "_bad")).cast("string")).otherwise(F.col(key)))
    else:
        rows = rows.where("_bad is null")
    return last_records(rows, key, given)


def counted_manifest(lines: DataFrame, key: str = "rcept_no", given: bool = False) -> tuple[DataFrame, dict[str, int]]:
    """parse_manifest that skips bad lines, and {lines, bad} as of bad_lines: counted while the lines are parsed, once. The counts
    are taken as parsed lines are written, where a task that is run again counts once."""
    seen = Observation()
    rows = staged(parsed_lines(lines).observe(seen, F.count("*").alias("lines"), F.count("_bad").alias("bad")))
    return last_records(rows.where("_bad is null"), key, given), seen.get


def read_manifest(spark: SparkSession, path: str, key: str = "rcept_no", on_bad: str = "fail", missing_ok: bool = False, given: bool = False) -> DataFrame:
    """A JSON-lines manifest; the id Spark gives to the lines of a file rises with their position."""
    from pyspark.errors import AnalysisException

    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if missing_ok and "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], MANIFEST)
        raise
    return parse_manifest(lines.withColumn("position", F.monotonically_increasing_id()), key, on_bad, given)


def stem(path: Column, named_by: str) -> Column:
    """A file's name without its extension, or, named_by "folder", the name of the folder that it lies in."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$" if named_by == "file" else r"([^/]+)/[^/]*$", 1)


def listed(spark: SparkSession, read: Callable[[], DataFrame]) -> DataFrame:
    """read(), a DataFrame of files, whose folders are listed by a few tasks a core. Spark would start one for each folder, up to 10,000."""
    name, n = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 4 * spark.sparkContext.defaultParallelism
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(n, int(before))))
    try:
        return read()
    finally:
        spark.conf.set(name, before)


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path in the local file system that all share; None where path lies elsewhere."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    to = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri()
    return to.getPath() if to.getScheme() == "file" else None


def entries(folder: bytes, pattern: str) -> Iterator[tuple[bytes, bool]]:
    """(path, whether it is a folder) of what lies in a folder: folders, and files that the pattern names. Spark's readers leave the same out."""
    with os.scandir(folder) as found:
        for e in found:
            name, is_folder = e.name, e.is_dir()
            hidden = name.startswith(b".") or name.startswith(b"_") and b"=" not in name or name.endswith(b"._COPYING_")
            if not (hidden and not name.startswith((b"_metadata", b"_common_metadata"))) and (is_folder or fnmatch.fnmatchcase(os.fsdecode(name), pattern)):
                yield e.path, is_folder


#: Folders that one task lists by itself; with more, they are dealt to all.
FOLDERS = 1000
#: Patterns that mean the same to Spark's readers, and of files that these don't unpack.
PATTERN = re.compile(r"[\w.*-]+(?<!\*)(?<!\.gz)(?<!\.bz2)(?<!\.lz4)(?<!\.zst)(?<!\.deflate)(?<!\.snappy)")


def local_files(spark: SparkSession, root: str, pattern: str, contents: bool = True) -> DataFrame | None:
    """(path, content) of all files below a local folder, listed and opened by tasks. Spark's readers keep each file's status and its share of a
    task in the driver, whose memory then grows with the files. None where root is no local folder."""
    at = local_path(spark, root)
    if at is None or not os.path.isdir(at) or not PATTERN.fullmatch(pattern):
        return None

    def some(rows: Iterator[tuple[bytes, bool]]) -> Iterator[pa.RecordBatch]:
        while rows_now := list(islice(rows, BATCH_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows_now), (pa.binary(), pa.bool_()))], ["path", "folder"])

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[bytes, bool]]:
            level, many = [os.fsencode(at)], False
            while level and not many:
                deeper: list[bytes] = []
                for folder in level:
                    for path, is_folder in entries(folder, pattern):
                        if is_folder and len(deeper) < FOLDERS:
                            deeper.append(path)
                        else:
                            many = many or is_folder
                            yield path, is_folder
                level = deeper
            yield from ((path, True) for path in level)

        for _ in batches:
            yield from some(found())

    def below(path: bytes) -> Iterator[bytes]:
        folders = [path]
        while folders:
            for inner, is_folder in entries(folders.pop(), pattern):
                if is_folder:
                    folders.append(inner)
                else:
                    yield inner

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = lambda: pa.RecordBatch.from_arrays([pa.array(paths, pa.binary()), pa.array(texts, pa.binary())], ["path", "content"])
        paths, texts, size = [], [], 0
        for b in batches:
            for one, is_folder in zip(b.column("path").to_pylist(), b.column("folder").to_pylist()):
                for path in below(one) if is_folder else [one]:
                    if not os.path.getsize(path):  # Spark's readers give no row for it
                        continue
                    text = None
                    if contents:
                        with open(path, "rb") as f:
                            text = f.read()
                    paths.append(b"file:" + path)
                    texts.append(text)
                    size += len(text or b"")
                    if len(paths) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield made()
                        paths, texts, size = [], [], 0
        yield made()

    dealt = spread(spark.range(0, 1, 1, 1).mapInArrow(top, "path binary, folder boolean"))
    return dealt.mapInArrow(read, "path binary, content binary").select(F.col("path").cast("string").alias("path"), "content")


def scan_filings(spark: SparkSession, root: str, pattern: str = "*.xml", limit: int | None = None, named_by: str = "file") -> DataFrame:
    """(rcept_no, path, content) of all files below root. limit: the first by path; the smallest paths are found without contents,
    and only these files are opened."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = local_files(spark, root, pattern, limit is None)
    if files is None:
        files = listed(spark, lambda: read.option("pathGlobFilter", pattern).load(root))
    if limit is not None:
        first = [re.sub(r"([\\*?{}\[\]])", r"\\\1", r["path"]) for r in files.select("path").orderBy("path").limit(limit).collect()]  # `limit` paths
        files = spark.read.format("binaryFile").load(first) if first else files.limit(0)
    return files.select(stem(F.col("path"), named_by).alias("rcept_no"), "path", "content")


def scan_markdown(spark: SparkSession, root: str, pattern: str = "*.md", named_by: str = "file") -> DataFrame:
    """(doc_id, text) of all files below root."""
    own = local_files(spark, root, pattern)
    if own is not None:
        return own.select(stem(F.col("path"), named_by).alias("doc_id"), F.col("content").cast("string").alias("text"))
    read = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    files = listed(spark, lambda: read.text(root, wholetext=True))
    return files.select(stem(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))), named_by).alias("doc_id"), F.col("value").alias("text"))


#: Characters that stand escaped in the names of partitions' folders, and the folder of rows without a name.
ESCAPED, NAMELESS = re.compile(r"[\x01-\x1f\x7f\"#%'*/:=?\\{\[\]^]"), "__HIVE_DEFAULT_PARTITION__"


def write_files(rows: DataFrame, path: str, by: str) -> None:
    """Writes a file for each row (by, value), its text and a line break, in the folder that a partition by that column has.

    In a local folder Spark's writer starts a process for each file, to set its mode, and the driver moves every file once more. So
    there tasks put the files in their places themselves: under a hidden name first, and numbered, so that a task that runs again
    replaces its own. rows should be read from files, so that they come in the same order then.
    """
    spark = rows.sparkSession
    root = local_path(spark, path)
    if root is None:
        rows.select(by, "value").repartition(by).write.partitionBy(by).text(path)
        return

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for b in batches:
            for name, value in zip(b.column("name").to_pylist(), b.column("value").to_pylist()):
                folder = f"{root}/{by}={ESCAPED.sub(lambda c: f'%{ord(c[0]):02X}', name) if name else NAMELESS}"
                os.makedirs(folder, exist_ok=True)
                hidden = f"{folder}/.{uuid.uuid4().hex}"
                with open(hidden, "wb") as f:
                    f.write((value or b"") + b"\n")
                os.replace(hidden, f"{folder}/part-{task:05d}-{n:09d}.txt")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["files"])

    small_batches(spark)
    os.makedirs(root, exist_ok=True)  # also where there are no rows
    rows.select(F.col(by).cast("string").alias("name"), F.col("value").cast("binary").alias("value")).mapInArrow(put, "files long").agg(F.sum("files")).collect()


def read_chunks(spark: SparkSession, root: str, pattern: str = "*.jsonl") -> DataFrame:
    return spark.read.schema(CHUNKS).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").json(root).where("chunk_id is not null or text is not null")


def write_chunks(df: DataFrame, path: str, fmt: str = "json", by: str = "rcept_no", compression: str | None = None) -> None:
    """Documents whole within a file, chunks in order; nulls are written. Lines repeat names and metadata, so compressed ones (gzip) take a
    small part of the disk; their files end in .gz too."""
    rows = df.repartition(by).sortWithinPartitions(by, "chunk_index")
    to = rows.write.mode("overwrite").option("ignoreNullFields", "false").format(fmt)
    (to.option("compression", compression) if compression else to).save(path)


def normalized_payload(meta: DataFrame, fields: DataFrame, paragraphs: DataFrame, manifest: DataFrame) -> DataFrame:
    """A row per document: its meta, its fields and paragraphs in order, and the manifest's columns as manifest_<name>."""
    in_order = lambda df, name: df.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("pos", *[c for c in df.columns if c not in ("doc_id", "pos")]))).alias(name))
    return payload_manifest(meta.join(in_order(fields, "fields"), "doc_id", "left").join(in_order(paragraphs, "paragraphs"), "doc_id", "left"), manifest)


def payload_manifest(docs: DataFrame, manifest: DataFrame) -> DataFrame:
    """docs with the manifest's columns as manifest_<name>."""
    known = manifest.select(F.col("doc_id").alias("_doc"), *(F.col(c).alias(f"manifest_{c}") for c in manifest.columns))
    return docs.join(known, F.col("doc_id") == F.col("_doc"), "left").drop("_doc")


def write_normalized(payload: DataFrame, path: str) -> None:
    payload.write.mode("overwrite").parquet(path)


def write_run_report(run_log: DataFrame, summary: DataFrame, path: str) -> None:
    """The log, its summary, the failed and the empty documents, from one pass over the log."""
    log = run_log.persist()
    log.write.mode("overwrite").parquet(f"{path}/run_log")
    summary.write.mode("overwrite").json(f"{path}/summary")
    log.where("status = 'error'").write.mode("overwrite").json(f"{path}/failed")
    log.where("empty_blocks").write.mode("overwrite").json(f"{path}/empty")
    log.unpersist()


def append_embeddings(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_store(df: DataFrame, name: str, path: str, buckets: int = 64, key: str = "chunk_id") -> None:
    """Appends rows to a table whose files are bucketed and sorted by key. spark.table(name) then meets other rows by
    that key (resume_candidates) without being shuffled; those rows are dealt to its buckets."""
    rows = df.repartition(buckets, key)  # a bucket gets one file an append
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).mode("append").saveAsTable(name)


def write_families(df: DataFrame, path: str, by: str = "family") -> None:
    """Chunks in a folder for each family. The families that occur in df take the place of their earlier chunks; others stay, so
    a rerun of one family replaces its own part, and a merged set is all that lies there."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def merge_chunks(parts: list[DataFrame]) -> DataFrame:
    """Chunks of several families in one table; columns that a family lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
