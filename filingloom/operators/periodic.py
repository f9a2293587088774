"""Periodic filings: texts buffered by section, tables whole, long ones split."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingloom.functions import numbered_id, split_sentences
from filingloom.operators.failures import isolated
from filingloom.operators.forms import MARK, OPEN, refilled
from filingloom.operators.markdown import guarded, long_ones, split_table, unfolded
from filingloom.sources import staged

KEY = "rcept_no"
MAX_CHARS, OVERLAP, TABLE_CHARS = 1400, 150, 3000
#: A length that no text has.
ANY = 1 << 30


def overlap_offsets(lengths: np.ndarray, kept: np.ndarray, text: str, most: int, overlap: int) -> list[tuple[int, int]]:
    """Ranges of text, the sentences joined by single spaces, of `most` characters at most; each begins `overlap` characters
    before the end of the one before (not with a space). lengths: of the sentences; kept: without trailing space.

    A sentence belongs to the open range if the range, a space and the sentence as it was fit. Ends of sentences in the
    text are running sums, so a range's last sentence is found by one comparison of arrays.
    """
    ends = np.cumsum(kept + (kept > 0)) - 1  # a sentence of spaces adds nothing
    ends = np.maximum(ends, 0)
    reach = np.r_[0, ends[:-1]] + lengths + 1  # what a sentence asks of the range, from the text's beginning
    out, start, at = [], 0, 0
    while at < len(ends):
        if reach[at] <= start + most:  # with the first sentence that joins it, a cut range loses leading space
            start += leading(text, start, int(ends[at]))
        stop = len(ends)
        for some in range(at, len(ends), most):
            beyond = np.flatnonzero(reach[some : some + most] > start + most)
            if len(beyond):
                stop = some + int(beyond[0])
                break
        end = int(ends[stop - 1]) if stop else 0
        if stop == len(ends):
            break
        if end > start:
            out.append((start, end))
        start = max(start, end - overlap)
        end = int(ends[stop])
        start += leading(text, start, end)
        while end - start > most:
            out.append((start, start + most))
            start += most - overlap
        at = stop + 1
    last = int(ends[-1]) if len(ends) else 0
    return [*out, (start, last)] if last > start else out


def leading(text: str, start: int, end: int) -> int:
    return end - start - len(text[start:end].lstrip())


def split_overlap(rows: DataFrame, most: int = MAX_CHARS, overlap: int = OVERLAP, on_error: str = "raise", types: tuple[str, ...] = ()) -> DataFrame:
    """rows with one row per piece of text, and its part (from 1). A null text is empty. types: rows of other types stay whole. on_error "warn" adds a column error,
    and keeps a row that can't be split with it. Only long texts go to the helper."""

    def cut(text: str, sentences: list[str]) -> list[dict]:
        first = next((i for i, s in enumerate(sentences) if s.strip()), len(sentences))
        some = [s.lstrip() if i == 0 else s for i, s in enumerate(sentences[first:])]
        bare = [s.rstrip() for s in some]
        whole = " ".join(b for b in bare if b)
        size = np.array([len(s) for s in sentences[first:]], np.int64)
        return [{"text": whole[a:b]} for a, b in overlap_offsets(size, np.array([len(b) for b in bare], np.int64), whole, most, overlap)]

    text = F.coalesce("text", F.lit(""))
    long = (F.length(text) > most) & (F.coalesce(F.col("type").isin(*types), F.lit(False)) if types else F.lit(True))
    some = lambda c: F.when(long, c)
    pieces = guarded(cut, on_error, "array<struct<text:string>>")(some(text), some(split_sentences(text, "periodic")))
    made = long_ones(rows, long, pieces, F.struct(text.alias("text")))
    return unfolded(made, "_made", ["text"], on_error).withColumn("part", F.col("_at") + 1).drop("_at")


class Buffers:
    """The buffer of each text: a new one at a break, and after one that outgrew `most` (a line break between texts)."""

    def __init__(self, most: int):
        self.most, self.n, self.size = most, 0, 0

    def push(self, new: bool, length: int) -> int:
        if self.size > self.most or new and self.size:
            self.n, self.size = self.n + 1, 0
        self.size += length + (1 if self.size else 0)
        return self.n


def flushes(breaks: list[bool], lengths: list[int], most: int) -> list[int]:
    buffers = Buffers(most)
    return [buffers.push(new, length) for new, length in zip(breaks, lengths)]


def buffered(blocks: DataFrame, most: int = MAX_CHARS) -> DataFrame:
    """Texts of one section without a table between them, joined; tables as they are: (rcept_no, pos, type, section_path, text).

    Blocks stream through sorted partitions; of a filing no more is held than the open buffer, `most` characters and a block.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffers, filing, before, number = Buffers(most), None, None, None
        held: pa.RecordBatch | None = None  # the texts of the open buffer
        for b in batches:
            start = held.num_rows if held is not None else 0
            if start:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            group, groups = list(range(start)), []  # numbers of rows that make one
            for i, (key, kind, path, length) in enumerate(zip(*(b.column(c).slice(start).to_pylist() for c in (KEY, "type", "_path", "_length"))), start):
                if key != filing:
                    buffers, filing, before = Buffers(most), key, None
                    groups += [group] if group else []
                    group, number = [], None
                if kind == "table":
                    groups.append([i])
                else:
                    now = buffers.push(before != ("text", path), length)
                    if now != number:
                        groups += [group] if group else []
                        group, number = [], now
                    group.append(i)
                before = (kind, path)
            yield joined(b, groups)
            held = b.take(pa.array(group, pa.int32())) if group else None
        if held is not None:
            yield joined(held, [list(range(held.num_rows))])

    def joined(b: pa.RecordBatch, groups: list[list[int]]) -> pa.RecordBatch:
        number = lambda some: pa.array(some, pa.int32())
        first, last, ends = number([g[0] for g in groups]), number([g[-1] for g in groups]), number([0, *accumulate(map(len, groups))])
        texts = pa.ListArray.from_arrays(ends, b.column("text").take(number([i for g in groups for i in g])))
        return pa.RecordBatch.from_arrays([*(b.column(c).take(first) for c in (KEY, "pos", "type")), b.column("section_path").take(last), pc.binary_join(texts, "\n")], [KEY, "pos", "type", "section_path", "text"])

    text = F.coalesce("text", F.lit(""))
    rows = blocks.where("type in ('text', 'table')").select(KEY, F.col("block_no").alias("pos"), "type", "section_path", text.alias("text"), F.to_json(F.struct("section_path")).alias("_path"), F.length(text).alias("_length"))
    kinds = f"{KEY} string, pos {rows.schema['pos'].dataType.simpleString()}, type string, section_path array<string>, text string"
    return rows.repartition(KEY).sortWithinPartitions(KEY, "pos").mapInArrow(join, kinds)


def chunk_ids(part: Column) -> Column:
    return F.concat(numbered_id(F.col(KEY), F.col("chunk_index")), F.coalesce(F.concat(F.lit("_p"), part.cast("string")), F.lit("")))


def chunk_periodic(blocks: DataFrame, meta: DataFrame, on_error: str = "raise") -> DataFrame:
    """Chunks of periodic blocks (with text). chunk_index counts tables and text pieces; parts of a table share theirs,
    and a large table without rows uses up a number. meta: document_metadata of family periodic. blocks may hold rows with
    an error: see failures.isolated."""

    def chunks(good: DataFrame) -> DataFrame:
        every = split_overlap(buffered(good), on_error=on_error, types=("text",)).withColumnRenamed("part", "piece")
        every = every.withColumn("chunk_index", F.row_number().over(Window.partitionBy(KEY).orderBy("pos", "piece")))
        large = F.coalesce((F.col("type") == "table") & (F.length("text") > TABLE_CHARS), F.lit(False))
        c = split_table(every, TABLE_CHARS, "periodic", only=large).drop("parts").join(meta, KEY)  # in one reading: every is dear
        errors = ["error"] if on_error == "warn" else []
        return c.select(chunk_ids(F.col("part")).alias("chunk_id"), "chunk_index", F.col("type").alias("chunk_type"), F.array_join("section_path", " > ").alias("section"), "n_chars", "text", *meta.columns, *errors)

    return isolated(blocks, chunks, on_error)


def rooms(texts: DataFrame, runs: DataFrame) -> DataFrame:
    """(form, _room): how long a filing's numbers may be for the runs of its form to stay whole. Below 0 where no length will do: a form
    with an error, or one whose numbers decide whether two texts are of one section."""
    limit, base = F.when(F.col("type") == "table", TABLE_CHARS).otherwise(MAX_CHARS), F.length(F.regexp_replace("text", MARK, ""))
    marks = F.size(F.split("text", OPEN, -1)) - 1
    room = F.when(base > limit, -1).when(marks == 0, ANY).otherwise(F.floor((limit - base) / marks))
    before = lambda c: F.lag(c).over(Window.partitionBy(KEY).orderBy("block_no"))
    marked = F.exists(F.concat("section_path", before("section_path")), lambda t: F.contains(t, F.lit(OPEN)))
    other = (F.col("type") == "text") & (before("type") == "text") & ~F.col("section_path").eqNullSafe(before("section_path"))
    unclear = F.col("error").isNotNull() | (other & F.coalesce(marked, F.lit(True)))
    both = runs.select(KEY, room.alias("_room")).union(texts.select(KEY, F.when(unclear, -1).otherwise(ANY)))
    return both.groupBy(F.col(KEY).alias("form")).agg(F.min("_room").alias("_room"))


def chunk_forms(texts: DataFrame, cases: DataFrame, meta: DataFrame, on_error: str = "raise") -> DataFrame:
    """As chunk_periodic, from the blocks (with text) of forms (operators.forms) and the filings that follow them.

    Where a buffer ends depends on lengths. By its numbers' greatest length most filings are known to stay within the limits: their chunks
    are the runs of their form, filled in. The others' blocks are filled in first, and chunked one filing at a time.
    """
    runs = staged(buffered(texts, ANY))
    longest = F.coalesce(F.array_max(F.transform("numbers", F.length)), F.lit(0))
    # a form without texts gives nothing either way
    known = cases.join(staged(rooms(texts, runs)), "form", "left").withColumn("_fits", F.coalesce(longest <= F.col("_room"), F.lit(True))).drop("_room")
    each = runs.select(KEY, F.row_number().over(Window.partitionBy(KEY).orderBy("pos")).alias("chunk_index"), F.col("type").alias("chunk_type"), F.array_join("section_path", " > ").alias("section"), "text")
    kept = [c for c in meta.columns if c != KEY]
    whole = refilled(each, known.where("_fits").join(meta, KEY), ("section", "text"), kept=tuple(kept)).withColumn("n_chars", F.length("text"))
    errors = [F.lit(None).cast("string").alias("error")] if on_error == "warn" else []
    whole = whole.select(chunk_ids(F.lit(None)).alias("chunk_id"), "chunk_index", "chunk_type", "section", "n_chars", "text", *meta.columns, *errors)
    rest = known.where("not _fits").drop("_fits")
    if rest.isEmpty():
        return whole
    made = chunk_periodic(refilled(texts, rest, ("text",), ("section_path",)), meta, on_error)
    return whole.unionByName(staged(made) if on_error == "warn" else made)  # errors are looked for in another reading
