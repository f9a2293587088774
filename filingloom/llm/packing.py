"""Packing documents into sequences: shortest pack first over the histogram of lengths.

Documents are cut into full sequences and a rest. The rests' lengths are counted, and their counts placed, longest
lengths first, each into the packs with the most room, whose pattern they extend. As many packs are open from
the start as all tokens fill, the last of them of sizes that are powers of two: where a length doesn't
fit into the emptiest pack, it is cut there, and what is left waits among the shorter lengths. So no token of
padding is left. Patterns hold ranges of ranks, by which they meet the documents again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingloom.llm.common import cut, small
from filingloom.llm.hashing import portions, text_bytes

SIZE = 2048
#: Id after each document.
END = 1
#: Bytes of text tokenised together, words whose ids a worker remembers, characters of a word worth remembering.
AT_ONCE, REMEMBER, SHORT = 1 << 22, 300_000, 48
#: Rows of the tables of ranks and of patterns that are broadcast at most.
SOME = 300_000

#: The normaliser and pre-tokeniser that `Words` takes the place of, as the tokenizer's file states them.
NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
#: Characters that are in no need of normalisation but for their case, and the pre-tokeniser over them (lower case).
LETTERS = "a-zÀ-ÖØ-öø-ſ"
PLAIN = re.compile("[\t-\r -~¡-©«-±´¶-¸»¿À-ſ]*")
PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\t-\r 0-9{LETTERS}]+")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


class Words(dict):
    """Words of the pre-tokeniser, lower case, to their ids (little-endian, 32 bits); the library's model finds those of new words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = [t["content"] for t in spec["added_tokens"]]
        self.known = spec["normalizer"] == NORMAL and spec["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [SPLIT, BYTES]} and all(t.startswith("<|") and not WORDS.sub("", t) for t in added)
        byte = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {c: byte.pre_tokenize_str(chr(c))[0][0] for c in range(161, 0x180)}
        self.bytes[0x307] = byte.pre_tokenize_str("̇")[0][0]  # what İ leaves behind in lower case

    def __missing__(self, word: str) -> bytes:
        ids = np.array([t.id for t in self.model.tokenize(word.translate(self.bytes))], "<u4").tobytes()
        if len(word) <= SHORT:
            if len(self) > REMEMBER:
                self.clear()
            self[word] = ids
        return ids

    def library(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, PARTS.findall(text.lower())))

    def ids(self, text: str) -> bytes:
        """The ids that the library gives to a text. White space separates words for it, so words that hold other characters
        than plain ones, or what may be a special token, can go to the library one by one."""
        if not self.known:
            return self.library(text)
        if PLAIN.fullmatch(text) and "<|" not in text:
            return self.plain(text)
        return b"".join(self.plain(w) if PLAIN.fullmatch(w) and "<|" not in w else self.library(w) for w in WORDS.findall(text))


LOADED: dict[str, Words] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def coded(documents: DataFrame, path: str | None = None, size: int = SIZE, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep_<name>, doc_tokens, start, length, part, at, ids: rows of at most `size` ids, full ones and one rest a document.

    part is the task, at the row's place among the task's rows of that length: ranks without a shuffle. A
    task that is run again numbers its rows alike.
    """

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = path or tokenizer_path()
        words = LOADED.setdefault(where, None) or LOADED.__setitem__(where, Words(where)) or LOADED[where]
        seen, part, end = np.zeros(size + 1, np.int64), TaskContext.get().partitionId(), np.array([END], "<u4").tobytes()
        for b in it:
            for a, z in portions(text_bytes(b.column(b.num_columns - 1))[1], AT_ONCE):
                rows = b.slice(a, z - a)
                raw = [words.ids(t or "") + end for t in rows.column(rows.num_columns - 1).to_pylist()]
                n = np.array([len(r) // 4 for r in raw], np.int64)
                many = -(-n // size)
                row = np.repeat(np.arange(len(raw)), many)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)) * size
                length = np.minimum(n[row] - start, size)
                at = np.empty(len(row), np.int64)
                order = np.argsort(length, kind="stable")
                some, first, count = np.unique(length[order], return_index=True, return_counts=True)
                at[order] = np.arange(len(row)) - np.repeat(first, count) + np.repeat(seen[some], count)
                seen[some] += count
                ids = [raw[r][4 * s : 4 * (s + k)] for r, s, k in zip(row.tolist(), start.tolist(), length.tolist())]
                kept = [c.take(pa.array(row)) for c in rows.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(n[row]), pa.array(start), pa.array(length, pa.int32()), pa.array(np.full(len(row), part, np.int32)), pa.array(at), pa.array(ids, pa.binary())], names)

    rows = documents.select(*(F.col(c).alias(f"keep_{c}") for c in keep), F.col(text).cast("string").alias("text"))
    names = [*rows.columns[:-1], "doc_tokens", "start", "length", "part", "at", "ids"]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(batches, f"{kinds}, doc_tokens long, start long, length int, part int, at long, ids binary")


def place(counts: dict[int, int], size: int = SIZE) -> tuple[list[tuple[int, int, int, int, int, int, int]], int]:
    """Patterns for rests of these lengths, and the number of packs.

    A row (rest, low, high, start, length, pack, offset) says: rests of that length with ranks from low to below high put
    `length` of their ids, from `start` on, at `offset` of the packs from `pack` on, one each. All packs get filled: they
    are as large as all rests together. Work and rows depend on the lengths that occur, hardly on how often.
    """
    whole, left = divmod(sum(length * n for length, n in counts.items()), size)
    room: list[list[tuple[int, int, int]]] = [[] for _ in range(size + 1)]  # (pack, how many, filled), by what is free
    if whole:
        room[size].append((0, whole, 0))
    packs = whole
    for bit in reversed(range(left.bit_length())):
        if left >> bit & 1:
            room[1 << bit].append((packs, 1, 0))
            packs += 1
    waiting: list[list[tuple[int, int, int, int]]] = [[] for _ in range(size + 1)]  # (rest, rank, how many, start), by length
    for length, n in counts.items():
        waiting[length].append((length, 0, n, 0))
    out, most = [], size
    for length in range(size, 0, -1):
        while waiting[length]:
            rest, rank, n, start = waiting[length].pop()
            while n:
                while not room[most]:
                    most -= 1  # the emptiest packs have so much room: it only ever falls
                pack, many, filled = room[most].pop()
                k, put = min(n, many), min(length, most)
                out.append((rest, rank, rank + k, start, put, pack, filled))
                if many > k:
                    room[most].append((pack + k, many - k, filled))
                if most > put:
                    room[most - put].append((pack, k, filled + put))
                if length > put:
                    waiting[length - put].append((rest, rank, k, start + put))
                rank, n = rank + k, n - k
    return out, packs


def pack(documents: DataFrame, path: str | None = None, size: int = SIZE, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, start, length, doc_tokens, sequence_id, offset, ids (binary: little-endian unsigned 32-bit ids) of every piece.

    Each document is its ids and the id END; a null or empty text is END alone. Repeated rows are documents of their own,
    ids of rows may be null; an empty table gives no rows, and other columns are left out. Sequences hold `size` ids but
    for at most one each of the smaller powers of two; equal lengths are ranked by task and order of reading.
    """
    spark = documents.sparkSession
    rows = cut(coded(documents, path, size, text, keep))
    rests = rows.where(F.col("length") < size)
    by = cut(rests.groupBy("length", "part").agg(F.count("*").alias("n")))
    patterns, packs = place({r["length"]: r["n"] for r in by.groupBy("length").agg(F.sum("n").alias("n")).collect()}, size)  # fewer than `size` rows
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranks = cut(by.select(F.col("length").alias("_length"), F.col("part").alias("_part"), before.alias("_before")))
    found = cut(spark.createDataFrame(patterns, "_rest int, _low long, _high long, _start int, _put int, _pack long, offset long"))
    ranked = rests.join(small(ranks, SOME), F.expr("length = _length and part = _part")).withColumn("_rank", F.col("_before") + F.col("at"))
    placed = ranked.join(small(found, SOME), F.expr("length = _rest and _rank >= _low and _rank < _high"))
    names = [F.col(f"keep_{c}").alias(c) for c in keep]
    pieces = placed.select(*names, (F.col("start") + F.col("_start")).alias("start"), F.col("_put").cast("long").alias("length"), "doc_tokens", (F.col("_pack") + F.col("_rank") - F.col("_low")).alias("sequence_id"), "offset", F.expr("substring(ids, 4 * _start + 1, 4 * _put)").alias("ids"))
    own = F.lit(packs) + F.shiftleft(F.col("part").cast("long"), 32) + F.col("at")
    full = rows.where(F.col("length") == size).select(*names, "start", F.col("length").cast("long").alias("length"), "doc_tokens", own.alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids")
    return full.union(pieces)


def sequences(pieces: DataFrame, size: int = SIZE, pad: int = 0) -> DataFrame:
    """(sequence_id, ids, lengths): the ids of each sequence, padded to `size` unless they are a power of two, and its
    pieces' lengths in order, which masks are made of. No sequence has more than `size` pieces."""
    parts = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    ids = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    n = F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"])
    padded = F.when(F.bit_count("n") == 1, F.col("ids")).otherwise(F.rpad("ids", F.lit(4 * size), F.lit(int(pad).to_bytes(4, "little"))))
    return parts.select("sequence_id", ids.alias("ids"), F.transform("p", lambda x: x["length"]).alias("lengths"), n.alias("n")).select("sequence_id", padded.alias("ids"), "lengths")


def digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
