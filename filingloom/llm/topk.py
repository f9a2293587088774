"""Exact top-k by inner product over a bit-sliced index."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingloom.llm.common import cut

#: Rows of an index block at most, its components at most, queries of a query block, and queries scored at once; they bound a
#: task's memory.
BLOCK, CELLS, ASKED, AT_ONCE = 65536, 1 << 22, 16384, 64
#: Largest component of a narrow row, so that scores of vectors of up to 2 ** 23 components fit into 64 bits. Rows with
#: larger ones are wide: scored one by one, in integers of any size.
LARGEST = 2**20
LIMIT = 1 << 63


def quantised(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, q array<long>, x array<double>) of every row that takes part: floor(64 x) of each component, or, in wide rows,
    the components themselves. A vector that is null, or holds a null or non-finite component, takes no part, nor does one
    without an id. Rows of one id are rows of their own."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    whole = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    kept = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole).select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    wide = F.exists("x", lambda v: F.abs(v) * 64 > LARGEST)
    return kept.select("row", "vec_id", F.when(~wide, F.transform("x", lambda v: F.floor(v * 64).cast("long"))).alias("q"), F.when(wide, F.col("x")).alias("x"))


def exact(x: list[float]) -> list[int]:
    """floor(64 x) of each component, of any size."""
    return [int(v) * 64 if abs(v) >= 2**53 else math.floor(v * 64) for v in x]


def product(one: list[int], two: list[int]) -> int:
    return sum(a * b for a, b in zip(one, two))


def sortable(score: int) -> bytes:
    """Bytes that sort as the scores do: of finite doubles no score has more bits."""
    return (score + (1 << 2175)).to_bytes(272, "big")


def planes(up: np.ndarray, bits: int) -> np.ndarray:
    """Non-negative attributes (rows, dims) as bitmaps (dims, bits, words), one attribute at a time."""
    up = np.pad(up.astype(np.uint64), ((0, -len(up) % 64), (0, 0)))
    each = [np.packbits(((column[None, :] >> np.arange(bits, dtype=np.uint64)[:, None]) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little") for column in up.T]
    return np.ascontiguousarray(each).view(np.uint64)


def slices(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices of x - min and of max - x for each attribute: a negative weight adds the second."""
    low, high = q.min(axis=0), q.max(axis=0)
    bits = max(1, int((high - low).max()).bit_length())
    return planes(q - low, bits), planes(high - q, bits)


def scores_by_slice(index: tuple[np.ndarray, np.ndarray], weights: np.ndarray) -> list[np.ndarray]:
    """Slices, lowest first, of each query's score less a constant of its own: (queries, words) each.

    Multiplication is shift and add; each addition is a ripple of and/xor over whole bitmaps.
    """
    rising, falling = index
    dims, bits, words = rising.shape
    size = np.abs(weights)
    full, none = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0)
    zero = np.zeros((len(weights), words), np.uint64)
    total: list[np.ndarray] = [zero]
    for j in range(dims):
        up, down = weights[:, j] > 0, weights[:, j] < 0
        attribute = [np.where(up[:, None], rising[j, s][None, :], falling[j, s][None, :]) for s in range(bits)]
        for b in range(int(size[:, j].max(initial=0)).bit_length()):
            on = np.where(((size[:, j] >> b) & 1).astype(bool) & (up | down), full, none)[:, None]
            carry = None
            for s in range(bits):
                x, at = attribute[s] & on, b + s
                while len(total) <= at:
                    total.append(zero)
                half = total[at] ^ x
                new = total[at] & x if carry is None else (total[at] & x) | (half & carry)
                total[at] = half if carry is None else half ^ carry
                carry = new
            at = b + bits
            while carry.any():
                while len(total) <= at:
                    total.append(zero)
                total[at], carry, at = total[at] ^ carry, total[at] & carry, at + 1
    return total


def top_rows(total: list[np.ndarray], part: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """From the most significant slice down: bitmaps of rows surely in, and of rows tied at the boundary."""
    sure, tied = np.zeros_like(part), part.copy()
    n_sure = np.zeros(len(part), np.int64)
    for s in reversed(total):
        ones = tied & s
        n = n_sure + np.bitwise_count(ones).sum(axis=1, dtype=np.int64)
        few = (n <= k)[:, None]
        sure = np.where(few, sure | ones, sure)
        tied = np.where(few, tied & ~s, ones)
        n_sure = np.where(few[:, 0], n, n_sure)
    return sure, tied


def block_top(rows: np.ndarray, ids: np.ndarray, q: np.ndarray, asked: tuple[np.ndarray, np.ndarray, np.ndarray], k: int) -> list[tuple]:
    """(query's row, query_id, vec_id, score) of each query's k best rows of this block; rows come sorted by id."""
    own, query_ids, queries = asked
    total = scores_by_slice(slices(q), queries)
    words = total[0].shape[1]
    live = np.zeros(words * 64, np.uint8)
    live[: len(ids)] = 1
    part = np.repeat(np.packbits(live, bitorder="little").view(np.uint64)[None, :], len(queries), axis=0)
    at = {r: i for i, r in enumerate(rows.tolist())}
    for i, r in enumerate(own.tolist()):
        if r in at:
            part[i, at[r] // 64] &= ~(np.uint64(1) << np.uint64(at[r] % 64))
    sure, tied = top_rows(total, part, k)
    found = []
    for i in range(len(queries)):
        best = np.flatnonzero(np.unpackbits(sure[i].view(np.uint8), bitorder="little"))
        edge = np.flatnonzero(np.unpackbits(tied[i].view(np.uint8), bitorder="little"))[: k - len(best)]  # equal scores: smaller ids first
        best = np.concatenate([best, edge])
        found += zip([int(own[i])] * len(best), [int(query_ids[i])] * len(best), ids[best].tolist(), (q[best] @ queries[i]).tolist())
    return found


def wide_pairs(q: DataFrame, k: int, query_every: int) -> DataFrame:
    """(row, query_id, vec_id, score, exact): of each query the k best among the pairs in which it or the candidate is wide. The
    wide rows, few or many, are dealt into blocks; all others meet each block."""
    blocks = max(1, -(-q.where("x is not null").count() // 256))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    wide = q.where("x is not null").select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("b"), "row", "vec_id", "x")
    parts = 4 * q.sparkSession.sparkContext.defaultParallelism
    every_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    rows = q.select(every.alias("b"), F.pmod(F.xxhash64(F.lit(3), "row"), F.lit(parts)).cast("int").alias("p"), "row", "vec_id", "q", "x")

    def meet(held: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        best: dict[int, list[tuple]] = {}

        def pair(own: int, query: int, candidate: int, score: int) -> None:
            heap = best.setdefault(own, [])
            heapq.heappush(heap, (score, -candidate, query))
            if len(heap) > k:
                heapq.heappop(heap)

        big = [(int(r), int(v), exact(x)) for r, v, x in zip(held["row"], held["vec_id"], held["x"])]
        for row, vec_id, q, x in zip(others["row"], others["vec_id"], others["q"], others["x"]):
            mine = exact(x) if q is None else q.tolist()
            for r, v, y in big:
                if r == row:
                    continue
                score = product(mine, y)
                if vec_id % query_every == 0:
                    pair(int(row), int(vec_id), v, score)
                if q is not None and v % query_every == 0:  # two wide rows meet twice, so each asks once
                    pair(r, v, int(vec_id), score)
        out = [(own, query, -candidate, max(-LIMIT, min(LIMIT - 1, s)), sortable(s)) for own, some in best.items() for s, candidate, query in some]
        return pd.DataFrame(out, columns=["row", "query_id", "vec_id", "score", "exact"]).astype({c: "int64" for c in ("row", "query_id", "vec_id", "score")})

    placed = wide.withColumn("p", every_part)
    return placed.groupBy("b", "p").cogroup(rows.groupBy("b", "p")).applyInPandas(meet, "row long, query_id long, vec_id long, score long, exact binary")


def exact_top_k(vectors: DataFrame, k: int = 20, query_every: int = 20, block: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each row whose id is divisible
    by query_every with all other rows; ties go to the smaller vec_id. A query's own row is left out, other rows of its
    id aren't; each row of a repeated id asks for itself. A score beyond 64 bits ranks by its value and is given as the nearest long.

    Vectors are dealt into blocks by a hash; a query block meets each index block once (cogrouped by the
    two blocks' numbers), and only k rows a query leave a block. They travel in the narrowest integers that hold them.
    Vectors of other lengths than the query's meet as if they ended in zeros. No vectors, no rows.
    """
    both = cut(quantised(vectors))
    q = both.where("q is not null")
    n, dims, largest = q.agg(F.count("*"), F.max(F.size("q")), F.max(F.array_max(F.transform("q", F.abs)))).first()
    kind = "tinyint" if (largest or 0) < 128 else "smallint" if largest < 32768 else "int"
    block = block or max(1024, min(BLOCK, CELLS // max(1, dims or 0), -(-n // (2 * vectors.sparkSession.sparkContext.defaultParallelism))))
    blocks, askers = max(1, -(-n // block)), max(1, -(-n // (query_every * ASKED)))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    short = F.col("q").cast(f"array<{kind}>").alias("q")
    rows = q.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("b"), every(askers).alias("a"), "row", "vec_id", short)
    asks = q.where(F.col("vec_id") % query_every == 0).select(every(blocks).alias("b"), F.pmod(F.xxhash64(F.lit(7), "row"), F.lit(askers)).cast("int").alias("a"), F.col("row").alias("own"), F.col("vec_id").alias("query_id"), short.alias("w"))

    def matrix(v: pd.Series) -> np.ndarray:
        out = np.zeros((len(v), max(1, dims or 0)), np.int64)
        for i, x in enumerate(v):
            out[i, : len(x)] = x
        return out

    def meet(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(index) and len(asked):
            index = index.sort_values(["vec_id", "row"])
            held = index["row"].to_numpy(), index["vec_id"].to_numpy(), matrix(index["q"])
            asked = asked.sort_values("own")
            for at in range(0, len(asked), AT_ONCE):
                some = asked.iloc[at : at + AT_ONCE]
                out += block_top(*held, (some["own"].to_numpy(), some["query_id"].to_numpy(), matrix(some["w"])), k)
        return pd.DataFrame(out, columns=["row", "query_id", "vec_id", "score"]).astype("int64")

    found = rows.groupBy("b", "a").cogroup(asks.groupBy("b", "a")).applyInPandas(meet, "row long, query_id long, vec_id long, score long")
    score = [F.desc("score")]
    if both.where("x is not null").limit(1).count():
        bits = F.lpad(F.unhex(F.hex(F.col("score"))), 272, b"\x00")
        narrow = F.when(F.col("score") >= 0, F.overlay(bits, F.lit(b"\x80"), 1, 1)).otherwise(F.concat(F.lit(b"\x7f" + b"\xff" * 263), F.substring(bits, 265, 8)))
        found = found.withColumn("exact", narrow).union(wide_pairs(both, k, query_every))
        score = [F.desc("exact")]
    best = Window.partitionBy("row").orderBy(*score, "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
