"""Vector codes: each quarter of a vector becomes the number of the nearest entry of that quarter's codebook.

Components become integers. Rows are kept as blocks in which each dimension is a dictionary of its distinct integers and
a code a row. To compare a block with a codebook, the squared differences of every dictionary value to all entries are
tabulated once; the rows' distances are gathers from these tables by code, and additions. Codebooks, of
a size that doesn't depend on the data, go to the driver; sums of integers agree in any order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filingloom.llm.common import cut, by_total

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Components of a block, and rows whose distances are added up together (tables and sums stay in the cache).
CELLS, AT_ONCE = 1 << 20, 512
#: Integers below NARROW fit the plain path. Beyond it, squares are sums of limbs of so many bits.
NARROW, LIMB = 1 << 31, 40
LARGEST = (1 << 63) - 1


@dataclass
class Block:
    """Codes (dims, rows), and the distinct integers of each dimension, as objects where some are wide."""

    codes: np.ndarray
    values: list[np.ndarray]


def whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), as 64-bit integers, or as Python's where some don't fit the plain path."""
    with np.errstate(over="ignore"):
        y = np.floor(SCALE * x)
    if not len(y) or np.abs(y).max() < NARROW:
        return y.astype(np.int64)
    return np.array([int(v) * SCALE if abs(v) >= 2**53 else int(w) for v, w in zip(x.tolist(), y.tolist())] or [0], object)[: len(y)]


def pack_block(q: np.ndarray) -> tuple[bytes, list[int], bytes, bool]:
    """A (rows, dims) matrix of integers: codes, sizes of the dictionaries, their values, and whether these are wide."""
    each = [np.unique(column, return_inverse=True) for column in q.T]
    values = np.concatenate([v for v, _ in each]) if each else np.zeros(0, np.int64)
    codes = np.array([c for _, c in each], "<u4").reshape(q.shape[1], q.shape[0])
    wide = values.dtype == object
    return codes.tobytes(), [len(v) for v, _ in each], ",".join(map(str, values)).encode() if wide else values.astype("<i8").tobytes(), wide


def read_block(codes: bytes, sizes: list[int], values: bytes, wide: bool, rows: int) -> Block:
    every = np.array([int(v) for v in values.decode().split(",")], object) if wide else np.frombuffer(values, "<i8")
    return Block(np.frombuffer(codes, "<u4").reshape(len(sizes), rows).astype(np.intp), np.split(every, np.cumsum(sizes)[:-1]) if len(sizes) else [])


def limbs_of(table: np.ndarray, n: int) -> list[np.ndarray]:
    return [((table >> (LIMB * i)) & ((1 << LIMB) - 1)).astype(np.int64) for i in range(n)]


def nearest(codes: np.ndarray, values: list[np.ndarray], entries: np.ndarray) -> tuple[np.ndarray, list[int] | np.ndarray]:
    """For each row of some dimensions (codes (dims, rows) into values), the entry at the least squared distance, the first of
    equal ones, and that distance. entries: (entries, dims)."""
    dims, rows = codes.shape
    best, least = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    if not dims or not rows:
        return best, least
    reach = max(max(abs(int(v[0])), abs(int(v[-1]))) for v in values) + max(abs(int(entries.min())), abs(int(entries.max())))
    bits = (dims * reach * reach).bit_length()
    n = 1 if bits < 63 else -(-bits // LIMB)
    tables: list[list[np.ndarray]] = []
    for v, e in zip(values, entries.T):
        if n == 1:
            difference = v.astype(np.int64)[:, None] - e.astype(np.int64)[None, :]
            tables.append([(difference * difference).astype(np.int32 if bits < 31 else np.int64)])
        else:
            difference = v.astype(object)[:, None] - e.astype(object)[None, :]
            tables.append(limbs_of(difference * difference, n))
    far: list[int] | np.ndarray = least if n == 1 else [0] * rows
    for at in range(0, rows, AT_ONCE):
        some = codes[:, at : at + AT_ONCE]
        total = [sum_up([t[i] for t in tables], some) for i in range(n)]
        for i in range(n - 1):
            total[i + 1] += total[i] >> LIMB
            total[i] &= (1 << LIMB) - 1
        live = np.ones(total[0].shape, bool)
        for t in reversed(total[1:]):  # the least by the highest limb, of those by the next, and so on
            live &= t == np.where(live, t, LARGEST).min(axis=1)[:, None]
        low = total[0] if n == 1 else np.where(live, total[0], LARGEST)
        b = low.argmin(axis=1)
        best[at : at + len(b)] = b
        row = np.arange(len(b))
        if n == 1:
            least[at : at + len(b)] = total[0][row, b]
        else:
            far[at : at + len(b)] = [sum(int(t[r, c]) << (LIMB * i) for i, t in enumerate(total)) for r, c in zip(row, b)]
    return best, far


def sum_up(tables: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
    """Rows of the tables, gathered by each dimension's codes, and added."""
    total = tables[0][codes[0]]
    held = np.empty_like(total)
    for t, c in zip(tables[1:], codes[1:]):
        total += np.take(t, c, axis=0, out=held, mode="clip")
    return total


def sums(block: Block, part: slice, best: np.ndarray, entries: int) -> np.ndarray:
    """(entries, 1 + dims): how many rows each entry has, and the sums of their components, as Python's integers or 64-bit ones."""
    count = np.bincount(best, minlength=entries)
    columns = [count]
    for v, c in zip(block.values[part], block.codes[part]):
        if v.dtype == object:
            s = np.zeros(entries, object)
            np.add.at(s, best, v[c])
        else:
            s = np.bincount(best, v[c], entries).astype(np.int64)  # whole and below 2 ** 52: exact
        columns.append(s)
    return np.array(columns).T


def complete(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is neither null nor holds a null or non-finite component."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    return vectors.where(F.col(vector).isNotNull() & finite)


def blocks(kept: DataFrame, dims: int, keep: list[str]) -> DataFrame:
    """Rows of `keep` (each an array by column) and x, as blocks; shorter vectors are filled up with zeros to dims components."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            step = max(1, CELLS // max(1, dims))
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                n, x = part.num_rows, part.column(part.num_columns - 1)
                length = np.diff(x.offsets.to_numpy())
                flat = whole(x.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
                q = np.zeros((n, dims), flat.dtype)
                q[np.arange(dims) < length[:, None]] = flat
                codes, sizes, values, wide = pack_block(q)
                lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), c) for c in part.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([codes]), pa.array([sizes], pa.list_(pa.int32())), pa.array([values], pa.binary()), pa.array([wide]), pa.array([n], pa.int32())], names)

    names = [*keep, "codes", "sizes", "values", "wide", "rows"]
    kinds = ", ".join(f"`{c}` array<{kept.schema[c].dataType.simpleString()}>" for c in keep)
    return kept.select(*keep, "x").mapInArrow(batches, f"{kinds}, codes binary, sizes array<int>, values binary, wide boolean, rows int")


def assigned(block: Block, books: list[np.ndarray]) -> list[tuple[np.ndarray, list[int] | np.ndarray]]:
    width = len(block.values) // PARTS
    return [nearest(block.codes[p * width : (p + 1) * width], block.values[p * width : (p + 1) * width], book) for p, book in enumerate(books)]


def refined(held: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round: each entry the floor of its rows' mean; entries without rows stay."""

    def count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: list = [0] * PARTS
        for b in it:
            for r in b.itertuples(index=False):
                block = read_block(r.codes, r.sizes, r.values, r.wide, r.rows)
                for p, (best, _) in enumerate(assigned(block, books)):
                    width = books[p].shape[1]
                    total[p] = total[p] + sums(block, slice(p * width, (p + 1) * width), best, len(books[p]))
        out = []
        for p, table in enumerate(total):
            if isinstance(table, np.ndarray):
                for (entry, place), v in np.ndenumerate(table):
                    v, limb = int(v), 0
                    while not -(1 << LIMB) < v < 1 << LIMB:
                        out.append((p, entry, place, limb, v & ((1 << LIMB) - 1)))
                        v, limb = v >> LIMB, limb + 1
                    out.append((p, entry, place, limb, v))
        yield pd.DataFrame(out, columns=["part", "entry", "place", "limb", "s"]).astype("int64")

    found = held.select("codes", "sizes", "values", "wide", "rows").mapInPandas(count, "part long, entry long, place long, limb long, s long")
    table: dict[tuple[int, int, int], int] = {}
    for r in found.groupBy("part", "entry", "place", "limb").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():  # as many as the codebooks have integers
        at = r["part"], r["entry"], r["place"]
        table[at] = table.get(at, 0) + (int(r["s"]) << (LIMB * r["limb"]))
    new = []
    for p, book in enumerate(books):
        rows = [[table[p, e, 1 + j] // table[p, e, 0] for j in range(book.shape[1])] if table.get((p, e, 0)) else book[e].tolist() for e in range(len(book))]
        new.append(tidy(rows, book.shape))
    return new


def tidy(rows: list[list[int]], shape: tuple[int, int]) -> np.ndarray:
    wide = any(abs(v) >= NARROW for r in rows for v in r)
    return np.array(rows, object if wide else np.int64).reshape(shape)


def compress(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256, label of every complete vector.

    Codebooks start from the ENTRIES smallest keys (nulls last, equal keys by their vectors), fewer if there are fewer rows.
    Vectors of unlike lengths are filled up with zeros to the longest, and that to a multiple of PARTS. Any finite component is
    exact; an error beyond 64 bits is given as the largest such integer. Repeated rows are rows of their own; other columns
    are ignored; no complete vectors, no rows.
    """
    spark = vectors.sparkSession
    kept = complete(vectors, vector).select(F.col(key).alias("vec_id"), F.col(label).alias("label"), F.transform(vector, lambda v: v.cast("double")).alias("x"))
    if kept.rdd.getNumPartitions() < spark.sparkContext.defaultParallelism:
        kept = kept.repartition(2 * spark.sparkContext.defaultParallelism)
    longest = kept.agg(F.max(F.size("x"))).first()[0] or 0
    dims = -(-longest // PARTS) * PARTS
    held = cut(blocks(kept, dims, ["vec_id", "label"]))
    first = [r["x"] for r in kept.orderBy(F.col("vec_id").asc_nulls_last(), "x").select("x").limit(ENTRIES).collect()]
    start = [whole(np.array(list(x) + [0.0] * (dims - len(x)))).tolist() for x in first]
    width = dims // PARTS
    books = [tidy([r[p * width : (p + 1) * width] for r in start], (len(start), width)) for p in range(PARTS)]
    for _ in range(ROUNDS if first else 0):
        books = refined(held, books)
    digest = hashlib.sha256(",".join(str(v) for book in books for e in book.tolist() for v in e).encode()).hexdigest()

    def code(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hexes = np.array([f"{i:02x}" for i in range(256)], object)
        for b in it:
            for i in range(b.num_rows):
                r = b.slice(i, 1)
                codes, sizes, values, wide, rows = (c[0].as_py() for c in r.columns[2:])
                each = assigned(read_block(codes, sizes, values, wide, rows), books)
                text = sum((hexes[best] for best, _ in each[1:]), hexes[each[0][0]])
                error = [min(LARGEST, sum(map(int, e))) for e in zip(*(far for _, far in each))]
                yield pa.RecordBatch.from_arrays([r.column(0).flatten(), r.column(1).flatten(), pa.array(text, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])

    kinds = {c: kept.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    rows = cut(held.select("vec_id", "label", "codes", "sizes", "values", "wide", "rows").mapInArrow(code, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"))
    totals = rows.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST)).cast("long").alias("label_error"), F.count("*").alias("n"))
    out = by_total(rows, totals, "label", "n")
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"), "label")


def sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same rows of `embeddings`, as one SQL statement: a step for each assignment and each new codebook."""
    steps = [
        "k as (select row_number() over (order by vec_id) n, vec_id, label, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) q from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        f"v as (select n, p, list_slice(q, p * (len(q) // {parts}) + 1, (p + 1) * (len(q) // {parts})) x from k, range({parts}) r(p))",
        f"b0 as (select p, n - 1 e, x c from v where n <= {entries})",
    ]
    for i in range(rounds + 1):
        d = "cast(list_inner_product(x::double[], x::double[]) - 2 * list_inner_product(x::double[], c::double[]) + list_inner_product(c::double[], c::double[]) as bigint)"
        steps.append(f"a{i} as materialized (select n, p, x, min((d, e))[1] d, min((d, e))[2] e from (select n, v.p, x, e, {d} d from v join b{i} b on v.p = b.p) group by n, p, x)")
        if i < rounds:
            steps.append(f"s{i} as (select p, e, j, sum(y)::bigint s, count(*) m from (select p, e, unnest(x) y, generate_subscripts(x, 1) j from a{i}) group by p, e, j)")
            steps.append(f"n{i} as (select p, e, list((s - ((s % m) + m) % m) // m order by j) c from s{i} group by p, e)")
            steps.append(f"b{i + 1} as materialized (select b.p, b.e, coalesce(n.c, b.c) c from b{i} b left join n{i} n on n.p = b.p and n.e = b.e)")
    steps.append(f"h as (select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) h from b{rounds})")
    steps.append(f"w as (select n, string_agg(format('{{:02x}}', e), '' order by p) code, sum(d)::bigint error from a{rounds} group by n)")
    last = "select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) label_error, h codebooks_sha256, label from k join w using (n), h"
    return f"with {', '.join(steps)} {last}"
