"""How far the sources of a language stand apart, term by term, in exact integers.

Words are counted by task before anything is shuffled. Kept terms are numbered within hash ranges; a group (a language's
source) has, for each range, its sorted term ids and counts. A task meets two groups' arrays for each unordered
pair: a galloping intersection finds the shared terms, which are priced with both counts, the others of either side with
one, and terms that both lack by their number; the price holds both ways.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filingloom.llm.common import cut, small
from filingloom.llm.hashing import portions, text_bytes

#: Documents that a kept term has, weights are counted in, terms reported.
LEAST, UNIT, TOP = 10, 1_000_000_000, 10
#: UNIT as two factors: two short divisions take the place of one beyond 64 bits, up to 2.9e14 words of a group.
FIRST, SECOND = 31_250, 32_000
#: Terms of a range, groups of a tile (about): what a task holds of one side at most.
RANGE, TILE = 4096, 8
#: Bytes of text counted together, words remembered and pairs held before a task passes its counts on.
AT_ONCE, REMEMBER, HELD = 1 << 23, 600_000, 1 << 21
#: Rows of terms or groups that are broadcast at most.
SOME = 500_000

#: Bytes of terms as they are, A-Z as a-z, all else as a blank.
TERMS = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def summed(key: np.ndarray, *of: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, sorted, and the sums of each column over equal keys."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], *(np.add.reduceat(c[order], first) if len(first) else c[:0] for c in of)


def portioned(text: bytes) -> Iterator[list[bytes]]:
    """The words between blanks, of so many bytes at a time."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + AT_ONCE)
        yield text[at : end if end >= 0 else len(text)].split()
        at = end if end >= 0 else len(text)


def term_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, count, docs) by task, to be summed; a group's own row has a null term and counts its documents."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[bytes, int] = defaultdict(count(1).__next__)
        groups: dict[tuple[str, str], int] = {}
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            key, times, docs = summed(*map(np.concatenate, zip(*held)))
            names, terms = list(groups), pa.array([None, *words], pa.binary())
            g = pa.array(key >> 32)
            columns = [pa.array([n[i] for n in names], pa.string()).take(g) for i in (0, 1)]
            return pa.RecordBatch.from_arrays([*columns, terms.take(pa.array(key & 0xFFFFFFFF)), pa.array(times), pa.array(docs)], ["lang", "source", "term", "count", "docs"])

        for b in it:
            for a, z in portions(text_bytes(b.column(2))[1], AT_ONCE):
                rows = b.slice(a, z - a)
                group = np.array([groups.setdefault(k, len(groups)) for k in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())], np.int64)
                found, many = [], []
                for text in rows.column(2).to_pylist():
                    before = len(found)
                    for split in portioned(text.translate(TERMS)):
                        found.append(np.fromiter(map(words.__getitem__, split), np.int64, len(split)))
                    many.append(sum(map(len, found[before:])))
                at = np.repeat(np.arange(len(group), dtype=np.int64), many)
                key, times = summed(at << 32 | np.concatenate(found), np.ones(len(at), np.int64))
                held.append(((group << 32), np.zeros(len(group), np.int64), np.ones(len(group), np.int64)))
                held.append((group[key >> 32] << 32 | key & 0xFFFFFFFF, times, np.ones(len(key), np.int64)))
                if sum(len(h[0]) for h in held) > HELD:
                    held = [summed(*map(np.concatenate, zip(*held)))]
                if len(words) > REMEMBER or sum(len(h[0]) for h in held) > HELD // 2:
                    yield flush()
                    words, groups, held = defaultdict(count(1).__next__), {}, []
        if held:
            yield flush()

    read = documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text"))).withColumn("text", F.col("text").cast("binary"))
    return read.mapInArrow(batches, "lang string, source string, term binary, count long, docs long").withColumn("term", F.col("term").cast("string"))


def weight(count: str, n: str, v: str) -> Column:
    """1 + floor(UNIT * (count + 2) / (n + 2 v)), in 64 bits."""
    c, d = f"{FIRST} * ({count} + 2)", f"({n} + 2 * {v})"
    return F.expr(f"1 + {SECOND} * (({c}) div {d}) + ({SECOND} * (({c}) % {d})) div {d}")


def price(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def weights(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """As weight()."""
    d = n + 2 * v
    a, r = np.divmod(FIRST * (counts + 2), d)
    return 1 + SECOND * a + SECOND * r // d


def prices(p: np.ndarray, q: np.ndarray | int) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Where each item of short, sorted, would stand in long, sorted: items go on from where the first of their run of 64
    stands, in steps that double until they pass it, and halve then."""
    if not len(short):
        return np.zeros(0, np.int64)
    low = np.repeat(np.searchsorted(long, short[::64]), 64)[: len(short)]  # all before it is smaller
    step = np.ones(len(short), np.int64)
    padded = np.append(long, np.iinfo(np.int64).max)
    while True:
        high = np.minimum(low + step, len(long))
        more = padded[high] < short
        if not more.any():
            break
        low = np.where(more, high + 1, low)
        step = np.where(more, step * 2, step)
    while (low < high).any():
        mid = (low + high) // 2
        less = padded[mid] < short
        low, high = np.where(less & (low < high), mid + 1, low), np.where(less, high, np.minimum(high, mid))
    return low


def priced(x: tuple, y: tuple) -> tuple[int, int]:
    """Over the terms that at least one of two groups has: the summed price, and how many both have. A group is its sorted
    term ids, their weights, and the weight of a term that it lacks."""
    if len(x[0]) > len(y[0]):
        x, y = y, x
    at = gallop(x[0], y[0])
    inside = at < len(y[0])
    inside[inside] = y[0][at[inside]] == x[0][inside]
    there = at[inside]
    only = np.ones(len(y[0]), bool)
    only[there] = False
    total = prices(x[1][inside], y[1][there]).sum() + prices(x[1][~inside], y[2]).sum() + prices(y[1][only], x[2]).sum()
    return int(total), len(there)


def pair_prices(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Each unordered pair between the groups of two tiles, or within one, over one range of terms."""

    def groups(rows: pd.DataFrame) -> list[tuple]:
        out = []
        for r in rows.itertuples(index=False):
            ids, counts = (np.asarray(x if x is not None else [], np.int64) for x in (r.ids, r.counts))
            d = r.n + 2 * r.v
            out.append((r.source, r.n, (ids, weights(counts, r.n, r.v), int(weights(np.zeros(1, np.int64), r.n, r.v)[0])) if d else (ids, counts, 0), r.v))
        return out

    out = []
    if len(left) and len(right):
        same = left["a"].iloc[0] == left["b"].iloc[0]
        ys = groups(right)
        for x_source, x_n, x, v in groups(left):
            for y_source, y_n, y, _ in ys:
                if not same or x_source < y_source:
                    total, both = priced(x, y)
                    out.append((left["lang"].iloc[0], x_source, y_source, x_n, y_n, v, total, len(x[0]) + len(y[0]) - both))
    return pd.DataFrame(out, columns=["lang", "x", "y", "x_n", "y_n", "v", "value", "seen"])


def audit(documents: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` prices each other source of the language, part `term` the terms
    that a group has more of than its language, the dearest `top` of them.

    Null texts, languages and sources read as empty; texts without terms still make a group. Repeated rows are documents of
    their own; other columns are ignored; a language of one source has no pairs, an empty table gives no rows.
    Ties go to the smaller item by bytes.
    """
    counted = cut(term_counts(documents).groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs")))  # texts are read once
    terms = counted.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("total")).where(F.col("docs") >= least)
    terms = cut(terms.select("lang", "term", "total"))
    langs = cut(terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n")))
    terms = terms.join(small(langs, SOME), "lang").withColumn("range", F.pmod(F.xxhash64("term"), F.ceil(F.col("v") / RANGE)).cast("int"))
    terms = cut(terms.withColumn("id", F.row_number().over(Window.partitionBy("lang", "range").orderBy("term"))))
    rows = cut(counted.join(small(terms, SOME).select("lang", "term", "total", "range", "id"), ["lang", "term"], "left").where("term is null or id is not null"))
    held = rows.where("term is not null").select("lang", "source", "range", "id", "count")
    sums = held.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = rows.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left").join(small(langs, SOME), "lang", "left")
    groups = cut(groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "v", "lang_n"))))
    tiles = cut(groups.groupBy("lang").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")))
    by_id = F.sort_array(F.collect_list(F.struct("id", "count")))
    arrays = held.groupBy("lang", "source", "range").agg(by_id.alias("t")).select("lang", "source", "range", F.col("t.id").alias("ids"), F.col("t.count").alias("counts"))
    sides = groups.join(small(tiles, SOME), "lang").withColumn("tile", F.pmod(F.xxhash64("source"), "tiles").cast("int"))
    sides = sides.withColumn("range", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("v") / RANGE).cast("int") - 1))))
    sides = cut(sides.join(arrays, ["lang", "source", "range"], "left").select("lang", "range", "source", "n", "v", "ids", "counts", "tile", "tiles"))
    left = sides.withColumn("a", F.col("tile")).withColumn("b", F.explode(F.sequence("tile", F.col("tiles") - 1)))
    right = sides.withColumn("b", F.col("tile")).withColumn("a", F.explode(F.sequence(F.lit(0), "tile")))
    task = ["lang", "range", "a", "b"]
    met = left.groupBy(task).cogroup(right.groupBy(task)).applyInPandas(pair_prices, "lang string, x string, y string, x_n long, y_n long, v long, value long, seen long")
    pairs = met.groupBy("lang", "x", "y", "x_n", "y_n", "v").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    zero = F.lit(0).cast("long")
    pairs = pairs.withColumns({f"{c}_0": F.when(F.col("v") > 0, weight("0", f"{c}_n", "v")).otherwise(1) for c in "xy"})
    pairs = pairs.withColumn("value", F.col("value") + F.when(F.col("v") > 0, (F.col("v") - F.col("seen")) * price("x_0", "y_0")).otherwise(zero))
    ways = F.explode(F.array(F.struct(F.col("x").alias("source"), F.col("y").alias("item")), F.struct(F.col("y").alias("source"), F.col("x").alias("item"))))
    pairs = pairs.select("lang", ways.alias("w"), "value").select("lang", "w.source", F.lit("pair").alias("part"), "w.item", "value")
    mine = rows.where("term is not null").join(small(groups, SOME), ["lang", "source"])
    mine = mine.withColumn("p", weight("count", "n", "v")).withColumn("q", weight("total", "lang_n", "v")).where("count > 0 and p > q")
    mine = mine.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), price("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    return pairs.select("*", rank).union(mine.select("*", rank).where(F.col("rank") <= top))


SQL = r"""
    with d as (select row_number() over () n, coalesce(lang, '') lang, coalesce(source, '') source, coalesce("text", '') "text" from documents),
    t as (select n, lang, source, unnest(regexp_extract_all(translate("text", 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) term from d),
    k as (select lang, term, count(*) total from t group by all having count(distinct n) >= 10),
    c as (select lang, source, term, count(*) c from t group by all),
    l as (select lang, count(*) v, sum(total) lang_n from k group by all),
    g as (select distinct lang, source from d),
    x as (select g.lang, g.source, k.term, k.total, coalesce(c.c, 0) c from g join k using (lang) left join c using (lang, source, term)),
    s as (select lang, source, sum(c) n from x group by all),
    p as (select x.lang, x.source, x.term, x.c, 1 + (1000000000::hugeint * (c + 2)) // (n + 2 * v)::hugeint p, 1 + (1000000000::hugeint * (total + 2)) // (lang_n + 2 * v)::hugeint q
          from x join s using (lang, source) join l using (lang)),
    pairs as (select a.lang, a.source, b.source item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) "value" from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
    r as (select a.lang, a.source, 'pair' part, b.source item, coalesce("value", 0) "value" from g a join g b on a.lang = b.lang and a.source <> b.source left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source
          union all select lang, source, 'term', term, (p - q) * (p - q) // (p + q) from p where c > 0 and p > q),
    o as (select lang, source, part, item, cast("value" as bigint) "value", cast(row_number() over (partition by lang, source, part order by "value" desc, item) as integer) "rank" from r)
    select * from o where part = 'pair' or "rank" <= 10"""
