"""Helpers that the operators share: tables, cut lineage, class labels of links."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from filingloom.sources import staged

#: The six ASCII white-space characters that separate words everywhere in this subpackage.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and reads it back: short lineage, column pruning, sizes known to the planner."""
    return staged(df)


def taken(df: DataFrame, *names: str) -> list[str]:
    """Names like these that df has no column of, whatever the case."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out


def running(n: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str, block: int = 256) -> Column:
    """array<kind> of n items: step(at, i) gives the position after item i, and the item; at starts from 0.

    Appending to an array copies it, so items are gathered in blocks, whose arrays are joined at the end: the work
    grows with the items, not with their square.
    """

    def one(acc: Column, i: Column) -> Column:
        at, item = step(acc["at"], i)
        return F.struct(at.alias("at"), F.array_append(acc["out"], item).alias("out"))

    def some(acc: Column, first: Column) -> Column:
        zero = F.struct(acc["at"].alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(F.sequence(first, F.least(first + block, n) - 1), zero, one, lambda a: F.struct(a["at"].alias("at"), F.array_append(acc["out"], a["out"]).alias("out")))

    firsts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(block))).otherwise(F.array().cast("array<int>"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    return F.aggregate(firsts, zero, some, lambda a: F.flatten(a["out"]))


def positions(gaps: str, hits: str) -> Column:
    """array<struct<start,end>> of the hits that stand between the gaps of a text, in code points, ends excluded."""

    def step(at: Column, i: Column) -> tuple[Column, Column]:
        start = at + F.length(F.get(gaps, i))
        end = start + F.length(F.get(hits, i))
        return end, F.struct(start.alias("start"), end.alias("end"))

    return running(F.least(F.size(hits), F.size(gaps)), step, "struct<start:int,end:int>")


def connected(links: DataFrame) -> DataFrame:
    """Links (a, b) to (node, root): root is the smallest node reachable. Nodes without links don't appear.

    Alternating large-star and small-star steps; each is one grouping whose minimum is
    pre-aggregated, so a node with very many links doesn't meet in one task as a list.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large-star: a node's larger neighbours move to its smallest neighbour
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small-star: a node and its smaller neighbours move to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = cut(small.where("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
        before = now


def words(text: str = "text") -> Column:
    """The words of a text; none for a null or blank one."""
    bare = F.btrim(F.col(text), F.lit(BLANKS))
    return F.when(F.length(bare) > 0, F.split(bare, r"[\x20\x09-\x0D]+", -1)).otherwise(F.array().cast("array<string>"))


#: Bytes of texts and arrays that a broadcast side may hold.
BROADCAST_BYTES = 64 << 20


def small(df: DataFrame, most: int) -> DataFrame:
    """df, marked for broadcast only if it is counted to have at most so many rows, whose texts, arrays and the like are
    measured to hold at most BROADCAST_BYTES; else Spark shuffles both sides."""
    if df.limit(most + 1).count() > most:
        return df
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    wide = [F.octet_length(c) for c, k in kinds.items() if k in ("string", "binary")] + [F.octet_length(F.to_json(F.struct(c))) for c, k in kinds.items() if k in ("array", "map", "struct")]
    if wide and (df.agg(sum((F.coalesce(F.sum(w), F.lit(0)) for w in wide), F.lit(0))).first()[0] or 0) > BROADCAST_BYTES:
        return df
    return F.broadcast(df)


def numbered(rows: DataFrame, name: str, *order: Column) -> DataFrame:
    """rows with their places in an order, from 0, as column `name`. Ranges are sorted each on its own and follow one another by
    their sums, so no task sees all rows; rows that tie in the order stay in one range."""
    part, before = taken(rows, "part", "before")
    ranged = cut(rows.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    sums = ranged.groupBy(part).agg(F.count("*").alias(before))  # a row for each range
    sums = sums.select(part, F.coalesce(F.sum(before).over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))
    at = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1 + F.col(before)
    return ranged.join(F.broadcast(cut(sums)), part).withColumn(name, at.cast("long")).drop(part, before)


def by_total(rows: DataFrame, totals: DataFrame, key: str, n: str, parts: int = 10_000) -> DataFrame:
    """rows with the other columns of totals (one row a key, nulls a key too; n: how many of the rows it has).

    Keys of more than one in `parts` of all rows, at most `parts` of them, are broadcast; the others, none of which is
    hot, meet by a shuffle.
    """
    totals = cut(totals)
    most = (totals.agg(F.sum(n)).first()[0] or 0) / parts
    other = totals.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_{c}") for c in totals.columns if c != key))
    values = [f"_{c}" for c in totals.columns if c != key]
    hot = rows.join(F.broadcast(other.where(F.col(f"_{n}") > most)), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    names = [F.col(c).alias(c.removeprefix("_")) if c in values else F.col(c) for c in hot.columns]
    cold = hot.where(F.col(f"_{n}").isNull()).drop(*values).join(other.where(F.col(f"_{n}") <= most), F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
    return hot.where(F.col(f"_{n}").isNotNull()).select(names).union(cold.select(names))
