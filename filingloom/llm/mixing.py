"""Mixing sources to target weights by entropy balancing.

Each document starts with rate 1. Subject to one token constraint a source, the rates nearest to that
in relative entropy are exp(lambda_s x), x being the document's size over its source's mean size, held
below MOST copies. The dual is convex; Newton steps find every source's lambda at once, each step one
distributed grouping over (source, size) strata. Rates are then rounded into whole copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from filingloom.llm.common import WORD, cut, numbered

#: A document's copies at most, and so a source's growth; Newton's relative tolerance and steps at most.
MOST, TOLERANCE, STEPS = 3, 1e-6, 60
#: Documents of a stratum that are ranked together; larger strata are split by a hash, very large ones into as many parts as
#: each has documents.
RANKED = 256


def sizes(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return documents.select("doc_id", "source", *(F.col(c).alias(f"keep_{c}") for c in keep), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64("doc_id", "text").alias("h"))


def targets(sized: DataFrame) -> DataFrame:
    """(source, n, source_size, target): weights 1, 2, 3 in turn by code point, null last; water-filling under the caps.

    A source's target is min(cap, level * weight). Sources below the level are full, what they leave raises the level for
    the others, until no more are full: each round is one sum over the sources, of which there may be any number.
    """
    by = sized.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    by = numbered(by, "place", F.col("source").asc_nulls_last()).withColumn("weight", F.col("place") % 3 + 1)
    by = cut(by.withColumn("cap", (MOST * F.col("source_size")).cast("double")))
    share, full = F.lit(0.0), -1
    while True:
        there = F.col("cap") < share
        now = by.agg(F.count_if(there).alias("full"), F.sum("source_size").alias("total"), F.sum(F.when(there, F.col("cap")).otherwise(0.0)).alias("spent"), F.sum(F.when(there, 0).otherwise(F.col("weight"))).alias("weights")).first()
        if now["full"] == full or not now["weights"]:
            break
        full, share = now["full"], F.lit((now["total"] - now["spent"]) / now["weights"]) * F.col("weight")
    return by.select("source", "n", "source_size", F.least("cap", share).alias("target"))


def rate(lam: str = "lam") -> F.Column:
    """The tilted rate of a stratum; a source at its cap takes all it may."""
    x = F.col("size") * F.col("n") / F.col("source_size")
    return F.when(F.col("target") >= MOST * F.col("source_size"), F.lit(float(MOST))).when(F.col("size") == 0, 1.0).otherwise(F.least(F.lit(float(MOST)), F.exp(F.least(F.col(lam) * x, F.lit(50.0)))))


def balance(strata: DataFrame, goals: DataFrame) -> DataFrame:
    """goals with lam: Newton steps on the dual, kept within a bracket that shrinks, until every source meets its target."""
    lams = cut(goals.select("source", "n", "source_size", "target", F.lit(0.0).alias("lam"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high")))
    for _ in range(STEPS):
        r = strata.join(lams, F.expr("strata_source <=> source"))
        w = F.col("docs") * F.col("size") * rate()
        slope = F.when(rate() < MOST, w * F.col("size") * F.col("n") / F.col("source_size")).otherwise(0.0)
        now = r.groupBy("source", "n", "source_size", "target", "lam", "low", "high").agg(F.sum(w).alias("words"), F.sum(slope).alias("slope"))
        gap = F.col("words") - F.col("target")
        now = now.withColumn("done", (F.col("source_size") == 0) | (F.col("target") >= MOST * F.col("source_size")) | (F.abs(gap) <= TOLERANCE * F.col("target")))
        now = now.withColumns({"low": F.when(gap < 0, F.col("lam")).otherwise(F.col("low")), "high": F.when(gap > 0, F.col("lam")).otherwise(F.col("high"))})
        newton = F.col("lam") - F.try_divide(gap, F.col("slope"))
        half = F.when(F.col("low") <= -1e6, F.least(F.col("high") * 2, F.lit(-1.0))).when(F.col("high") >= 1e6, F.greatest(F.col("low") * 2, F.lit(1.0))).otherwise((F.col("low") + F.col("high")) / 2)
        lams = cut(now.withColumn("lam", F.when(F.col("done"), F.col("lam")).when((newton > F.col("low")) & (newton < F.col("high")) & (F.abs(newton - F.col("lam")) < 4), newton).otherwise(half)))
        if not lams.where("not done").limit(1).count():
            break
        lams = lams.drop("words", "slope", "done")
    return lams.select("source", "n", "source_size", "target", "lam")


def mix(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, copies of every document (taken = copies * size).

    Copies are rounded stratum by stratum: strata of a source follow one another by falling size, and each takes
    the difference of rounded running sums, so a source's error stays below its longest document; what remains
    goes to, or comes from, its short documents. Within a stratum documents rank by a hash of id and text. Null texts have
    size 0 and one copy; a null source is a source, repeated rows are documents of their own (ties by the columns in keep,
    which stay, as keep_<name>); an empty table gives no rows.
    """
    d = cut(sizes(documents, keep))
    goals = cut(targets(d))
    counted = cut(d.groupBy("source", "size").agg(F.count("*").alias("docs")))
    lams = balance(counted.withColumnRenamed("source", "strata_source"), goals)
    s = counted.withColumnRenamed("source", "strata_source").join(lams, F.expr("strata_source <=> source")).withColumn("rate", rate())
    # windows over a source's different sizes
    falling = Window.partitionBy("source").orderBy(F.desc("size"))
    s = s.withColumn("upto", F.round(F.sum(F.col("docs") * F.col("rate")).over(falling.rowsBetween(Window.unboundedPreceding, 0))).cast("long"))
    s = s.withColumn("copies", F.col("upto") - F.coalesce(F.lag("upto").over(falling), F.lit(0).cast("long")))
    s = s.withColumn("copies", F.greatest(F.lit(0), F.least(F.col("copies"), MOST * F.col("docs"))))
    s = s.withColumn("left", F.col("target") - F.sum(F.col("copies") * F.col("size")).over(Window.partitionBy("source")))
    room = F.when(F.col("size") == 0, F.lit(0)).when(F.col("left") > 0, MOST * F.col("docs") - F.col("copies")).otherwise(F.col("copies"))
    rising = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("room", room).withColumn("spent", F.coalesce(F.sum(F.col("room") * F.col("size")).over(rising), F.lit(0)))
    step = F.greatest(F.lit(0), F.least(F.col("room"), F.floor(F.coalesce(F.try_divide(F.abs("left") - F.col("spent"), F.col("size")), F.lit(0.0)))))
    s = s.withColumn("copies", (F.col("copies") + F.signum("left") * step).cast("long"))
    s = cut(s.select(F.col("source").alias("s_source"), F.col("size").alias("s_size"), "docs", "copies", "source_size", "target"))
    # a size with very many documents is split by their hash; each part has its share of the copies that are over
    parts = counted.select(F.col("source").alias("p_source"), F.col("size").alias("p_size"), F.least(F.ceil(F.col("docs") / RANKED), F.ceil(F.sqrt("docs"))).alias("parts"))
    large = cut(parts.where("parts > 1"))
    salted = cut(d.join(large, F.expr("source <=> p_source and size = p_size"), "left").withColumn("salt", F.pmod("h", F.coalesce("parts", F.lit(1)))).drop("p_source", "p_size", "parts"))
    quota = salted.groupBy("source", "size", "salt").agg(F.count("*").alias("here")).join(s, F.expr("source <=> s_source and size = s_size"))
    salts = Window.partitionBy("source", "size").orderBy("salt")
    upto = F.round(F.col("copies") % F.col("docs") * (F.sum("here").over(salts.rowsBetween(Window.unboundedPreceding, 0)) / F.col("docs"))).cast("long")
    quota = quota.withColumn("upto", upto).withColumn("over", F.col("upto") - F.coalesce(F.lag("upto").over(salts), F.lit(0)))
    quota = cut(quota.select("s_source", "s_size", F.col("salt").alias("s_salt"), F.floor(F.col("copies") / F.col("docs")).alias("each"), "over", "source_size", "target"))
    ranked = salted.withColumn("at", F.row_number().over(Window.partitionBy("source", "size", "salt").orderBy("h", "doc_id", *(f"keep_{c}" for c in keep))))
    out = ranked.join(quota, F.expr("source <=> s_source and size = s_size and salt = s_salt"))
    copies = (F.col("each") + F.when(F.col("at") <= F.col("over"), 1).otherwise(0)).cast("long")
    return out.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), "source", copies.alias("copies"), *(f"keep_{c}" for c in keep))
