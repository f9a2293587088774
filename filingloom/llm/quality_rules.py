"""Quality rules whose cutoffs come with a guarantee: exact binomial bounds on labelled holdouts.

Cutoffs of all rules lie on one path, laid down beforehand (PATH): round by round each rule takes its next tighter cutoff. A step of
the path is the set of cutoffs reached so far. Per stratum (language) steps are tested in order. The null hypothesis of a step is
that its rules together reject more than ALPHA of the good documents; its p-value is the exact binomial tail of the good
holdouts that they reject. Testing stops at the first step that isn't proven (fixed-sequence testing, which needs no correction
along the path), and Bonferroni's correction covers the strata. So with probability 1 - DELTA every stratum loses at most ALPHA
of its good documents to the method. A stratum with too few holdouts for any proof (with four strata below 217, none of
them rejected) gets no cutoff, and loses nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingloom.llm.common import BLANKS, cut, words

ALPHA, DELTA = 0.02, 0.05

#: rule: (measure, cutoffs from the loosest); a document is rejected if its measure exceeds the cutoff.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / word_chars", [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02]),
    "capitals": ("n_capitals / word_chars", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15]),
    "bangs": ("n_bangs / n_words", [0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05]),
    "repeats": ("n_repeat_words / n_words", [0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2]),
    "lines": ("n_dup_lines / n_lines", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3]),
}


#: The path: (rule, its cutoff's place), the loosest cutoffs of all rules first.
PATH = [(rule, k) for k in range(max(len(c) for _, c in RULES.values())) for rule, (_, c) in RULES.items() if k < len(c)]


def repeat_words(grams: str) -> Column:
    """Words covered by the 3-word windows (given as hashes, in order) that occur twice or more."""
    at = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), at).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, lang, text_hash and the counts of each whole text, JVM-side and without a shuffle."""
    text = F.coalesce("text", F.lit(""))
    d = documents.select("doc_id", F.col("lang").alias("lang"), text.alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0)
    d = d.select(
        "doc_id", "lang", F.xxhash64("text").alias("text_hash"), words().alias("w"), lines.alias("lines"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_count("text", F.lit("!")).cast("long").alias("n_bangs"),
    )
    gram = lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))
    grams = F.when(F.size("w") >= 3, F.transform(F.sequence(F.lit(0), F.size("w") - 3), gram)).otherwise(F.array().cast("array<bigint>"))
    counts = ["word_chars", "n_symbols", "n_capitals", "n_bangs"]
    d = d.select("doc_id", "lang", "text_hash", *counts, F.size("w").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), grams.alias("grams"))
    counts += ["n_words", "n_lines", "n_dup_lines"]
    d = d.select("doc_id", "lang", "text_hash", *counts, repeat_words("grams").alias("at"))
    same = lambda x, i: (F.get("at", i - 1)["h"] == x["h"]) | (F.get("at", i + 1)["h"] == x["h"])
    starts = F.sort_array(F.transform(F.filter("at", same), lambda x: x["i"]))
    covered = F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p + 3 - a["end"])).alias("n"), (p + 3).alias("end")), lambda a: a["n"].cast("long"))
    return d.select("doc_id", "lang", "text_hash", *counts, covered.alias("n_repeat_words"))


def measures(d: DataFrame) -> DataFrame:
    return d.withColumns({f"r_{name}": F.coalesce(F.try_divide(*(F.col(x).cast("double") for x in what.split(" / "))), F.lit(0.0)) for name, (what, _) in RULES.items()})


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), exact up to rounding, for k below n p; 1.0 at or above it."""
    log_c = F.aggregate(F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")), F.lit(0.0), lambda s, j: s + F.log((n - j + 1) / j))
    last = F.exp(log_c + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    ratios = F.aggregate(F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")), F.lit(1.0), lambda s, i: 1.0 + s * (i / (n - i + 1)) * ((1 - p) / p))
    return F.when(k < n * p, F.least(last * ratios, F.lit(1.0))).otherwise(F.lit(1.0))


def first_step() -> Column:
    """The first step of the path that rejects a document with measures r_<rule>; null if none does. Cutoffs fall, so of a rule's
    n cutoffs the last m are exceeded."""
    def of(rule: str) -> Column:
        values = RULES[rule][1]
        above = F.size(F.filter(F.array(*map(F.lit, values)), lambda x: x < F.col(f"r_{rule}")))
        return F.get(F.array(*(F.lit(PATH.index((rule, k))) for k in range(len(values)))), F.when(above > 0, len(values) - above))

    return F.least(*map(of, RULES))


def cutoffs(measured_labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(lang, step, n, rejected, p_value) of the last proven step of each stratum that has one.

    Equal texts count once, so that copies don't pass for independent holdouts.
    """
    good = measures(measured_labelled.where("quality = 1")).dropDuplicates(["lang", "text_hash"])
    hit = cut(good.select("lang", first_step().alias("at")).groupBy("lang", "at").agg(F.count("*").alias("docs")))
    strata = hit.groupBy("lang").agg(F.sum("docs").alias("n"))
    of = max(1, strata.count())
    steps = strata.select("lang", "n", F.explode(F.sequence(F.lit(0), F.lit(len(PATH) - 1))).alias("step"))
    tests = steps.alias("t").join(hit.alias("h"), F.expr("t.lang <=> h.lang and h.at <= t.step"), "left").groupBy("t.lang", "t.step", "t.n").agg(F.coalesce(F.sum("h.docs"), F.lit(0)).cast("long").alias("rejected"))
    tests = tests.withColumn("p_value", binomial_tail(F.col("rejected"), F.col("n"), alpha))
    failed = tests.groupBy("lang").agg(F.min(F.when(F.col("p_value") > delta / of, F.col("step"))).alias("failed")).withColumnRenamed("lang", "_lang")
    proven = tests.join(failed, F.expr("lang <=> _lang and (failed is null or step < failed)"))
    return proven.groupBy("lang").agg(F.max(F.struct("step", "n", "rejected", "p_value")).alias("best")).select("lang", "best.*")


def reached(rule: str, step: Column) -> Column:
    """A rule's cutoff at a step of the path; null before its first."""
    known = [RULES[rule][1][max(k for r, k in PATH[: s + 1] if r == rule)] if any(r == rule for r, _ in PATH[: s + 1]) else None for s in range(len(PATH))]
    return F.get(F.array(*(F.lit(x).cast("double") for x in known)), step)


def apply_rules(documents: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The counts of every document, base_failed, kept, and the rules that rejected it.

    Null texts and texts without a word count as empty and fail the base rule. Null languages are a
    stratum of their own. Of several labels of a document the lowest counts. Further columns are ignored;
    repeated rows each get a result; an empty table gives no rows.
    """
    d = cut(measured(documents))
    marks = labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    best = cutoffs(d.join(marks, "doc_id"), alpha, delta)
    wide = best.select(F.col("lang").alias("stratum"), *(reached(r, F.col("step")).alias(f"c_{r}") for r in RULES))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = measures(d).join(cut(wide), F.expr("lang <=> stratum"), "left").withColumn("base_failed", base)
    why = F.filter(F.array(*(F.when(F.col(f"r_{r}") > F.col(f"c_{r}"), F.lit(r)) for r in RULES)), lambda x: x.isNotNull())
    out = out.withColumn("rejected_by", F.array_join(why, ","))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("rejected_by") == "")).alias("kept"), "rejected_by")
