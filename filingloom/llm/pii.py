"""Personal data: base patterns, and terms that disclose them (information-theoretic sanitisation).

A term discloses a protected entity as far as it lowers the entity's surprisal. Over the corpus, an entity e is in a
text with probability p(e) and in one that holds term t, anywhere, with p(e | t); the share of its information that t
reveals is 1 - log p(e | t) / log p(e). Entities are each protected value, however it is written, and each kind of value
(that a text holds an e-mail address, say). What a term reveals is the most that it reveals of any. Terms above
GENERALISE are replaced by their kind, those above REMOVE leave nothing. Equal texts count once, since copies are no
evidence. p(e | t) is the lower end of its confidence interval, so a term must recur with the entity before it counts.
All of it is DataFrame work; texts aren't shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingloom.llm.common import cut, positions, small, taken

# The base kinds in their order. Starts are held to where a run of the class begins (or the last
# match ends) and repeats are possessive, which finds the same matches without trying each start in a long run.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"

#: Shares of information; texts that must hold a term and an entity together; normal quantile of the confidence interval.
GENERALISE, REMOVE, PAIR, QUANTILE = 0.8, 0.95, 3, 1.0
#: Rows up to which a table of terms, or of documents that hold disclosing terms, is broadcast.
BROADCAST = 200_000

#: A term: letters and digits, at least one letter, with hyphens and apostrophes inside; punctuation may stand around it.
TERM = r"(?<!\S)\p{P}*+((?=[\p{N}'’-]*+\p{L})[\p{L}\p{M}\p{N}]++(?:['’-][\p{L}\p{M}\p{N}]++)*+)\p{P}*+(?!\S)"


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d < 5, 2 * d).otherwise(2 * d - 9)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def placed(kind: str, gaps: str, hits: str) -> Column:
    """Spans of the hits between the gaps, counted in code points."""
    span = lambda p, v: F.struct(F.lit(kind).alias("kind"), p["start"].alias("start"), p["end"].alias("end"), v.alias("value"))
    return F.zip_with(positions(gaps, hits), F.slice(hits, F.lit(1), F.least(F.size(gaps), F.size(hits))), span)


def identity(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits that name a row by its id and text."""
    return F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.lit("|"), F.coalesce(text, F.lit(""))))


def base_spans(documents: DataFrame) -> DataFrame:
    """row_key, doc_id, text and base: the valid base spans by kind, then start."""
    d = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("row_key", identity())
    digit = F.col("text").rlike("[0-9]")
    for kind, pattern in KINDS.items():
        there = F.col("text").contains(HINTS[kind]) if HINTS[kind] else F.lit(True)
        none = F.array().cast("array<string>")
        d = d.withColumn(f"h_{kind}", F.when(there & (digit if kind != "email" else F.lit(True)), F.regexp_extract_all("text", F.lit(f"({pattern})"), F.lit(1))).otherwise(none))
        d = d.withColumn(f"g_{kind}", F.when(F.size(f"h_{kind}") > 0, F.split("text", pattern, -1)).otherwise(none))

    def passed(kind: str) -> Column:
        return F.filter(placed(kind, f"g_{kind}", f"h_{kind}"), lambda s: valid(kind, s["value"]))

    return d.select("row_key", "doc_id", "text", F.concat(*(passed(k) for k in KINDS)).alias("base"))


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(1))


def entities(base: str = "base") -> Column:
    """What a row's spans protect, each once: hashes of the values, however they are written (digits of numbers, lower-case
    letters), and of the kinds."""
    bare = lambda s: F.when(s["kind"].isin("card", "phone"), F.regexp_replace(s["value"], "[^0-9]", "")).otherwise(F.lower(s["value"]))
    return F.array_distinct(F.concat(F.transform(base, lambda s: F.xxhash64(F.lit("value"), bare(s))), F.transform(base, lambda s: F.xxhash64(F.lit("kind"), s["kind"]))))


def once(rows: DataFrame, *more: str) -> DataFrame:
    """Of rows with equal text_key one, its other columns being functions of the text."""
    return rows.groupBy("text_key").agg(*(F.first(c).alias(c) for c in more))


def disclosure(n_te: Column, n_t: Column, n_e: Column, n: Column) -> Column:
    """The share of an entity's information that a term reveals: n_te of the n_t texts with the term hold it, n_e of all n do.
    Of the share n_te / n_t the lower end of Wilson's interval counts."""
    z = QUANTILE * QUANTILE
    p = n_te / n_t
    low = (p + z / (2 * n_t) - QUANTILE * F.sqrt(p * (1 - p) / n_t + z / (4 * n_t * n_t))) / (1 + z / n_t)
    # an entity that all texts hold has nothing left to reveal
    return F.when((n_e < n) & (low > 0), 1 - F.log(F.least(low, F.lit(1.0))) / F.log(n_e / n)).otherwise(0.0)


def disclosing_terms(documents: DataFrame, based: DataFrame) -> DataFrame:
    """(term, revealed) of terms that reveal at least GENERALISE of an entity.

    based: of every row text_key, and of rows with values entities and terms, both of the whole text. Counts are summed
    where rows are read; only sums are shuffled. Entities of fewer than PAIR texts aren't paired with terms, since no pair
    of theirs can reach PAIR texts. Exact copies are told by a hash; only rows with values, and rows that hold a candidate
    term, meet by it.
    """
    held = cut(once(based.where(F.size("entities") > 0), "entities", "terms"))
    often = cut(held.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= PAIR))
    pairs = held.select(F.explode("entities").alias("entity"), "terms").join(small(often, BROADCAST), "entity").select("entity", "n_e", F.explode("terms").alias("term"))
    pairs = cut(pairs.groupBy("term", "entity").agg(F.count("*").alias("n_te"), F.first("n_e").alias("n_e")).where(F.col("n_te") >= PAIR))
    copies = cut(based.groupBy("text_key").agg(F.count("*").alias("copies")).where("copies > 1"))
    n = based.count() - (copies.agg(F.sum(F.col("copies") - 1)).first()[0] or 0)
    n_t = text_counts(documents, cut(pairs.select("term").distinct()), copies)
    out = pairs.join(n_t, "term").select("term", disclosure(F.col("n_te"), F.greatest("n_t", "n_te"), F.col("n_e"), F.lit(n)).alias("revealed"))
    return cut(out.groupBy("term").agg(F.max("revealed").alias("revealed")).where(F.col("revealed") >= GENERALISE))


def text_counts(documents: DataFrame, candidates: DataFrame, copies: DataFrame) -> DataFrame:
    """(term, n_t): how many different texts hold each candidate term; of a text's copies each counts its share."""
    there = documents.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
    there = there.join(small(candidates, BROADCAST), "term").join(small(copies, BROADCAST), "text_key", "left")
    return there.groupBy("term").agg(F.round(F.sum(F.coalesce(1 / F.col("copies"), F.lit(1.0)))).cast("long").alias("n_t"))


def strong_terms(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """row_key, doc_id and base of every row; and of rows that hold disclosing terms row_key and strong (term, revealed)."""
    d = base_spans(documents)
    every = F.when(F.size("base") > 0, F.array_distinct(terms(F.col("text")))).otherwise(F.array().cast("array<string>"))
    based = cut(d.select("row_key", "doc_id", F.xxhash64("text").alias("text_key"), "base", entities().alias("entities"), every.alias("terms")))
    strong = disclosing_terms(documents, based)
    held = documents.select(identity().alias("row_key"), F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
    held = held.join(small(strong, BROADCAST), "term").groupBy("row_key").agg(F.sort_array(F.collect_set(F.struct("term", "revealed"))).alias("strong"))
    return based.select("row_key", "doc_id", "base"), cut(held)


def term_pattern(strong: str) -> Column:
    """A pattern for whole words, any case."""
    return F.concat(F.lit(r"(?iu)(?:(?<=[\s\p{P}])|^)(?:"), F.array_join(F.col(f"{strong}.term"), "|"), F.lit(r")(?=[\s\p{P}]|$)"))


def gone(strong: str) -> Column:
    """Terms of which nothing is to stay."""
    return F.transform(F.filter(strong, lambda s: s["revealed"] >= REMOVE), lambda s: s["term"])


def find_personal_data(documents: DataFrame) -> DataFrame:
    """row_key, doc_id, base and found (spans of disclosing terms; kind term or drop) of every row.

    A null text is empty, as is a text without characters: no spans. Repeated rows each get a row, a null id
    too, further columns take no part, an empty table gives no rows. Offsets count code points, ends excluded.
    """
    based, held = strong_terms(documents)
    texts = documents.select(identity().alias("row_key"), F.coalesce("text", F.lit("")).alias("text")).join(small(held, BROADCAST), "row_key").dropDuplicates(["row_key"])
    texts = texts.withColumn("pattern", term_pattern("strong"))
    texts = texts.withColumns({"hits": F.regexp_extract_all("text", F.concat(F.lit("("), "pattern", F.lit(")")), F.lit(1)), "gaps": F.split("text", F.col("pattern"), -1)})
    named = F.transform(placed("term", "gaps", "hits"), lambda s: F.struct(F.when(F.array_contains(gone("strong"), F.lower(s["value"])), F.lit("drop")).otherwise(F.lit("term")).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    found = texts.select("row_key", named.alias("found"))
    return based.join(found, "row_key", "left").withColumn("found", F.coalesce("found", F.array().cast(SPAN)))


def sanitised(documents: DataFrame) -> DataFrame:
    """documents with text rewritten: valid base values as [KIND], kind by kind in their order, then disclosing terms as [TERM],
    removed terms as nothing; all other columns stay. What one kind has replaced the next doesn't see.

    A null text stays null, an empty one empty. Repeated rows each stay, a null id too; names of further columns can't clash;
    an empty table gives no rows."""
    key, strong, pattern, gaps, hits, now = taken(documents, "row", "strong", "pattern", "gaps", "hits", "now")
    held = strong_terms(documents)[1].select(F.col("row_key").alias(key), F.col("strong").alias(strong))
    d = documents.withColumn(key, identity()).join(small(held, BROADCAST), key, "left").withColumn(pattern, term_pattern(strong)).withColumn(now, F.col("text"))

    def rewrite(d: DataFrame, found: Column, cut_at: Column, there: Column, label: Callable[[Column], Column]) -> DataFrame:
        d = d.withColumn(hits, F.when(there, F.regexp_extract_all(F.col(now), found, F.lit(1)))).withColumn(gaps, F.when(F.size(hits) > 0, F.split(F.col(now), cut_at, -1)))
        parts = F.zip_with(gaps, hits, lambda g, h: F.concat(g, F.coalesce(label(h), F.lit(""))))
        return d.withColumn(now, F.when(F.size(hits) > 0, F.array_join(parts, "")).otherwise(F.col(now)))

    for kind, at in KINDS.items():
        there = F.col(now).contains(HINTS[kind]) if HINTS[kind] else F.col(now).rlike("[0-9]")
        d = rewrite(d, F.lit(f"({at})"), F.lit(at), there, lambda h, kind=kind: F.when(h.isNotNull(), F.when(valid(kind, h), F.lit(f"[{kind.upper()}]")).otherwise(h)))
    removed = gone(strong)
    d = rewrite(d, F.concat(F.lit("("), pattern, F.lit(")")), F.col(pattern), F.col(pattern).isNotNull(), lambda h: F.when(h.isNotNull() & ~F.array_contains(removed, F.lower(h)), F.lit("[TERM]")))
    return d.withColumn("text", F.col(now)).select(*documents.columns)


def digests(found: DataFrame) -> DataFrame:
    """The counts and digest columns of spans: kind:start:end, joined by commas."""
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    every = F.concat("base", F.filter("found", lambda s: s["kind"] == "drop"), F.filter("found", lambda s: s["kind"] == "term"))
    return found.select("doc_id", *(count(k) for k in KINDS), F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(every).alias("spans"))
