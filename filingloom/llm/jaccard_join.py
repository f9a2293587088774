"""N-gram Jaccard join with count vectors in R-trees.

A document is its set of distinct word n-grams. Grams are hashed into groups, so a set is also a point
of group counts, and two sets overlap by at most the sum of the smaller counts, group by group. That bound,
kept for boxes of points in packed R-trees, prunes pairs; pairs that survive it are verified on the sets.

One R-tree over a whole corpus would be searched almost everywhere, since counts of unrelated texts of one
length hardly differ. So points are first dealt into shards without losing a pair: linked sets differ in
at most D grams, hence of more than D groups one holds the same grams in both (pigeonhole). A shard is a
group with its content; the number of groups follows from a band of sizes. Within a shard
 1. every member meets the shard's first member (linear in the shard, whatever the group of copies),
 2. members that are still in different components meet in R-trees of bounded size; a shard that fits a leaf is one leaf.
Equal sets form one class throughout, so copies are never expanded into pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filingloom.llm.common import connected, cut, numbered, small
from filingloom.llm.hashing import U, changes, gram_sets, mix64, portions, text_bytes

#: Ratio of a band's sizes; points of a leaf; points of a tree, and points that search it together.
BAND, LEAF, TREE = 1.6, 16, 1024
#: Groups of a point: a power of two between these, twice the set's size at most.
GROUPS = (1024, 4096)
#: Bytes of the texts whose shards are compared before they leave a task.
GATHERED = 1 << 23
#: Ids up to which the documents with a candidate partner are broadcast; beyond, texts are joined by a shuffle.
SOME = 1_000_000
#: Rows without an id are numbered from here on, so that those with one come first.
FREE = 1 << 62


def bands(num: int, den: int, size: int) -> np.ndarray:
    """Bands up to the one that holds a size: least and largest size, the largest partner, the largest symmetric
    difference of a linked pair."""
    out, low = [], 1
    while True:
        high = max(low, int(low * BAND) - 1)
        partner = high * den // num
        out.append((low, high, partner, (den - num) * (high + partner) // (den + num)))
        if high >= size:
            return np.array(out)
        low = high + 1


def signatures(h: np.ndarray, n: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The shards of sets (hashes sorted within each, n of them) and the set of each shard. Groups are ranges of the hash,
    so a group's grams are adjacent.

    A set with more filled groups than may differ shares a filled one with each partner. Two sets that both have fewer
    share a filled group or an empty one. A band in which only equal sets link has no shards: these are one class.
    """
    table = bands(num, den, int(n.max(initial=1)))
    own, first = np.searchsorted(table[:, 0], n, "right") - 1, np.searchsorted(table[:, 2], n)
    owner = np.repeat(np.arange(len(n)), n)
    out, sets = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for back in range(int((own - first).max(initial=-1)) + 1):
        band = np.maximum(own - back, 0)
        most = table[band, 3]
        here = (own - back >= first) & (n > 0) & (most > 0)
        k = np.where(here, (most + 1) * 9 // 8 + 1, 0)
        salt = band.astype(U) << U(32)
        rows = here[owner]
        part, of = h[rows], owner[rows]
        group = ((part >> U(32)) * k[of].astype(U)) >> U(32)
        begin = np.flatnonzero(changes(of, group))
        if not len(begin):
            continue
        of, filled = of[begin], group[begin]
        out.append(mix64(mix64(np.add.reduceat(part, begin)) + mix64(filled + salt[of])))
        sets.append(of)
        few = here & (np.bincount(of, minlength=len(n)) <= most)
        for i in np.flatnonzero(few):  # sets of a few grams, mostly in one group
            empty = np.setdiff1d(np.arange(k[i], dtype=U), filled[of == i])
            out.append(mix64(mix64(empty + salt[i]) + U(1)))
            sets.append(np.full(len(empty), i))
    return np.concatenate(out), np.concatenate(sets)


def points(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group counts of sets, in bytes, one after the other, and how many each has; points of half the groups are sums of
    neighbours. Counts that bytes can't hold make a point whose bound never prunes."""
    bits = np.clip(np.ceil(np.log2(np.maximum(n, 1) + 1)).astype(np.int64), GROUPS[0].bit_length() - 1, GROUPS[1].bit_length() - 1)
    size = 1 << bits
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(n)), n)
    counts = np.bincount(start[owner] + (h >> (64 - bits[owner]).astype(U)).astype(np.int64), minlength=int(size.sum()))
    crowded = np.maximum.reduceat(counts, start) > 127 if len(n) else np.zeros(0, bool)
    counts[np.repeat(crowded, size)] = 127
    return counts.astype(np.int8), size


def lists(flat: np.ndarray | pa.Array, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), flat if isinstance(flat, pa.Array) else pa.array(flat))


def outlined(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(doc_id, n, key, sigs, again) of every row: key names the set; sigs are the shards that no earlier document of the
    same portion has, and whether a later one has them; again are the others. So a shard's first rows leave a portion once."""

    def outline(ids: pa.Array, data: np.ndarray, offsets: np.ndarray, known: dict) -> pa.RecordBatch:
        keys, sizes, flat, owner, seen = [], [np.zeros(0, np.int64)], [np.zeros(0, U)], [np.zeros(0, np.int64)], set()
        for first, end in portions(offsets):
            h, many = gram_sets(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first], n, known)
            ends = np.cumsum(many)
            fresh = np.zeros(len(many), bool)
            for i, (x, y) in enumerate(zip((ends - many).tolist(), ends.tolist())):
                key = hashlib.blake2b(h[x:y].tobytes(), digest_size=16).digest()
                fresh[i] = key not in seen
                seen.add(key)
                keys.append(key)
            sigs, of = signatures(h[np.repeat(fresh, many)], many[fresh], num, den)
            flat.append(sigs)
            owner.append(np.flatnonzero(fresh)[of] + first)
            sizes.append(many)
        sig, own = np.concatenate(flat), np.concatenate(owner)
        order = np.lexsort((own, sig))
        sig, own = sig[order], own[order]
        new = changes(sig)
        more = np.r_[~new[1:], False][new] if len(sig) else new
        lead, late = np.argsort(own[new], kind="stable"), np.argsort(own[~new], kind="stable")
        count = lambda x: np.bincount(x, minlength=len(ids))
        firsts = pa.StructArray.from_arrays([pa.array(sig[new][lead].view(np.int64)), pa.array(more[lead])], ["sig", "more"])
        return pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(sizes)), pa.array(keys, pa.binary()), lists(firsts, count(own[new])), lists(sig[~new][late].view(np.int64), count(own[~new]))], ["doc_id", "n", "key", "sigs", "again"])

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for b in it:
            data, offsets = text_bytes(b.column(1))
            for first, end in portions(offsets, GATHERED):
                yield outline(b.column(0).slice(first, end - first), data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first], known)

    return docs.mapInArrow(batch, "doc_id long, n long, key binary, sigs array<struct<sig:bigint,more:boolean>>, again array<long>")


def first_of_shard(rows: DataFrame) -> DataFrame:
    """(sig, doc, more) to (sig, a, b): a shard's first document and each other one, and the first with itself where more
    have the shard; streams over sorted rows."""

    def runs(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sig, head = None, None
        for b in it:
            s, d, more = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(s):
                continue
            start = changes(s)
            start[0] = sig is None or s[0] != sig
            at = np.maximum.accumulate(np.where(start, np.arange(len(s)), -1))
            lead = np.where(at >= 0, d[at], head if head is not None else 0)
            sig, head = s[-1], lead[-1]
            keep = (lead != d) | more
            yield pa.RecordBatch.from_arrays([pa.array(s[keep]), pa.array(lead[keep]), pa.array(d[keep])], ["sig", "a", "b"])

    return rows.repartition("sig").sortWithinPartitions("sig", "doc").mapInArrow(runs, "sig long, a long, b long")


def pointed(docs: DataFrame, n: int) -> DataFrame:
    """(doc, n, point) of every row: its set's size and group counts."""

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for b in it:
            data, offsets = text_bytes(b.column(1))
            for first, end in portions(offsets):
                h, many = gram_sets(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first], n, known)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, end - first), pa.array(many), lists(*points(h, many))], ["doc", "n", "point"])

    return docs.mapInArrow(batch, "doc long, n long, point array<tinyint>")


def detailed(docs: DataFrame, n: int) -> DataFrame:
    """(doc, n, grams) of every row: its set."""

    def batch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for b in it:
            data, offsets = text_bytes(b.column(1))
            for first, end in portions(offsets):
                h, many = gram_sets(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first], n, known)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, end - first), pa.array(many), lists(h.view(np.int64), many)], ["doc", "n", "grams"])

    return docs.mapInArrow(batch, "doc long, n long, grams array<long>")


class RTree:
    """A packed R-tree: points sorted by size and by their fullest group, boxes over LEAF neighbours, level by level."""

    def __init__(self, held: np.ndarray, sizes: np.ndarray):
        self.order = np.lexsort((held.argmax(1), sizes))
        self.levels = [(held[self.order], sizes[self.order])]
        while len(self.levels[-1][0]) > 1:
            top, least = self.levels[-1]
            cuts = np.arange(0, len(top), LEAF)
            self.levels.append((np.maximum.reduceat(top, cuts), np.minimum.reduceat(least, cuts)))

    def search(self, asked: np.ndarray, sizes: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """(asked row, held row) whose overlap, bounded by summed minima, can reach the threshold.

        A level is searched for all that ask at once, where any of them passed the box above.
        """
        near = np.ones((len(asked), 1), bool)
        for i, (top, least) in enumerate(reversed(self.levels)):
            if i:
                near = np.repeat(near, LEAF, axis=1)[:, : len(top)]
            rows, boxes = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            bound = least_sums(asked[rows], top[boxes])
            near[np.ix_(rows, boxes)] &= bound * (num + den) >= num * (sizes[rows][:, None] + least[boxes][None, :])
        rows, held = np.nonzero(near)
        return rows, self.order[held]


def least_sums(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Summed minima of all rows of one with all of two: the smaller of two counts is the number of heights that both
    reach, so each height adds a product of 0/1 matrices. Sums are exact, being far below 2 ** 24."""
    total = np.zeros((len(one), len(two)), np.float32)
    for height in range(1, int(min(one.max(initial=0), two.max(initial=0))) + 1):
        a, b = one >= height, two >= height
        columns = np.flatnonzero(a.any(0) & b.any(0))
        total += a[:, columns].astype(np.float32) @ b[:, columns].astype(np.float32).T
    return total.astype(np.int64)


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    return counts.reshape(groups, -1).sum(1) if len(counts) > groups else counts


def cross_pairs(members: DataFrame, num: int, den: int) -> DataFrame:
    """Of (sig, t, q, side, doc, comp, n, point): pairs within the reach of tree t whose components differ. Side 0 is
    searched by side 1. Trees stream through sorted partitions, so memory holds one tree and one Arrow batch."""

    def meet(rows: pa.Table) -> np.ndarray:
        fine = [np.asarray(p, np.int32) for p in rows.column("point").to_numpy()]
        groups = min(map(len, fine))
        held = np.stack([folded(p, groups) for p in fine])
        size, doc, comp, side = (rows.column(c).to_numpy() for c in ("n", "doc", "comp", "side"))
        base, ask = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(base) or not len(ask):
            return np.zeros((0, 2), np.int64)
        i, j = RTree(held[base], size[base]).search(held[ask], size[ask], num, den)
        i, j = ask[i], base[j]
        far = comp[i] != comp[j]
        return np.stack([np.minimum(doc[i], doc[j]), np.maximum(doc[i], doc[j])], 1)[far]

    def trees(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        last = None

        def pairs(found: list[np.ndarray]) -> pa.RecordBatch:
            p = np.concatenate([np.zeros((0, 2), np.int64), *found])
            p = p[np.lexsort((p[:, 1], p[:, 0]))]
            p = p[changes(p[:, 0], p[:, 1])]
            return pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], ["a", "b"])

        for b in it:
            if not b.num_rows:
                continue
            table = pa.Table.from_batches([b])
            key = [b.column(c).to_numpy() for c in ("sig", "t", "q")]
            begin = np.flatnonzero(changes(*key)).tolist()
            found = []
            for x, y in zip(begin, [*begin[1:], b.num_rows]):
                tree = tuple(int(k[x]) for k in key)
                if held and tree != last:
                    found.append(meet(pa.concat_tables(held)))
                    held = []
                last = tree
                held.append(table.slice(x, y - x))
            yield pairs(found)
        if held:
            yield pairs([meet(pa.concat_tables(held))])

    return members.repartition("sig", "t", "q").sortWithinPartitions("sig", "t", "q", "side").mapInArrow(trees, "a long, b long")


def overlap_bound(one: str, two: str) -> Column:
    """The sum of the smaller counts; a point of more groups is folded first."""

    def fold(coarse: str, fine: str) -> Column:
        k = (F.size(fine) / F.size(coarse)).cast("int")
        return F.transform(coarse, lambda x, i: F.least(x.cast("int"), F.aggregate(F.slice(fine, i * k + 1, k), F.lit(0), lambda s, y: s + y.cast("int"))))

    least = F.when(F.size(one) == F.size(two), F.zip_with(one, two, lambda x, y: F.least(x, y).cast("int"))).when(F.size(one) < F.size(two), fold(one, two)).otherwise(fold(two, one))
    return F.aggregate(least, F.lit(0), lambda s, x: s + x.cast("int"))


def only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is among ids."""
    return docs.join(small(cut(ids.distinct()), SOME), "doc_id", "left_semi")


def verified(pairs: DataFrame, docs: DataFrame, marks: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose sets link: first the sizes and the bound on the points (marks), then the sets of what is left. A
    document that has several sets meets with each."""
    side = lambda df, x, c: df.select(F.col("doc").alias(x), F.col("n").alias(f"n{x}"), F.col(c).alias(c + x))
    enough: Column = num * (F.col("na") + F.col("nb"))
    sized = F.least("na", "nb") * den >= F.greatest("na", "nb") * num
    near = pairs.join(side(marks, "a", "point"), "a").join(side(marks, "b", "point"), "b")
    near = cut(near.where(F.when(sized, overlap_bound("pointa", "pointb") * (num + den) >= enough).otherwise(False)).select("a", "b").distinct())
    sets = cut(detailed(only(docs, near.select(F.explode(F.array("a", "b")).alias("doc_id"))), n))
    both = near.join(side(sets, "a", "grams"), "a").join(side(sets, "b", "grams"), "b")
    return both.where(F.size(F.array_intersect("gramsa", "gramsb")) * (num + den) >= enough).select("a", "b").distinct()


def jaccard_classes(documents: DataFrame, n: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id, joining_links): sets link if den * intersection >= num * union.

    component_id is the smallest doc_id reachable by links; class_id the smallest with the same set; joining_links
    the verified links of the document's class that joined its component: at least one for each class of a component
    of several, but not all pairs of it. A text with fewer than n words is one gram, a text without words (or null)
    an empty set that links with nothing. Rows that repeat a doc_id are one document: each of its sets links on its
    own, and what they reach is one component. Rows without a doc_id are documents of their own, which link as others do, but
    name nothing: component_id and class_id are null where no document with an id is reached, or has the set. Further
    columns take no part. An empty table gives no rows. Hashes are of 64 bits a gram and of 128 bits a set.
    """
    if 2 * num < den:
        raise ValueError("similarities below 1/2 aren't supported")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if not docs.where("doc_id is null").limit(1).count():
        return classes_of(docs, n, num, den)
    nameless = cut(docs.where("doc_id is null").withColumn("doc_id", F.lit(FREE) + F.monotonically_increasing_id()))
    docs, ids = docs.where("doc_id is not null"), None
    if (docs.agg(F.max("doc_id")).first()[0] or 0) >= FREE:  # no room above: ids are numbered in their order
        ids = cut(numbered(docs.select("doc_id").distinct(), "place", F.col("doc_id")))
        docs = docs.join(ids, "doc_id").select(F.col("place").alias("doc_id"), "text")
    out = classes_of(docs.union(nameless), n, num, den)
    for c in ("doc_id", "component_id", "class_id"):
        out = out.withColumn(c, F.when(F.col(c) < FREE, F.col(c)))
        if ids is not None:
            out = out.join(ids.select(F.col("place").alias(c), F.col("doc_id").alias("_id")), c, "left").withColumn(c, F.col("_id")).drop("_id")
    return out.select("doc_id", "n_shingles", "component_id", "class_id", "joining_links")


def classes_of(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """jaccard_classes of (doc_id, text) without nulls."""
    rows = cut(outlined(docs, n, num, den))
    classes = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("class_id"))
    own = cut(rows.where("n > 0").select("doc_id", "n", "key").join(classes, "key").select("doc_id", "n", "class_id"))
    at = own.select("doc_id", F.col("class_id").alias("c")).distinct()
    # shards of several documents: the first of each with all others
    firsts = cut(first_of_shard(rows.select(F.inline("sigs"), "doc_id").select("sig", F.col("doc_id").alias("doc"), "more")))
    again = rows.select(F.explode("again").alias("sig"), F.col("doc_id").alias("b")).join(firsts.select("sig", "a").distinct(), "sig").select("sig", "a", "b")
    named = firsts.where("a <> b").union(again).join(at.withColumnsRenamed({"doc_id": "a", "c": "ca"}), "a").join(at.withColumnsRenamed({"doc_id": "b", "c": "cb"}), "b")
    shards = cut(named.where("ca <> cb").select("sig", F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    links = cut(shards.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    # several sets of one document: their classes are one component
    same = at.groupBy("doc_id").agg(F.min("c").alias("a"), F.max("c").alias("m")).where("a <> m")
    same = at.join(same, "doc_id").where("c <> a").select("a", F.col("c").alias("b"))
    marks = cut(pointed(only(docs, links.select(F.explode(F.array("a", "b")).alias("doc_id"))), n))
    sure = cut(verified(links, docs, marks, n, num, den).union(same).distinct())
    more = cut(verified(far_pairs(shards, connected(sure), marks, num, den), docs, marks, n, num, den))
    sure = sure.union(more).distinct()
    roots = connected(sure)
    degree = sure.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("joining_links"))
    roots = roots.join(degree, "node", "left").withColumnRenamed("node", "class_id")
    whole = rows.select("doc_id", "n").where("n = 0").withColumn("class_id", F.col("doc_id")).union(own.select("doc_id", "n", "class_id"))
    out = whole.join(roots, "class_id", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "class_id").alias("component_id"), "class_id", F.coalesce("joining_links", F.lit(0)).alias("joining_links"))


def far_pairs(shards: DataFrame, comps: DataFrame, marks: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of different components that share a shard and pass the bound (in shards of one leaf: the sizes).

    Of a shard of two the only pair has been compared; shards with the same members count once. Members outside a
    larger shard's largest component search trees of all members, TREE at most in each; the largest component never
    meets itself. So a large group of copies costs each stranger a few boxes.
    """
    placed = marks.select("doc", "n").join(comps.withColumnsRenamed({"node": "doc", "root": "comp"}), "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
    members = shards.select("sig", F.col("b").alias("doc")).union(shards.select("sig", F.col("a").alias("doc"))).distinct()
    rows = cut(members.join(placed, "doc").select("sig", "doc", "comp", "n"))
    same = lambda salt: F.bit_xor(F.xxhash64(F.lit(salt), "doc", "n"))
    mixed = rows.groupBy("sig").agg(F.min("comp").alias("c"), F.max("comp").alias("d"), F.count("*").alias("m"), same(1).alias("s"), same(2).alias("x")).where("c <> d and m > 2")
    mixed = cut(mixed.groupBy("m", "s", "x").agg(F.min("sig").alias("sig")).select("sig", "m"))
    held = cut(rows.join(mixed, "sig"))
    leaf = held.where(F.col("m") <= LEAF).groupBy("sig").agg(F.sort_array(F.collect_list(F.struct("doc", "comp", "n"))).alias("l"))
    fits = lambda x, y: (y["doc"] > x["doc"]) & (y["comp"] != x["comp"]) & (F.least(x["n"], y["n"]) * den >= F.greatest(x["n"], y["n"]) * num)
    met = F.transform("l", lambda x: F.transform(F.filter("l", lambda y: fits(x, y)), lambda y: F.struct(x["doc"].alias("a"), y["doc"].alias("b"))))
    close = leaf.select(F.inline(F.flatten(met))).distinct()
    large = held.where(F.col("m") > LEAF)
    main = large.groupBy("sig", "comp").agg(F.count("*").alias("k")).groupBy("sig").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), (F.sum("k") - F.max("k")).alias("others"))
    large = large.join(main, "sig")
    trees, asks = F.ceil(F.col("m") / TREE), F.ceil(F.col("others") / TREE)
    h = F.xxhash64("doc")
    as_held = large.select("sig", "doc", "comp", "n", F.lit(0).alias("side"), F.pmod(h, trees).alias("t"), F.explode(F.sequence(F.lit(0).cast("bigint"), asks - 1)).alias("q"))
    as_ask = large.where("comp <> main").select("sig", "doc", "comp", "n", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0).cast("bigint"), trees - 1)).alias("t"), F.pmod(h, asks).alias("q"))
    both = as_held.union(as_ask).join(marks, ["doc", "n"])
    return cross_pairs(both, num, den).union(close).distinct()
