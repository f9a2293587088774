"""Quality classifier: random-indexing word vectors pooled per document, a two-layer network, calibrated by temperature.

Every word, hashed to one of BUCKETS, has a sparse random index vector; its word vector is the sum of the index
vectors of its neighbours over the whole corpus (all integers, so sums agree in any order). The table of
word vectors has a fixed size whatever the corpus. A document is the mean and spread of its words' vectors.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Word buckets, dimensions, entries of an index vector, neighbours on each side, tokens handled at once.
BUCKETS, DIMS, ENTRIES, WINDOW, CHUNK = 16384, 32, 2, 2, 200_000
#: Marks for a word equal to the one before, and for a word in capitals.
SAME, CAPITALS = 0, 1
#: Labelled rows that the network is fitted on, at most (the lowest by a hash of the id), and one in so many that calibrates.
TRAIN_ROWS, CALIBRATE = 20_000, 5
HIDDEN, EPOCHS, RATE, DECAY = 32, 60, 0.01, 1e-4

TOKEN = re.compile(r"\w+|[^\w\s]")


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that no label is learned from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Buckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = b = CAPITALS if len(word) > 1 and word.isupper() else 2 + zlib.crc32(word.encode("utf-8", "surrogatepass")) % (BUCKETS - 2)
        return b


def tokens(text: str | None, seen: Buckets) -> np.ndarray:
    found = TOKEN.findall(text or "")
    ids = np.fromiter(map(seen.__getitem__, found), np.int64, len(found))
    if len(ids) > 1:
        ids[1:][ids[1:] == ids[:-1]] = SAME
    return ids


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's entries, the same everywhere."""
    rng = np.random.default_rng(20)
    return rng.integers(0, DIMS, (BUCKETS, ENTRIES)), rng.choice([-1.0, 1.0], (BUCKETS, ENTRIES))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The (BUCKETS, DIMS) table of unit word vectors: partial tables per task, summed by Spark."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, (place, sign) = Buckets(), index_vectors()
        table = np.zeros(BUCKETS * DIMS)

        def add(ids: np.ndarray, of: np.ndarray) -> None:
            for e in range(ENTRIES):
                table[:] += np.bincount(ids * DIMS + place[of, e], sign[of, e], BUCKETS * DIMS)

        def flush(parts: list[np.ndarray]) -> None:
            ids = np.concatenate(parts)
            doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            for k in range(1, WINDOW + 1):
                near = doc[k:] == doc[:-k]
                left, right = ids[:-k][near], ids[k:][near]
                add(np.concatenate([left, right]), np.concatenate([right, left]))

        parts, n = [], 0
        for batch in batches:
            for text in batch["text"]:
                ids = tokens(text, seen)
                parts.append(ids)
                n += len(ids)
                if n >= CHUNK:
                    flush(parts)
                    parts, n = [], 0
        if parts:
            flush(parts)
        sums = table.reshape(BUCKETS, DIMS).astype(np.int64)
        used = np.flatnonzero(sums.any(axis=1))
        yield pd.DataFrame(np.column_stack([used, sums[used]]), columns=["bucket", *names])

    names = [f"v{i}" for i in range(DIMS)]
    partial = docs.select("text").mapInPandas(count, "bucket long, " + ", ".join(f"{n} long" for n in names))
    rows = partial.groupBy("bucket").agg(*(F.sum(n).alias(n) for n in names)).toPandas()  # BUCKETS rows at most
    table = np.zeros((BUCKETS, DIMS), np.float32)
    if len(rows):
        v = rows[names].to_numpy(np.float64)
        table[rows["bucket"].to_numpy()] = v / np.maximum(1.0, np.linalg.norm(v, axis=1, keepdims=True))
    return table


def pooled(texts: pd.Series, table: np.ndarray, seen: Buckets) -> np.ndarray:
    """Mean and spread of the word vectors of each text; zeros for a text without words."""
    out = np.zeros((len(texts), 2 * DIMS), np.float32)
    for i, text in enumerate(texts):
        ids = tokens(text, seen)
        if len(ids):
            one, two = np.zeros(DIMS), np.zeros(DIMS)
            for at in range(0, len(ids), CHUNK):
                v = table[ids[at : at + CHUNK]]
                one += v.sum(axis=0, dtype=np.float64)
                two += np.square(v).sum(axis=0, dtype=np.float64)
            mean = one / len(ids)
            out[i, :DIMS], out[i, DIMS:] = mean, np.sqrt(np.maximum(0, two / len(ids) - mean * mean))
    return out


@dataclass
class Network:
    """standardise, tanh layer, logistic layer; temperature divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on the log loss over four in five rows; the temperature minimises the loss of the fifth."""
    rng = np.random.default_rng(5)
    x, y = x.astype(np.float64), y.astype(np.float64)
    net = Network(x.mean(0) if len(x) else np.zeros(2 * DIMS), (x.std(0) if len(x) else np.zeros(2 * DIMS)) + 1e-6, rng.normal(0, (2 * DIMS) ** -0.5, (2 * DIMS, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    if not len(x):
        return net
    aside = np.arange(len(x)) % CALIBRATE == 0
    if len(x) < 10 * CALIBRATE:
        aside[:] = False
    xs, ys = ((x - net.mean) / net.scale)[~aside], y[~aside]
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(xs))
        for at in range(0, len(xs), 256):
            some = order[at : at + 256]
            h = np.tanh(xs[some] @ params[0] + params[1])
            err = (1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -500, 500))) - ys[some]) / len(some)
            back = np.outer(err, params[2]) * (1 - h * h)
            grads = [xs[some].T @ back + DECAY * params[0], back.sum(0), h.T @ err + DECAY * params[2], np.array([err.sum()])]
            t += 1
            for p, g, a, b in zip(params, grads, m, v):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= RATE * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
    net.b2 = float(params[3][0])
    if aside.any():
        z, ya = net.logits(x[aside]), y[aside]
        grid = np.exp(np.linspace(-2, 3, 101))
        loss = [np.mean(np.logaddexp(0, z / g) - ya * z / g) for g in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


@dataclass
class Classifier:
    table: np.ndarray
    network: Network

    def score(self, text: str = "text") -> Column:
        """The score of a text column, as a column; a null text scores as an empty one."""
        table, network = self.table, self.network

        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            seen = Buckets()
            for texts in batches:
                yield pd.Series(network.score(pooled(texts, table, seen).astype(np.float64)))

        return F.pandas_udf(scored, "double")(F.col(text))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Classifier:
    """Word vectors from all documents, the network from at most so many labelled rows outside the held-out fold.

    Rows with a null label or id aren't learned from; of a document's several labels the lowest counts, and of its texts the least.
    Without any label every score is 0.5.
    """
    table = word_vectors(docs)
    some = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # bounded, so it may be broadcast

    def pool(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Buckets()
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "quality": b["quality"], "x": list(pooled(b["text"], table, seen))})

    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(some), "doc_id")
    # rows that repeat an id are one example, the least text; so the driver gets `rows` vectors at most
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"), F.min("text").alias("text"))
    seen = known.mapInPandas(pool, "doc_id long, quality int, x array<float>").toPandas().sort_values("doc_id", kind="stable").reset_index(drop=True)
    x = np.stack(seen["x"].to_numpy()) if len(seen) else np.zeros((0, 2 * DIMS))
    return Classifier(table, fit(x, seen["quality"].to_numpy() if len(seen) else np.zeros(0)))


def score_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; repeated rows and null ids each keep a row (a null id isn't
    held out), further columns take no part, an empty table gives no rows."""
    model = train(documents.select("doc_id", "text"), labels)
    out = documents.select("doc_id", held_out().alias("held_out"), model.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
