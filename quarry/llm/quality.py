"""Quality classifier: random-indexing word vectors, pooled per document, then a two-layer
network with temperature-calibrated probabilities.

Tokens are runs of one kind of byte (lower-case and non-ASCII letters, capitals, digits,
one punctuation sign) hashed to ``BUCKETS`` buckets, so the vector table has a fixed size
at any corpus size. Every bucket has a sparse random index vector; a bucket's word vector
is the sum of the index vectors of all its neighbours in the whole corpus, summed by Spark
from per-batch partial tables. A document is the mean and the spread of its word vectors.
The network is fitted with NumPy on at most ``max_labels`` labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.mixing import uniform
from quarry.llm.store import written
from quarry.llm.textops import BYTE_VALUES, LOWER_AZ, SEPARATOR, mix, slices, span_hashes

BUCKETS = 1 << 13
DIMENSIONS = 32
NONZEROS = 4
REACH = 2  # neighbours on each side
FEATURES = 2 * DIMENSIONS + 2
BLOCK = 1 << 16  # tokens whose vectors are held at once, however long a text is

_KIND = np.arange(256, dtype=np.uint8)  # a punctuation sign is a kind of its own
_KIND[[*range(97, 123), *range(128, 256)]] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[SEPARATOR] = 0


def index_vectors() -> np.ndarray:
    """The random index vectors: ``NONZEROS`` entries of +-1 per bucket, from a fixed seed."""
    rng = np.random.default_rng(20240607)
    out = np.zeros((BUCKETS, DIMENSIONS), dtype=np.int16)
    for _ in range(NONZEROS):
        out[np.arange(BUCKETS), rng.integers(0, DIMENSIONS, BUCKETS)] += rng.choice(np.array([-1, 1], np.int16), BUCKETS)
    return out


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every token of a slice."""
    if len(data) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kind = _KIND[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offs] = True
    cut[1:-1] |= kind[1:] != kind[:-1]
    cut[0] = cut[-1] = True
    edges = np.flatnonzero(cut)
    start, end = edges[:-1], edges[1:]
    solid = kind[start] != 0
    start, end = start[solid], end[solid]
    row = np.searchsorted(offs, start, "right") - 1
    h = span_hashes(LOWER_AZ[data], start, end)
    # capitals keep their length only: a shouted word is a shape, not a word
    shout = (kind[start] == 2)
    h = np.where(shout, mix(np.minimum(end - start, 4).astype(np.uint64) + BYTE_VALUES[7]), h)
    return row, (h >> np.uint64(64 - (BUCKETS - 1).bit_length())).astype(np.int64)


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """(BUCKETS, DIMENSIONS) unit word vectors from all of ``docs``; comes to the driver, its
    size is a constant."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors()
        total = np.zeros((BUCKETS, DIMENSIONS), dtype=np.int64)
        for _, data, offs in slices(batches, text):
            row, bucket = tokens(data, offs)
            if len(bucket) < 2:
                continue
            for lo in range(0, len(bucket), BLOCK):  # a block of tokens and its neighbours outside
                a, z = max(lo - REACH, 0), min(lo + BLOCK + REACH, len(bucket))
                near = np.zeros((z - a, DIMENSIONS), dtype=np.int16)
                own = index[bucket[a:z]]
                for step in range(1, min(REACH, z - a - 1) + 1):
                    same = (row[a + step:z] == row[a:z - step])[:, None]
                    near[step:] += own[:-step] * same
                    near[:-step] += own[step:] * same
                inner = bucket[lo:lo + BLOCK]
                order = np.argsort(inner, kind="stable")
                found, first = np.unique(inner[order], return_index=True)
                total[found] += np.add.reduceat(near[lo - a:lo - a + len(inner)][order].astype(np.int32), first, axis=0)
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(total[used, i]) for i in range(DIMENSIONS)]],
                                         ["bucket", *[f"v{i}" for i in range(DIMENSIONS)]])

    schema = "bucket bigint, " + ", ".join(f"v{i} bigint" for i in range(DIMENSIONS))
    sums = docs.select(text).mapInArrow(run, schema).groupBy("bucket").agg(
        *[F.sum(f"v{i}").alias(f"v{i}") for i in range(DIMENSIONS)]).toPandas()
    out = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32)
    vectors = sums.drop(columns="bucket").to_numpy(dtype=np.float64)
    norms = np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))
    out[sums["bucket"].to_numpy(dtype=np.int64)] = vectors / np.maximum(norms, 1e-9)
    return out


def pooled(docs: DataFrame, vectors: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, features array<float>): mean and spread of the word vectors, the mean token
    change rate and log length; all 0 for a text without tokens."""
    kind = dict(docs.dtypes)[key]
    shared = docs.sparkSession.sparkContext.broadcast(vectors)  # BUCKETS x DIMENSIONS floats: 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for part, data, offs in slices(batches, "_text"):
            row, bucket = tokens(data, offs)
            rows = part.num_rows
            count = np.bincount(row, minlength=rows)
            out = np.zeros((rows, FEATURES), dtype=np.float64)
            some = np.flatnonzero(count)
            if len(some):
                sums, squares = np.zeros((rows, DIMENSIONS)), np.zeros((rows, DIMENSIONS))
                for lo in range(0, len(bucket), BLOCK):
                    found, first = np.unique(row[lo:lo + BLOCK], return_index=True)
                    v = table[bucket[lo:lo + BLOCK]]
                    sums[found] += np.add.reduceat(v, first, axis=0, dtype=np.float64)
                    squares[found] += np.add.reduceat(v * v, first, axis=0, dtype=np.float64)
                n = count[some][:, None]
                mean = sums[some] / n
                spread = np.sqrt(np.maximum(squares[some] / n - mean ** 2, 0))
                pair = np.unique(row * BUCKETS + bucket)
                distinct = np.bincount(pair // BUCKETS, minlength=rows)[some]
                out[some, :DIMENSIONS], out[some, DIMENSIONS:2 * DIMENSIONS] = mean, spread
                out[some, -2], out[some, -1] = np.log1p(distinct) / 8, np.log1p(count[some]) / 8
            lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * FEATURES), pa.array(out.astype(np.float32).ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], [key, "features"])

    return docs.select(key, F.col(text).alias("_text")).mapInArrow(run, f"`{key}` {kind}, features array<float>")


@dataclass
class Network:
    """Two layers, ReLU between them; ``temperature`` divides the logit."""

    center: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.center) / self.scale @ self.w1 + self.b1, 0)
        return h @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 24, steps: int = 1500, batch: int = 512,
                rate: float = 0.004, decay: float = 1e-3, seed: int = 5) -> Network:
    """Fit on nine tenths of the rows (in their given order); the others choose the step to stop
    at and the temperature, both by least log loss. Without both classes the score is the
    constant class share."""
    share = float(y.mean()) if len(y) else 0.5
    center = x.mean(axis=0) if len(x) else np.zeros(FEATURES)
    scale = x.std(axis=0) + 1e-3 if len(x) else np.ones(FEATURES)
    if len(y) < 10 or share in (0.0, 1.0):
        odds = np.log((share + 1e-3) / (1 - share + 1e-3))
        return Network(center, scale, np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), float(odds))
    rng = np.random.default_rng(seed)
    held = np.arange(len(y)) % 10 == 9
    xt, yt = x[~held], y[~held]
    p = [rng.normal(0, np.sqrt(2 / FEATURES), (FEATURES, hidden)), np.zeros(hidden),
         rng.normal(0, np.sqrt(1 / hidden), hidden), np.array(np.log(share / (1 - share)))]
    z = (xt - center) / scale
    log_loss = lambda logits, truth: np.logaddexp(0, np.where(truth == 1, -logits, logits)).mean()
    best, best_loss = [a.copy() for a in p], np.inf
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for step in range(1, steps + 1):
        at = rng.integers(0, len(yt), min(batch, len(yt)))
        a = z[at] @ p[0] + p[1]
        h = np.maximum(a, 0)
        e = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -60, 60))) - yt[at]) / len(at)
        back = np.outer(e, p[2]) * (a > 0)
        grads = [z[at].T @ back + decay * p[0], back.sum(axis=0), h.T @ e + decay * p[2], e.sum()]
        pace = rate * (1 - 0.9 * step / steps)
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            p[i] = p[i] - pace * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
        if step % 25 == 0:
            now = log_loss(Network(center, scale, p[0], p[1], p[2], float(p[3])).logits(x[held]), y[held])
            if now < best_loss:
                best, best_loss = [a.copy() for a in p], now
    net = Network(center, scale, best[0], best[1], best[2], float(best[3]))
    if 0 < y[held].mean() < 1:
        logits = net.logits(x[held])
        net.temperature = float(min(np.geomspace(0.25, 8, 121), key=lambda t: log_loss(logits / t, y[held])))
    return net


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the key's text leaves the remainder ``part``; a null key's text is empty."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == part


def score_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
                  learn_from: Column | None = None, max_labels: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """(key, score, predicted) for every row of ``docs``: the calibrated probability of label 1.

    ``labels`` is (key, label 0/1); only rows with ``learn_from`` (a condition on ``key``)
    and a label are learned, at most ``max_labels`` of them, drawn by a hash of the key. Word
    statistics cover all documents. Null and empty texts get the score of zero features; repeated rows and null keys are scored like others; without labels every score
    is 0.5; an empty table gives no rows. Other columns are not carried.
    """
    vectors = word_vectors(docs, text)
    features = written(pooled(docs, vectors, key, text), "features")
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("_k")).agg(F.max(label).alias("_y"))
    if learn_from is not None:
        features_in = features.where(learn_from)
    else:
        features_in = features
    labelled = features_in.join(known, features_in[key] == F.col("_k")).select(uniform(F.lit("labels"), F.col("_k")).alias("o"), "features", "_y")
    # a hash threshold, not a sort: no more than the sample itself comes to the driver
    share = max_labels / max(labelled.count(), 1)
    sample = labelled.where(F.col("o") < share).toPandas().sort_values("o", kind="stable")[:max_labels]
    x = np.array(sample["features"].tolist(), dtype=np.float64).reshape(-1, FEATURES)
    net = fit_network(x, sample["_y"].to_numpy(dtype=np.float64))
    kind = dict(features.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES).astype(np.float64)
            score = net.probabilities(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                             [key, "score", "predicted"])

    return features.mapInArrow(run, f"`{key}` {kind}, score double, predicted int")
