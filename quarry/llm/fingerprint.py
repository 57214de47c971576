"""Document fingerprints: homomorphic multiset hash of paragraphs.

A paragraph is a non-empty line. Each paragraph is hashed to a wide vector of two parts:

* ``EXACT_LANES`` uniform 64-bit lanes drawn from the hash of the whole paragraph, and
* ``SKETCH_LANES`` 32-bit lanes to which each run of up to three words of the paragraph
  adds +1 or -1 at one lane.

A document's fingerprint is the lane-wise sum over its paragraphs, modulo 2**64 and
2**32 (a lane wraps only beyond 2**31 words of one sign, more than a text can hold). Paragraph order is irrelevant, and inserting or deleting a paragraph adds or
subtracts its vector (`combine`), without the rest of the document. The exact lanes
decide equality; the sketch keeps inner products, so `likeness` of two fingerprints
estimates how much of their paragraphs' content is shared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.textops import Words, mix, slices, string_buffers

EXACT_LANES = 8
SKETCH_LANES = 128
_WIDTH = EXACT_LANES * 8 + SKETCH_LANES * 4
_LANE_SEEDS = mix(np.arange(1, EXACT_LANES + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))
_NEWLINE = np.zeros(256, dtype=bool)
_NEWLINE[0x0A] = True


def vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprint bytes, one row of ``_WIDTH`` uint8 per text of a slice."""
    rows = len(offsets) - 1
    lines, words = Words(data, offsets, _NEWLINE), Words(data, offsets)
    exact = np.zeros((rows, EXACT_LANES), dtype=np.uint64)
    for lane, seed in enumerate(_LANE_SEEDS):
        sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(lines.hash + seed), dtype=np.uint64)))
        exact[:, lane] = sums[lines.first[1:]] - sums[lines.first[:-1]]
    n = len(words.hash)
    line = np.searchsorted(lines.start, words.start, "right")
    run = words.hash * np.uint64(0xD1342543DE82EF95)
    for ahead in (1, 2):
        if n > ahead:
            same = line[ahead:] == line[:-ahead]
            run[:-ahead] += np.where(same, mix(words.hash[ahead:] + np.uint64(ahead)), np.uint64(0))
    run = mix(run)
    cell = words.row * SKETCH_LANES + (run & np.uint64(SKETCH_LANES - 1)).astype(np.int64)
    sign = 1.0 - 2.0 * (run >> np.uint64(63)).astype(np.float64)
    sketch = np.bincount(cell, weights=sign, minlength=rows * SKETCH_LANES).astype(np.int64).astype(np.uint32)
    return np.concatenate((exact.view(np.uint8).reshape(rows, -1), sketch.view(np.uint8).reshape(rows, -1)), axis=1)


def combine(a: np.ndarray, b: np.ndarray, sign: int = 1) -> np.ndarray:
    """Fingerprints of the union (``sign`` 1) or difference (-1) of two paragraph multisets."""
    exact = [x[:, :EXACT_LANES * 8].copy().view(np.uint64) for x in (a, b)]
    sketch = [x[:, EXACT_LANES * 8:].copy().view(np.uint32) for x in (a, b)]
    out = [(x + y if sign > 0 else x - y) for x, y in (exact, sketch)]
    return np.concatenate([x.view(np.uint8) for x in out], axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1 per row: 1 for equal fingerprints, else the sketches' cosine (at least 0)."""
    x, y = (v[:, EXACT_LANES * 8:].copy().view(np.int32).astype(np.float64) for v in (a, b))
    norm = np.sqrt((x * x).sum(1) * (y * y).sum(1))
    cosine = np.where(norm > 0, (x * y).sum(1) / np.where(norm > 0, norm, 1), 0.0)
    return np.where((a == b).all(1), 1.0, np.clip(cosine, 0.0, 1.0))


def _hex(v: np.ndarray) -> list[str]:
    whole = v.tobytes().hex()
    return [whole[i:i + 2 * _WIDTH] for i in range(0, len(whole), 2 * _WIDTH)]


def _of_slice(batch: pa.RecordBatch, column: str, data=None, offs=None) -> np.ndarray:
    if data is None:
        data, offs = string_buffers(batch.column(column))
    return vectors(data, offs)


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with a column ``out`` (hex string). Null and empty texts get the sum over
    no paragraph (all zeros); a column of that name is replaced, others pass through."""
    docs = docs.drop(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in slices(batches, text):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_hex(vectors(data, offs)), pa.string())],
                                             [*batch.schema.names, out])

    return docs.mapInArrow(run, docs.select("*", F.lit("").alias(out)).schema)


def _partition_of(key: Column, bounds: list[int]) -> Column:
    """How many of the descending ``bounds`` are above ``key``, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    table = F.array(*[F.lit(b).cast("bigint") for b in bounds])
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when((at + step <= len(bounds))
                                & (F.element_at(table, F.least(at + step, F.lit(len(bounds)))) > key), at + step).otherwise(at))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", out: str = "next_text") -> DataFrame:
    """(key, text, ``out``): the text of the next document in descending ``key`` order, the
    first document's after the last. Null keys come last; equal keys follow in an order of
    their texts' hashes, equal texts in any.

    Rows are dealt by key ranges (bounds from an approximate percentile over the keys
    alone, one range or more per task). A key that fills several ranges, null included, is
    dealt over as many by the hash of the text, so rows are gathered in one task only if
    key and text are equal. The head of each range, one row, is also sent to the range
    before it, so no window spans two ranges and none holds the whole table.
    """
    spark = docs.sparkSession
    least = -(1 << 63)
    rows = docs.select(F.col(key), F.col(text).alias("_t"),
                       F.coalesce(F.col(key).cast("bigint"), F.lit(least)).alias("_key"),
                       F.xxhash64(F.col(text)).alias("_hash"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.percentile_approx("_key", shares, 20 * ranges)).first()[0] or []
    bounds = sorted(set(found), reverse=True)
    # a range ends with its bound, so the pieces of a bound's key are the last of its range
    pieces = F.lit(1)
    if heavy := [x for b in bounds if found.count(b) > 1 for x in (F.lit(b).cast("bigint"), F.lit(found.count(b)))]:
        pieces = F.coalesce(F.try_element_at(F.create_map(*heavy), F.col("_key")), pieces)
    placed = (rows.withColumn("_piece", F.pmod("_hash", pieces))
              .withColumn("_range", (_partition_of(F.col("_key"), bounds) * ranges + F.col("_piece")).cast("int")))
    # one row per range, at most 4 x shuffle partitions of them
    first = F.min(F.struct((-1 - F.col("_key")).alias("k"), F.col("_hash").alias("h"))).alias("head")
    heads = placed.groupBy("_range").agg(first).orderBy("_range").select("_range", "head.*").collect()
    before = [(-1 - h["k"], h["h"], h["_range"], heads[i - 1]["_range"]) for i, h in enumerate(heads)]
    halo = F.broadcast(spark.createDataFrame(before, "_k bigint, _h bigint, _r int, _before int"))
    dealt = placed.join(halo, (F.col("_range") == F.col("_r")) & (F.col("_key") == F.col("_k"))
                        & (F.col("_hash") == F.col("_h")), "left")
    stay = F.struct(F.col("_range").alias("r"), F.lit(False).alias("h"))
    ahead = F.struct(F.col("_before").alias("r"), F.lit(True).alias("h"))
    dealt = dealt.withColumn("_to", F.explode(F.when(F.col("_r").isNull(), F.array(stay)).otherwise(F.array(stay, ahead))))
    order = Window.partitionBy("_to.r").orderBy(F.col("_to.h"), F.col("_key").desc(), "_hash", "_t")
    return (dealt.withColumn(out, F.lead("_t").over(order)).where(~F.col("_to.h"))
            .select(F.col(key), F.col("_t").alias(text), F.col(out)))


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited form, the last third of its code points
    replaced by as many of the next document's first (or all of them).

    Returns (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next). A null text is empty; rows with equal keys are each other's successors; a table of one row is its own successor; an empty table gives no rows.
    """
    pairs = with_next(docs, key, text)
    own, following = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col("next_text"), F.lit(""))
    third = F.floor(F.length("_own") / 3).cast("int")
    pairs = (pairs.select(F.col(key), own.alias("_own"), following.alias("_next"))
             .withColumn("_edited", F.concat(F.substring("_own", F.lit(1), F.length("_own") - third),
                                             F.substring("_next", F.lit(1), third)))
             .select(key, F.length("_own").cast("bigint").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"),
                     "_own", "_edited", "_next"))
    kind = dict(pairs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offs in slices(batches, "_own"):
            own = vectors(data, offs)
            edited, following = _of_slice(batch, "_edited"), _of_slice(batch, "_next")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column("n_chars"), batch.column("edited_sha256"),
                 pa.array(_hex(own), pa.string()), pa.array(_hex(edited), pa.string()),
                 pa.array(likeness(own, edited)), pa.array(likeness(own, following))],
                [key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return pairs.mapInArrow(run, f"`{key}` {kind}, n_chars bigint, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double")
