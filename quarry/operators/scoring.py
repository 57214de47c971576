"""Linear softmax scoring: logits, log-softmax, predicted class, row loss.

A model is a small parameter table ``(name, shape array<int>, values array<double>,
trainable boolean)`` with ``weight`` (classes x features, row-major) and ``bias``.
Scoring ships the parameters inside the plan (every task holds the model, as every
worker does in data-parallel evaluation), so the scored rows never move: no join, no
shuffle. The parameter count is checked before the model leaves its table.

A larger model is a table of its class rows (:func:`class_mean_rows`), and
:func:`score_by_class_rows` streams them past chunks of the scored rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.functions.arrays import argmax_index, array_dot, array_log_softmax
from quarry.operators.indexing import global_index

#: documented limit of a model that the driver holds and the plan carries
MAX_PARAMETERS = 1_000_000


@dataclass
class LinearModel:
    weight: np.ndarray  # (classes, features)
    bias: np.ndarray    # (classes,)
    labels: list | None = None  # the class of each row; None: 0, 1, 2, ...

    @property
    def classes(self) -> int:
        return int(self.weight.shape[0])

    def to_frame(self, spark) -> DataFrame:
        rows = [("weight", [int(s) for s in self.weight.shape], [float(v) for v in self.weight.ravel()], True),
                ("bias", [int(self.bias.shape[0])], [float(v) for v in self.bias], True)]
        if self.labels is not None:
            rows.append(("labels", [len(self.labels)], [float(v) for v in self.labels], False))
        return spark.createDataFrame(
            rows, "name string, shape array<int>, values array<double>, trainable boolean")


def class_mean_model(train: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """Weights = per-class mean feature vector, bias 0, as a parameter table; ``labels`` holds
    the class of each weight row, so classes may have gaps.

    The element-wise mean is a (label, position) aggregation with a map-side partial
    sum; only classes x features cells are shuffled.
    """
    cells = (
        train.select(label, F.posexplode(features).alias("j", "x"))
        .groupBy(label, "j").agg(F.avg("x").alias("w"))
    )
    per_class = cells.groupBy(label).agg(F.array_sort(F.collect_list(F.struct("j", "w"))).alias("cells"))
    # classes x features values in one row: the size of the model, not of the data
    weight = per_class.agg(
        F.array_sort(F.collect_list(F.struct(F.col(label).alias("c"), "cells"))).alias("rows")
    ).select(
        F.lit("weight").alias("name"),
        F.array(F.size("rows"), F.size(F.get(F.col("rows"), 0)["cells"])).alias("shape"),
        F.flatten(F.transform("rows", lambda r: F.transform(r["cells"], lambda c: c["w"].cast("double")))).alias("values"),
        F.lit(True).alias("trainable"),
    )
    bias = weight.select(
        F.lit("bias").alias("name"), F.array(F.get(F.col("shape"), 0)).alias("shape"),
        F.array_repeat(F.lit(0.0).cast("double"), F.get(F.col("shape"), 0)).alias("values"),
        F.lit(True).alias("trainable"),
    )
    labels = per_class.agg(F.sort_array(F.collect_list(F.col(label).cast("double"))).alias("values")).select(
        F.lit("labels").alias("name"), F.array(F.size("values")).alias("shape"), "values", F.lit(False).alias("trainable"))
    return weight.unionByName(bias).unionByName(labels)


def load_linear(model: DataFrame, max_parameters: int = MAX_PARAMETERS) -> LinearModel:
    """Bring a (size-checked) parameter table to the driver as arrays."""
    sizes = model.select(F.aggregate("shape", F.lit(1).cast("bigint"), lambda a, s: a * s).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    if total > max_parameters:
        raise ValueError(f"model has {total} parameters, more than {max_parameters}")
    params = {r["name"]: (r["shape"], r["values"]) for r in model.select("name", "shape", "values").collect()}
    wshape, wvals = params["weight"]
    w = np.asarray(wvals, dtype=np.float64).reshape(wshape)
    b = np.asarray(params["bias"][1], dtype=np.float64) if "bias" in params else np.zeros(wshape[0])
    labels = [int(v) for v in params["labels"][1]] if "labels" in params else None
    return LinearModel(w, b, labels)


def class_mean_rows(train: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """The class-mean model as ``(label, weight array<double>, bias)``, one row per class."""
    cells = train.select(label, F.posexplode(features).alias("j", "x")).groupBy(label, "j").agg(F.avg("x").alias("w"))
    return cells.groupBy(F.col(label).alias("label")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("j", F.col("w").cast("double").alias("w")))), lambda c: c["w"]).alias("weight"),
        F.lit(0.0).cast("double").alias("bias"))


#: feature cells of the rows that a task holds while the model passes by (8 bytes each)
CHUNK_CELLS = 8_000_000
#: logits of a chunk that are worked out at a time
LOGIT_CELLS = 2_000_000


class _Chunk:
    """Rows of a chunk and what the classes seen so far make of them."""

    def __init__(self, parts: list[pa.RecordBatch]):
        self.rows = pa.Table.from_batches(parts).combine_chunks()
        x = self.rows.column("_x").chunk(0)
        self.x = x.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(x), -1)
        n = len(x)
        truth = self.rows.column("_truth").to_numpy(zero_copy_only=False).astype(np.float64)  # null: NaN
        self.truth, self.at, self.loss = truth, np.zeros(n, dtype=np.int64), np.full(n, np.nan)
        self.top, self.mass = np.full(n, -np.inf), np.zeros(n)

    def see(self, order: np.ndarray, weight: np.ndarray, bias: np.ndarray) -> None:
        z = self.x @ weight.T + bias
        best = z.argmax(axis=1)
        high = z[np.arange(len(z)), best]
        new = np.maximum(self.top, high)
        self.mass = self.mass * np.exp(self.top - new) + np.exp(z - new[:, None]).sum(axis=1)
        self.at = np.where(high > self.top, order[best], self.at)  # classes come in order: a tie keeps the first
        self.top = new
        mine = np.flatnonzero((self.truth >= order[0]) & (self.truth <= order[-1]))
        self.loss[mine] = z[mine, np.searchsorted(order, self.truth[mine])]

    def done(self, keep: list[str]) -> pa.RecordBatch:
        loss = self.top + np.log(self.mass) - self.loss
        arrays = [*(self.rows.column(c).combine_chunks() for c in keep), pa.array(self.at), pa.array(loss, mask=np.isnan(loss))]
        arrays = [a.chunk(0) if isinstance(a, pa.ChunkedArray) else a for a in arrays]
        return pa.RecordBatch.from_arrays(arrays, [*keep, "_place", "loss"])


def score_by_class_rows(df: DataFrame, model: DataFrame, features: str = "features", label: str | None = "label",
                        keep: Sequence[str] = ("id",), chunk_cells: int = CHUNK_CELLS) -> DataFrame:
    """``keep`` columns, ``pred`` (the first class, by label, with the highest logit) and ``loss``
    (cross-entropy; null for a class the model lacks, and without ``label``) under a softmax
    model of any size, given as ``(label, weight array<double>, bias)`` rows.

    Rows are dealt into chunks of about ``chunk_cells`` feature cells and every chunk is joined by a
    copy of the model, sorted behind its rows. A task holds one chunk and a batch of
    class rows: logits are folded into a running maximum and sum as the classes pass, so neither
    the model nor a row's logits are ever whole in one place. A chunk moves the model once; a
    larger ``chunk_cells`` moves less. The driver sees two counts.
    """
    keep = list(keep)
    spark = df.sparkSession
    n_rows, width = df.agg(F.count(F.lit(1)), F.max(F.size(features))).first()
    chunks = max(1, math.ceil(n_rows * max(width or 0, 1) / chunk_cells), min(spark.sparkContext.defaultParallelism, n_rows // 64))
    classes = model.select("label", F.col("weight").cast("array<double>").alias("weight"), F.col("bias").cast("double").alias("bias"))
    index = global_index(classes.select("label"), ["label"], pos="_order")
    classes = classes.join(index, "label")
    truth = F.col(label) if label else F.lit(None).cast(model.schema["label"].dataType)
    rows = (df.select(*keep, F.col(features).cast("array<double>").alias("_x"), truth.alias("_label"))
            .join(index.select(F.col("label").alias("_label"), F.col("_order").alias("_truth")), "_label", "left")
            .select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(chunks)).cast("int").alias("_chunk"),
                    F.lit(-1).cast("bigint").alias("_order"), *keep, "_x", "_truth", F.lit(None).cast("double").alias("_bias")))
    copies = classes.select(F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("_chunk"), "_order",
                            *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in keep], F.col("weight").alias("_x"),
                            F.lit(None).cast("bigint").alias("_truth"), F.col("bias").alias("_bias"))
    stream = rows.unionByName(copies).repartition(chunks, "_chunk").sortWithinPartitions("_chunk", "_order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        chunk: _Chunk | None = None
        current = None
        for batch in batches:
            of = batch.column("_chunk").to_numpy()
            order = batch.column("_order").to_numpy()
            # runs of one chunk and one kind (rows, classes)
            cuts = np.flatnonzero((of[1:] != of[:-1]) | ((order[1:] < 0) != (order[:-1] < 0))) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(of)]):
                if lo == hi:
                    continue
                if of[lo] != current:
                    if chunk is not None:
                        yield chunk.done(keep)
                    held, chunk, current = [], None, of[lo]
                part = batch.slice(lo, hi - lo)
                if order[lo] < 0:
                    held.append(part)
                    continue
                if held:
                    chunk, held = _Chunk(held), []
                if chunk is not None:
                    x = part.column("_x")
                    weight = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
                    step = max(1, LOGIT_CELLS // len(chunk.x))
                    for a in range(0, len(weight), step):
                        chunk.see(order[lo + a:min(lo + a + step, hi)], weight[a:a + step], part.column("_bias").to_numpy()[a:a + step])
        if chunk is not None:
            yield chunk.done(keep)

    schema = StructType([*[df.schema[c] for c in keep], *StructType.fromDDL("_place bigint, loss double").fields])
    found = stream.mapInArrow(run, schema)
    names = index.select(F.col("label").alias("pred"), F.col("_order").alias("_place"))
    return found.join(names, "_place").select(*keep, "pred", "loss")


def _literal_matrix(m: np.ndarray) -> Column:
    return F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in m])


def linear_logits(df: DataFrame, model: LinearModel, features: str = "features",
                  out: str = "logits") -> DataFrame:
    """``logits[c] = features . weight[c] + bias[c]`` as an array column."""
    w = _literal_matrix(model.weight)
    b = F.array(*[F.lit(float(v)) for v in model.bias])
    logits = F.transform(w, lambda row, i: array_dot(F.col(features), row) + F.element_at(b, i + 1))
    return df.withColumn(out, logits)


def score_linear(df: DataFrame, model: LinearModel, features: str = "features",
                 label: str | None = "label") -> DataFrame:
    """Logits, log-probabilities (in the model's class order), predicted class and (with a
    label) the row loss, as array expressions whatever the model's size."""
    if model.weight.size + model.bias.size > MAX_PARAMETERS:
        raise ValueError(f"model has more than {MAX_PARAMETERS} parameters")
    out = linear_logits(df, model, features)
    out = out.withColumn("log_probs", array_log_softmax(F.col("logits")))
    place = argmax_index(F.col("log_probs"))
    if model.labels is None:
        out = out.withColumn("pred", place)
        truth = F.col(label) if label else None
    else:
        classes = F.array(*[F.lit(int(v)) for v in model.labels])
        out = out.withColumn("pred", F.get(classes, place))
        truth = F.array_position(classes, F.col(label).cast("int")) - 1 if label else None
    return out.withColumn("loss", row_loss(F.col("log_probs"), truth)) if label else out


def row_loss(log_probs: Column, truth: Column) -> Column:
    """Cross-entropy of one row: ``-log_softmax[truth]``; null for a class the model lacks."""
    return -F.get(log_probs, truth.cast("int"))


def parameter_count(model: DataFrame) -> DataFrame:
    """Sum over trainable parameters of the product of the shape (one row)."""
    n = F.aggregate("shape", F.lit(1).cast("bigint"), lambda a, s: a * s)
    return model.where(F.col("trainable")).agg(F.sum(n).cast("bigint").alias("parameters"))
