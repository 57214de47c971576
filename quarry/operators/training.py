"""Data-parallel training of a linear softmax classifier on Spark.

* rows get ``(epoch, rank, step)`` from :func:`assign_batches` (disjoint rank shards) and
  are spread by (rank, step, chunk), so the ranks of a step, and the chunks of a rank, are
  worked on at once;
* every task sums the cross-entropy gradient of its rows per ``(step, rank)`` batch in NumPy,
  over Arrow batches or over cached blocks of rows (the only Python that runs in tasks);
* the model-sized partial sums are added and the rank gradients combined (``gather_mean``:
  average over the ranks present; ``allreduce``: sum of ``g / world_size``) by grouped
  aggregations in the same job, or, up to ``SUMS_PER_TASK`` sums, by the driver: a step is
  then a job of one stage on blocks (:func:`row_blocks`) that no plan is made for;
* the driver holds the model (classes x features + classes values, size-checked) and
  applies the optimizer update; data never passes through it.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.indexing import assign_batches, global_index
from quarry.operators.scoring import MAX_PARAMETERS, LinearModel
from quarry.session import shuffle_partitions

#: long form: ``j`` = -2 loss, -1 correct predictions, then weights row by row, then biases
GRADIENT_SCHEMA = "epoch int, step int, rank int, j int, value double, rows long"
_FIRST = -2
#: bytes of partial sums that a task holds before it emits them
_FLUSH_BYTES = 64 << 20
#: feature cells (8 bytes each) that are worth a partition, and so a task of every step that reads it
PARTITION_CELLS = 1 << 18
#: steps that a window is dealt for at least, however large they are
WINDOW_STEPS = 4
#: partial sums (of all ranks and partitions of a step) that are worth a summing task
SUMS_PER_TASK = 1 << 17
BLOCK_SCHEMA = "step int, rank int, rows int, features binary, label binary"


def _sums(w: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sum over rows of loss, correct predictions and the cross-entropy gradient."""
    z = x @ w.T + b
    z = z - z.max(axis=1, keepdims=True)
    logp = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
    rows = np.arange(len(y))
    p = np.exp(logp)
    head = [float(-logp[rows, y].sum()), float((np.argmax(logp, axis=1) == y).sum())]
    p[rows, y] -= 1.0
    return np.concatenate([head, (p.T @ x).ravel(), p.sum(axis=0)])


def _rows_of(g: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return np.stack(g["features"].to_numpy()).astype(np.float64), g["label"].to_numpy().astype(np.int64)


def _partial_fn(weight: np.ndarray, bias: np.ndarray):
    """Per task: stream Arrow batches, keep per-(epoch, step, rank) sums of loss, correct
    predictions and the cross-entropy gradient, emit them in long form with the number of
    rows behind them."""
    w = np.asarray(weight, dtype=np.float64)
    b = np.asarray(bias, dtype=np.float64)
    width = w.size + b.size

    def emit(acc):
        for (e, s, r), (n, vec) in acc.items():
            yield pd.DataFrame({"epoch": e, "step": s, "rank": r, "j": np.arange(_FIRST, width, dtype=np.int32),
                                "value": vec, "rows": n})

    def fn(batches):
        acc: dict = {}
        for pdf in batches:
            if pdf.empty:
                continue
            for key, g in pdf.groupby(["epoch", "step", "rank"], sort=False):
                x, y = _rows_of(g)
                key = tuple(int(k) for k in key)
                n, held = acc.get(key, (0, 0.0))
                acc[key] = (n + len(y), held + _sums(w, b, x, y))
            if len(acc) * (width - _FIRST) * 8 > _FLUSH_BYTES:  # they are summed later anyway
                yield from emit(acc)
                acc = {}
        yield from emit(acc)

    return fn


def _training_columns(batched: DataFrame) -> DataFrame:
    return batched.select("epoch", "step", "rank", F.col("features").cast("array<double>").alias("features"),
                          F.col("label").cast("long").alias("label"))


def partial_gradients(batched: DataFrame, model: LinearModel, sum_partitions: int | None = None) -> DataFrame:
    """``(epoch, step, rank, j, value, rows)``: each rank's mean loss (j = -2), mean correct
    (-1) and mean gradient (weights row by row, then biases), and its batch size.

    Each task sums the rows it has per batch; the model-sized partial sums are added up by
    a grouped aggregation, so no batch is ever gathered into one task, however large
    ``batch_size`` is, and no gradient becomes one record. ``sum_partitions`` deals the
    partial sums into so many by ``j`` alone, so that a combination by ``j`` needs no second
    exchange (for a few batches; the sums of many are dealt by batch and ``j``).
    """
    partial = _training_columns(batched).mapInPandas(_partial_fn(model.weight, model.bias), GRADIENT_SCHEMA)
    if sum_partitions:
        partial = partial.repartition(sum_partitions, "j")
    return partial.groupBy("epoch", "step", "rank", "j").agg(
        (F.sum("value") / F.sum("rows")).alias("value"), F.sum("rows").alias("rows"))


def _combiner(how: str, world_size: int | None) -> Column:
    if how == "gather_mean":
        return F.avg("value")
    if how == "allreduce":
        if not world_size:
            raise ValueError("allreduce needs world_size")
        return F.sum(F.col("value") / F.lit(float(world_size)))
    raise ValueError(f"unknown combiner {how!r}")


def combine_gradients(parts: DataFrame, how: str = "gather_mean", world_size: int | None = None) -> DataFrame:
    """``(epoch, step, j, grad)`` from per-rank gradients.

    ``gather_mean``: unweighted mean over the ranks present in the step;
    ``allreduce``: every rank divides by ``world_size``, then the shares are summed.
    """
    return parts.where("j >= 0").groupBy("epoch", "step", "j").agg(_combiner(how, world_size).alias("grad"))


def combine_check(parts: DataFrame, world_size: int) -> DataFrame:
    """Largest absolute difference between the two combiners (one row)."""
    a = combine_gradients(parts, "gather_mean").withColumnRenamed("grad", "a")
    b = combine_gradients(parts, "allreduce", world_size).withColumnRenamed("grad", "b")
    return a.join(b, ["epoch", "step", "j"]).agg(F.max(F.abs(F.col("a") - F.col("b"))).alias("max_abs_diff"))


#: bytes of one collated record; a larger batch becomes several
RECORD_BYTES = 64 << 20
_BATCH = ("epoch", "rank", "step")


def _row_bytes() -> Column:
    return (F.lit(16) + 8 * F.coalesce(F.size("features"), F.lit(0))).cast("bigint")


def _collate_fn(limit: int):
    """Per task: rows come sorted by batch and key, and leave as one record a batch, or as
    pieces of at most ``limit`` bytes (one row at least). Only the record that is still open
    is kept between Arrow batches."""
    names = [*_BATCH, "chunk"]

    def records(rows: pa.RecordBatch, begins: list[int], pieces: list[int], end: int) -> pa.RecordBatch:
        heads = rows.take(pa.array(begins, pa.int64()))
        offsets = pa.array([*begins, end], pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, rows.column(c)) for c in ("_k", "label", "features")]
        return pa.RecordBatch.from_arrays([*[heads.column(c) for c in names], pa.array(pieces, pa.int32()), *lists],
                                          [*names, "piece", "ids", "labels", "features"])

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, piece = None, 0  # rows of the open record, and its number in its batch
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            ids = np.stack([batch.column(c).to_numpy() for c in names])
            total = np.concatenate(([0], np.cumsum(batch.column("_bytes").to_numpy())))
            borders = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
            begins, pieces = [], []
            for first, last in zip([0, *borders], [*borders, batch.num_rows]):
                at = int(first)
                piece = piece if first == 0 else 0
                while at < last:
                    begins.append(at)
                    pieces.append(piece)
                    at = min(int(last), max(at + 1, int(np.searchsorted(total, total[at] + limit, "right")) - 1))
                    piece += 1
            piece = pieces[-1]
            if len(begins) > 1:
                yield records(batch, begins[:-1], pieces[:-1], begins[-1])
            held = batch.slice(begins[-1])
        if held is not None:
            held = pa.Table.from_batches([held]).take(list(range(held.num_rows))).combine_chunks().to_batches()[0]
            yield records(held, [0], [piece], held.num_rows)

    return fn


def collate_batches(batched: DataFrame, key: str = "id", record_bytes: int = RECORD_BYTES) -> DataFrame:
    """Batches as records: ``epoch``, ``rank``, ``step``, ``chunk``, ``piece`` with row-aligned
    ``ids``, ``labels`` and ``features`` lists in key order.

    A batch of at most ``record_bytes`` is one record (chunk 0, piece 0). A larger one is
    several, in key order by (chunk, piece): its rows are numbered and dealt in chunks, so it
    is worked on by many tasks, and no task holds more than a record. Null labels, keys and
    features stay; an empty table gives no record.
    """
    rows = batched.select(*_BATCH, F.col(key).alias("_k"), "label", "features", _row_bytes().alias("_bytes"))
    sizes = rows.groupBy(*_BATCH).agg(F.sum("_bytes").alias("_total"), F.count(F.lit(1)).alias("_n"))
    large = sizes.where(F.col("_total") > record_bytes)
    found = large.count()  # at most the table's bytes / record_bytes
    if not found:
        dealt = rows.withColumn("chunk", F.lit(0))
    else:
        per_chunk = F.greatest(F.floor(F.lit(record_bytes) / (F.col("_total") / F.col("_n"))), F.lit(1)).alias("_per")
        large = large.select(*_BATCH, per_chunk)
        large = F.broadcast(large) if found <= 100_000 else large
        ordinary = rows.join(large, list(_BATCH), "left_anti").withColumn("chunk", F.lit(0))
        numbered = global_index(rows.join(large, list(_BATCH)), [*_BATCH, "_k"], pos="_pos")
        starts = numbered.groupBy(*_BATCH).agg(F.min("_pos").alias("_start"))
        starts = F.broadcast(starts) if found <= 100_000 else starts
        cut = numbered.join(starts, list(_BATCH)).withColumn(
            "chunk", F.floor((F.col("_pos") - F.col("_start")) / F.col("_per")).cast("int"))
        dealt = ordinary.unionByName(cut.select(*ordinary.columns))
    place = [*_BATCH, "chunk"]
    dealt = dealt.repartition(*place).sortWithinPartitions(*place, "_k")
    types = {f.name: f.dataType.simpleString() for f in dealt.schema.fields}
    schema = ", ".join([f"{c} {types[c]}" for c in place] + ["piece int"] + [
        f"{out} array<{types[c]}>" for out, c in (("ids", "_k"), ("labels", "label"), ("features", "features"))])
    return dealt.mapInArrow(_collate_fn(record_bytes), schema)


def uncollate_batches(batches: DataFrame, columns: Mapping[str, str], pos: str | None = None) -> DataFrame:
    """Column-of-lists batches to rows: the inverse of :func:`collate_batches`.

    ``columns`` names the list column of each row column (``{"ids": "id", ...}``); other
    columns are repeated, and ``pos`` (if given) is the row's place in its record. Records
    without rows give none; a record with lists of different lengths is an error, also where
    one list is null and another is not.
    """
    lists = list(columns)
    first = F.coalesce(F.size(lists[0]), F.lit(-1))
    even = F.lit(True)
    for c in lists[1:]:
        even = even & (F.coalesce(F.size(c), F.lit(-1)) == first)
    zipped = F.when(even, F.arrays_zip(*lists)).otherwise(F.raise_error(F.lit("batch with lists of different lengths")))
    keep = [c for c in batches.columns if c not in columns]
    # one row a record element, no exchange; the outer form works the lists out once
    rows = batches.select(*keep, F.posexplode_outer(zipped).alias("_pos", "_row")).where("_pos is not null")
    return rows.select(*keep, *([F.col("_pos").alias(pos)] if pos else []),
                       *[F.col("_row")[c].alias(out) for c, out in columns.items()])


# ------------------------------------------------------------------------ row blocks

def _block_fn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task: the rows of an Arrow batch that share a (step, rank) as one record."""
    for pdf in batches:
        records = []
        for (step, rank), g in pdf.groupby(["step", "rank"]):
            x, y = _rows_of(g)
            records.append((step, rank, len(y), x.tobytes(), y.tobytes()))
        if records:
            yield pd.DataFrame(records, columns=["step", "rank", "rows", "features", "label"])


def row_blocks(batched: DataFrame) -> RDD:
    """The rows as ``(step, rank, rows, features, label)`` records in the partitions they are in:
    features and labels are the bytes of row-major doubles and of longs."""
    return _training_columns(batched).mapInPandas(_block_fn, BLOCK_SCHEMA).rdd


def block_gradients(blocks: RDD, step: int, model: LinearModel, partitions: list[int] | None = None) -> list[tuple[int, int, np.ndarray]]:
    """``(rank, rows, sums)`` of one step for each rank in each partition of :func:`row_blocks`, in
    partition order: a job of one stage, without a plan, over all ``partitions`` or those that
    the step lies in. Meant for up to ``SUMS_PER_TASK`` sums."""
    w, b = np.asarray(model.weight, dtype=np.float64), np.asarray(model.bias, dtype=np.float64)

    def fn(records):
        acc: dict = {}
        for at, rank, rows, features, label in records:
            if at == step:
                x = np.frombuffer(features).reshape(rows, -1)
                n, held = acc.get(rank, (0, 0.0))
                acc[rank] = (n + rows, held + _sums(w, b, x, np.frombuffer(label, dtype=np.int64)))
        return [(rank, n, vec) for rank, (n, vec) in acc.items()]

    return blocks.ctx.runJob(blocks, fn, partitions)


def combine_sums(parts: list[tuple[int, int, np.ndarray]], how: str, world_size: int | None) -> tuple[np.ndarray, float, float]:
    """Gradient, mean loss and correct share of a step from :func:`block_gradients`, as
    :func:`partial_gradients` and :func:`combine_gradients` work them out."""
    ranks: dict = {}
    for rank, n, vec in parts:
        rows, held = ranks.get(rank, (0, 0.0))
        ranks[rank] = (rows + n, held + vec)
    rows = np.array([n for n, _ in ranks.values()])
    means = np.stack([vec / n for n, vec in ranks.values()])
    if how == "gather_mean":
        g = means.mean(axis=0)
    elif how == "allreduce":
        if not world_size:
            raise ValueError("allreduce needs world_size")
        g = (means / float(world_size)).sum(axis=0)
    else:
        raise ValueError(f"unknown combiner {how!r}")
    return g[-_FIRST:], float(means[:, 0].mean()), float((means[:, 1] * rows).sum() / rows.sum())


# ------------------------------------------------------------------------- optimizers

@dataclass
class SGD:
    lr: float = 0.1
    momentum: float = 0.9
    weight_decay: float = 1e-4

    def init(self, theta: np.ndarray) -> dict:
        return {"momentum": None}

    def update(self, theta: np.ndarray, g: np.ndarray, state: dict, step: int) -> np.ndarray:
        g = g + self.weight_decay * theta
        buf = state.get("momentum")
        buf = g.copy() if buf is None else self.momentum * buf + g
        state["momentum"] = buf
        return theta - self.lr * buf


@dataclass
class AdamW:
    lr: float = 5e-5
    betas: tuple = (0.9, 0.999)
    eps: float = 1e-8
    weight_decay: float = 0.01
    warmup: int = 100
    total_steps: int | None = None
    max_norm: float | None = 1.0

    def lr_at(self, step: int) -> float:
        if self.total_steps is None:
            return self.lr
        if step < self.warmup:
            return self.lr * step / max(1, self.warmup)
        return self.lr * max(0.0, (self.total_steps - step) / max(1, self.total_steps - self.warmup))

    def init(self, theta: np.ndarray) -> dict:
        return {"exp_avg": np.zeros_like(theta), "exp_avg_sq": np.zeros_like(theta)}

    def update(self, theta: np.ndarray, g: np.ndarray, state: dict, step: int) -> np.ndarray:
        if self.max_norm is not None:
            norm = float(np.sqrt((g * g).sum()))
            g = g * min(1.0, self.max_norm / (norm + 1e-6))
        lr = self.lr_at(step)
        b1, b2 = self.betas
        t = step + 1
        theta = theta * (1.0 - lr * self.weight_decay)
        state["exp_avg"] = b1 * state["exp_avg"] + (1 - b1) * g
        state["exp_avg_sq"] = b2 * state["exp_avg_sq"] + (1 - b2) * g * g
        m_hat = state["exp_avg"] / (1 - b1 ** t)
        v_hat = state["exp_avg_sq"] / (1 - b2 ** t)
        return theta - lr * m_hat / (np.sqrt(v_hat) + self.eps)


@dataclass
class TrainState:
    model: LinearModel
    optimizer_state: dict
    step: int = 0
    epoch: int = 0
    loss: float | None = None  # mean training loss of the last epoch
    telemetry: list = field(default_factory=list)  # (epoch, batch_idx, loss, accuracy, duration)

    @property
    def theta(self) -> np.ndarray:
        return np.concatenate([self.model.weight.ravel(), self.model.bias])


def zero_model(classes: int, features: int) -> LinearModel:
    if classes * features + classes > MAX_PARAMETERS:
        raise ValueError("model too large for driver-side updates")
    return LinearModel(np.zeros((classes, features)), np.zeros(classes))


def _set_theta(model: LinearModel, theta: np.ndarray) -> LinearModel:
    c, d = model.weight.shape
    return LinearModel(theta[: c * d].reshape(c, d).copy(), theta[c * d:].copy())


def spread_batches(batched: DataFrame, key: str, world_size: int, partitions: int, window: int | None = None, windows: int = 1) -> DataFrame:
    """Rows dealt by (rank, chunk of key and position): every step lies in at least ``world_size``
    partitions (rows permitting), a full-batch step in all of them. Sorted by step, so a
    cached scan for one step skips the others. With a ``window`` of so many steps, each of the
    ``windows`` has ``partitions`` of its own, one window's after the other's."""
    # several chunks a partition, so runs of them come out even
    chunks = max(1, -(-4 * partitions // world_size))
    slot = F.col("rank") * F.lit(chunks) + F.pmod(F.xxhash64(F.col(key), F.col("pos")), F.lit(chunks))
    place = F.floor(slot * F.lit(partitions) / F.lit(world_size * chunks)).cast("int")
    if window:
        place = place + F.floor(F.col("step") / F.lit(window)).cast("int") * F.lit(partitions)
    return batched.repartitionById(partitions * windows, place).sortWithinPartitions("step")


def epoch_partitions(rows: int, features: int, world_size: int, most: int) -> int:
    """Partitions of an epoch's (or a window's) cached rows, each a task of every step: one a rank
    at least, then one per ``PARTITION_CELLS`` feature cells, up to ``most``. A step of a few
    hundred rows is not dealt over as many tasks as the session has shuffle partitions."""
    return max(world_size, min(most, -(-rows * max(1, features) // PARTITION_CELLS)))


def _summed_step(batch: DataFrame, model: LinearModel, how: str, world_size: int,
                 summing: int) -> tuple[np.ndarray, float, float]:
    """Gradient, mean loss and correct share of a step whose sums are added by ``summing`` tasks."""
    cells = partial_gradients(batch, model, summing).groupBy("j").agg(
        _combiner(how, world_size).alias("g"), F.avg("value").alias("mean"),
        (F.sum(F.col("value") * F.col("rows")) / F.sum("rows")).alias("share")).toPandas().sort_values("j")
    return cells["g"].to_numpy()[-_FIRST:], float(cells["mean"].iloc[0]), float(cells["share"].iloc[1])


def train(df: DataFrame, state: TrainState, optimizer, epochs: int = 1, batch_size: int = 64,
          world_size: int = 4, max_batches: int | None = 41, seed: int = 42, key: str = "id",
          how: str = "gather_mean", on_epoch_end=None) -> TrainState:
    """Mini-batch training, one distributed job per step.

    Each epoch re-shuffles with a seeded permutation, shards it over ``world_size`` ranks,
    keeps the first ``max_batches`` steps (the documented bound on the rows a run fits on;
    None: all), and caches the rows spread by :func:`spread_batches`. A step's job returns the
    combined gradient, loss and correct share, or, if these are few, the sums they are worked
    out from. The steps then take their rows from blocks, which are made for a window of steps
    at a time: about ``PARTITION_CELLS`` cells a partition, as a task reads them all. A window
    has partitions of its own, which alone its steps' jobs read, so a step costs the same
    however many steps an epoch has. Steps so large that no two fit a window read the cached
    rows themselves, in :func:`epoch_partitions` of the whole epoch.
    ``on_epoch_end(state)`` is called after every epoch (e.g. to save a checkpoint).
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    rows = df.count()
    step_rows = batch_size * world_size
    if max_batches is not None:
        rows = min(rows, max_batches * step_rows)
    features = state.model.weight.shape[1]
    most = max(sc.defaultParallelism, shuffle_partitions(spark))
    partitions = epoch_partitions(min(rows, WINDOW_STEPS * step_rows), features, world_size, most)
    window = partitions * PARTITION_CELLS // (step_rows * max(1, features))  # steps
    in_blocks = partitions * state.theta.size <= SUMS_PER_TASK and window > 1
    windows = max(1, -(-rows // (window * step_rows))) if in_blocks else 1
    if not in_blocks:
        partitions = epoch_partitions(rows, features, world_size, most)
    summing = max(1, min(shuffle_partitions(spark), -(-partitions * state.theta.size // SUMS_PER_TASK)))
    spread = (partitions,) if windows == 1 else (partitions, window, windows)
    for _ in range(epochs):
        epoch = state.epoch + 1
        batched = assign_batches(df, key, batch_size, shuffle=True, seed=seed, epoch=epoch,
                                 world_size=world_size)
        if max_batches is not None:
            batched = batched.where(F.col("step") < max_batches)
        batched = spread_batches(batched, key, world_size, *spread).persist(StorageLevel.MEMORY_AND_DISK)
        last, there = batched.agg(F.max("step"), F.count(F.lit(1))).first()
        losses, blocks, blocked = [], None, 0
        for s in range(0 if last is None else last + 1):
            if in_blocks and s % window == 0:
                if blocks is not None:
                    blocks.unpersist()
                own = [s // window * partitions + i for i in range(partitions)]
                blocks = row_blocks(batched.where(F.col("step").between(s, s + window - 1)))
                blocks.persist(StorageLevel.MEMORY_AND_DISK)
                blocked += sum(sc.runJob(blocks, lambda records: [sum(r.rows for r in records)], own))
                if blocked != there and s + window > last:
                    raise RuntimeError(f"{blocked} of an epoch's {there} rows are in its blocks: its input changed between two readings")
            began = time.perf_counter()
            if in_blocks:
                grad, loss, share = combine_sums(block_gradients(blocks, s, state.model, own), how, world_size)
            else:
                grad, loss, share = _summed_step(batched.where(F.col("step") == s), state.model, how, world_size, summing)
            theta = optimizer.update(state.theta, grad, state.optimizer_state, state.step)
            state.model = _set_theta(state.model, theta)
            losses.append(loss)
            state.telemetry.append((epoch, s, loss, share, time.perf_counter() - began))
            state.step += 1
        if blocks is not None:
            blocks.unpersist()
        batched.unpersist()
        state.epoch = epoch
        state.loss = float(np.mean(losses)) if losses else None
        if on_epoch_end is not None:
            on_epoch_end(state)
    return state


def telemetry_frame(spark, state: TrainState) -> DataFrame:
    """The run's batches as telemetry rows, the input of the summaries and logs."""
    return spark.createDataFrame(state.telemetry, "epoch int, batch_idx int, loss double, accuracy double, duration double")


# ------------------------------------------------------------------------ checkpoints

CHECKPOINT_SCHEMA = ("name string, slot string, shape array<int>, values array<double>, "
                     "trainable boolean, step long, epoch int, loss double")


def state_frame(spark, state: TrainState) -> DataFrame:
    """Parameters and optimizer slots of a training state as a table."""
    c, d = state.model.weight.shape
    rows = [("weight", "value", [c, d], state.model.weight.ravel().tolist(), True, state.step, state.epoch, state.loss),
            ("bias", "value", [c], state.model.bias.tolist(), True, state.step, state.epoch, state.loss)]
    for slot, arr in state.optimizer_state.items():
        if arr is None:
            continue
        flat = np.asarray(arr, dtype=np.float64)
        rows.append(("weight", slot, [c, d], flat[: c * d].tolist(), False, state.step, state.epoch, state.loss))
        rows.append(("bias", slot, [c], flat[c * d:].tolist(), False, state.step, state.epoch, state.loss))
    return spark.createDataFrame(rows, CHECKPOINT_SCHEMA)


def state_from_frame(frame: DataFrame, optimizer) -> TrainState:
    """Rebuild a training state from a loaded checkpoint (model-sized rows)."""
    values = F.aggregate("shape", F.lit(1).cast("bigint"), lambda a, s: a * s)
    if (frame.agg(F.sum(values)).first()[0] or 0) > 4 * MAX_PARAMETERS:
        raise ValueError("checkpoint too large for driver-side updates")
    rows = frame.select("name", "slot", "shape", "values", "step", "epoch", "loss").collect()
    by = {(r["name"], r["slot"]): r for r in rows}
    w = by[("weight", "value")]
    model = LinearModel(np.asarray(w["values"]).reshape(w["shape"]), np.asarray(by[("bias", "value")]["values"]))
    theta = np.concatenate([model.weight.ravel(), model.bias])
    opt_state = optimizer.init(theta)
    for slot in list(opt_state):
        if ("weight", slot) in by:
            opt_state[slot] = np.concatenate([np.asarray(by[("weight", slot)]["values"]),
                                              np.asarray(by[("bias", slot)]["values"])])
    return TrainState(model, opt_state, step=int(w["step"]), epoch=int(w["epoch"]), loss=w["loss"])
