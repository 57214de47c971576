"""Training telemetry: sampling, caps, epoch and run summaries, schedule, log lines.

Telemetry rows are ``(epoch, batch_idx, loss, accuracy, duration)``; every summary is
a grouped aggregation (partial + final), so no epoch is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.decimals import printed

# Fixed text of the studied job's log lines (values in natural order of the line).
EPOCH_LINE = ("Epoch: %d, Train Loss: %.3f, Train Accuracy: %.3f, "
              "Avg Batch Duration: %.3f seconds, Epoch Duration: %.3f seconds")
BATCH_LINE = ("Batch Idx: %d, Batch Loss: %.3f, Batch Accuracy: %.3f, "
              "Batch Duration: %.3f seconds")
TEXT_BATCH_LINE = ("Epoch: %d, Train Batch Idx: %d, Train Batch Loss: %.3f, Train Batch Accuracy: %.3f, "
                   "Train Batch Duration: %.3f seconds")
TEXT_EPOCH_LINE = ("Epoch: %d, Train Loss: %.3f, Train Accuracy: %.3f, "
                   "Train Duration: %.3f seconds, Avg Train Batch Duration: %.3f seconds")
TEXT_RUN_LINE = ("Avg Train Loss: %.3f, Avg Train Accuracy: %.3f, "
                 "Avg Train Duration: %.3f seconds, Avg Train Batch Duration: %.3f seconds")
TEXT_SEPARATOR = "-" * 46
LOG_HEADER = "Logs for the checkpoint stored at: %s/"


def sample_batches(tele: DataFrame, every: int = 20) -> DataFrame:
    """Rows whose ``batch_idx`` is a multiple of ``every`` (the logged batches)."""
    return tele.where(F.pmod(F.col("batch_idx"), F.lit(every)) == 0)


def cap_batches(tele: DataFrame, max_batches: int = 41) -> DataFrame:
    """The first ``max_batches`` batches of every epoch (``batch_idx < max_batches``)."""
    return tele.where(F.col("batch_idx") < max_batches)


def epoch_summary(tele: DataFrame, skip_first: bool = True, by: Sequence[str] = ("epoch",)) -> DataFrame:
    """Per epoch (or per ``by`` columns): mean loss, mean accuracy, mean batch duration (without batch 0 when
    ``skip_first``; null if nothing is left) and epoch duration (sum of durations)."""
    dur = F.when(F.col("batch_idx") > 0, F.col("duration")) if skip_first else F.col("duration")
    return tele.groupBy(*by).agg(
        F.avg("loss").alias("train_loss"),
        F.avg("accuracy").alias("train_accuracy"),
        F.avg(dur).alias("avg_batch_duration"),
        F.sum("duration").alias("epoch_duration"),
        F.count(F.lit(1)).alias("batches"),
    )


def run_summary(epochs: DataFrame) -> DataFrame:
    """Unweighted mean over epochs of the epoch figures (one row)."""
    return epochs.agg(
        F.avg("train_loss").alias("avg_train_loss"),
        F.avg("train_accuracy").alias("avg_train_accuracy"),
        F.avg("epoch_duration").alias("avg_epoch_duration"),
        F.avg("avg_batch_duration").alias("avg_batch_duration"),
        F.count(F.lit(1)).alias("epochs"),
    )


def eval_timing(tele: DataFrame) -> DataFrame:
    """Mean batch duration and total duration of a scoring run (one row)."""
    return tele.agg(F.avg("duration").alias("avg_batch_duration"),
                    F.sum("duration").alias("duration"),
                    F.count(F.lit(1)).alias("batches"))


def lr_at(step: Column, total: int, warmup: int = 100, base: float = 5e-5) -> Column:
    """Linear warm-up then linear decay to 0 at ``total`` steps."""
    k = step.cast("double")
    warm = k / F.lit(float(max(1, warmup)))
    decay = F.greatest(F.lit(0.0), (F.lit(float(total)) - k) / F.lit(float(max(1, total - warmup))))
    return F.lit(base) * F.when(step < warmup, warm).otherwise(decay)


def lr_schedule(spark: SparkSession, total: int, warmup: int = 100, base: float = 5e-5) -> DataFrame:
    """``(step, lr)`` for steps ``0 .. total-1``."""
    return spark.range(total).select(F.col("id").alias("step"), lr_at(F.col("id"), total, warmup, base).alias("lr"))


def format_epoch_log(epochs: DataFrame, rank: Column | None = None) -> DataFrame:
    """Fixed-format epoch lines."""
    line = printed(EPOCH_LINE, "epoch", "train_loss", "train_accuracy", "avg_batch_duration", "epoch_duration")
    if rank is not None:
        line = F.concat(F.lit("Rank: "), rank.cast("string"), F.lit(", "), line)
    return epochs.select(*[c for c in ("rank", "epoch") if c in epochs.columns], line.alias("value"))


def format_batch_log(tele: DataFrame) -> DataFrame:
    line = printed(BATCH_LINE, "batch_idx", "loss", "accuracy", "duration")
    return tele.select(*[c for c in ("rank", "epoch") if c in tele.columns], "batch_idx", line.alias("value"))


def format_text_batch_log(tele: DataFrame) -> DataFrame:
    """Batch lines of text training."""
    line = printed(TEXT_BATCH_LINE, "epoch", "batch_idx", "loss", "accuracy", "duration")
    return tele.select("epoch", "batch_idx", line.alias("value"))


def format_text_epoch_log(epochs: DataFrame) -> DataFrame:
    """Epoch lines of text training (another order of the fields)."""
    line = printed(TEXT_EPOCH_LINE, "epoch", "train_loss", "train_accuracy", "epoch_duration", "avg_batch_duration")
    return epochs.select("epoch", line.alias("value"))


def format_text_run_log(run: DataFrame) -> DataFrame:
    """The closing line of text training."""
    return run.select(printed(TEXT_RUN_LINE, "avg_train_loss", "avg_train_accuracy", "avg_epoch_duration",
                                                             "avg_batch_duration").alias("value"))


def train_log(tele: DataFrame, every: int = 20, max_batches: int | None = None, checkpoint: str | None = None) -> DataFrame:
    """Log lines of a run in order: with ``checkpoint`` its header, then per epoch its sampled
    batch lines and the epoch line. ``line_no`` orders them (epoch-major). ``max_batches``
    caps an epoch only if set. With a ``rank`` column every rank has a log of its own,
    whose epoch lines name it."""
    t = cap_batches(tele, max_batches) if max_batches else tele
    ranks = ["rank"] if "rank" in tele.columns else []
    batches = format_batch_log(sample_batches(t, every)).select(
        *ranks, "epoch", (F.col("batch_idx").cast("bigint")).alias("k"), "value")
    summary = epoch_summary(t, skip_first=True, by=(*ranks, "epoch"))
    epochs = format_epoch_log(summary, F.col("rank") if ranks else None).select(
        *ranks, "epoch", F.lit(1 << 40).cast("bigint").alias("k"), "value")
    both = batches.unionByName(epochs)
    number = (F.col("epoch").cast("bigint") * F.lit(1 << 41)) + F.col("k")
    lines = both.select(number.alias("line_no"), *ranks, "epoch", "value")
    if checkpoint is None:
        return lines
    who = t.select(*ranks).distinct() if ranks else t.sparkSession.range(1).select()
    header = who.select(F.lit(-1).cast("bigint").alias("line_no"), *ranks, F.lit(None).cast("int").alias("epoch"),
                        F.lit(LOG_HEADER % checkpoint).alias("value"))
    return lines.unionByName(header)


def text_train_log(tele: DataFrame, every: int = 100) -> DataFrame:
    """Log lines of a text training run in order: per epoch its sampled batch lines, the epoch line
    and a separator, then the run line and a separator. ``line_no`` orders them."""
    epochs = epoch_summary(tele, skip_first=False)
    at = lambda k: ((F.col("epoch").cast("bigint") * F.lit(1 << 41)) + k).alias("line_no")
    batches = format_text_batch_log(sample_batches(tele, every)).select(at(F.col("batch_idx").cast("bigint")), "value")
    closing = format_text_epoch_log(epochs).select(at(F.lit(1 << 40)), "value")
    # no run line without an epoch
    run = format_text_run_log(run_summary(epochs).where("epochs > 0")).select(F.lit((1 << 62)).cast("bigint").alias("line_no"), "value")
    mark = lambda lines: lines.select((F.col("line_no") + 1).alias("line_no"), F.lit(TEXT_SEPARATOR).alias("value"))
    return batches.unionByName(closing).unionByName(mark(closing)).unionByName(run).unionByName(mark(run))
