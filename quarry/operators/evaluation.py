"""Evaluation: accuracy, confusion matrix, per-label report, batch-mean loss.

Everything is computed from the ``(truth, pred) -> n`` cell counts, an aggregation
with a map-side partial count, so only classes x classes cells are shuffled however
many rows were scored. A report needs one pass over the scored rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.indexing import global_index
from quarry.session import checkpoint_root

#: labels up to which they are numbered in one task and the confusion matrix lists its zero cells as well
MAX_LABELS = 2_000


def accuracy(scored: DataFrame, truth: str = "label", pred: str = "pred") -> DataFrame:
    """Share of rows with ``truth = pred`` (one row); null is a label like any other."""
    return scored.agg(F.avg(F.col(truth).eqNullSafe(F.col(pred)).cast("double")).alias("accuracy"))


def cells(scored: DataFrame, truth: str = "label", pred: str = "pred") -> DataFrame:
    return scored.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n"))


def label_index(counts: DataFrame, max_labels: int = MAX_LABELS) -> tuple[DataFrame, bool]:
    """``(label, o)``: every label seen as truth or prediction with its place in their order, null
    first, and whether there are more than ``max_labels``. Many labels are numbered range by
    range; they never meet in one task or in the driver."""
    labels = counts.select(F.col("truth").alias("label")).union(counts.select("pred")).distinct()
    many = labels.limit(max_labels + 1).count() > max_labels
    if many:
        return global_index(labels, ["label"], pos="o"), True
    return labels.select("label", (F.row_number().over(Window.orderBy(F.col("label").asc_nulls_first())) - 1).cast("bigint").alias("o")), False


def _matrix(counts: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """``(truth, pred, n, ot, op)`` from cell counts, with the labels' places; with zero cells up to
    ``max_labels`` labels, sparse beyond."""
    index, many = label_index(counts, max_labels)
    of = lambda side: index.select(F.col("label").alias(f"_{side}"), F.col("o").alias(f"o{side[0]}"))
    if many:
        return (counts.join(of("truth"), F.col("truth").eqNullSafe(F.col("_truth"))).join(of("pred"), F.col("pred").eqNullSafe(F.col("_pred")))
                .select("truth", "pred", F.col("n").cast("bigint").alias("n"), "ot", "op"))
    # one row with all labels (at most max_labels) becomes the grid
    row = index.agg(F.collect_list(F.struct("o", "label")).alias("_all"))
    grid = row.selectExpr("_all", "inline(_all) AS (ot, _truth)").selectExpr("ot", "_truth", "inline(_all) AS (op, _pred)")
    found = F.col("truth").eqNullSafe(F.col("_truth")) & F.col("pred").eqNullSafe(F.col("_pred"))
    return (grid.join(counts, found, "left")
            .select(F.col("_truth").alias("truth"), F.col("_pred").alias("pred"), F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"), "ot", "op"))


def confusion_matrix(scored: DataFrame, truth: str = "label", pred: str = "pred", max_labels: int = MAX_LABELS) -> DataFrame:
    """``(truth, pred, n)`` over every pair of the label union, zero cells included; beyond
    ``max_labels`` labels only the cells that occur."""
    checkpoint_root(scored.sparkSession)
    # the cell table has labels^2 rows at most; checkpointing it lets the label set and the
    # matrix share one pass over the scored rows
    return _matrix(cells(scored, truth, pred).checkpoint(eager=True), max_labels).select("truth", "pred", "n")


def _row(order, label, p, r, f, support):
    return F.struct(F.lit(order).cast("bigint").alias("order"), F.lit(label).alias("label"),
                    p.cast("double").alias("precision"), r.cast("double").alias("recall"),
                    f.cast("double").alias("f1_score"), support.cast("bigint").alias("support"))


def _safe(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0).cast("double"))


def _report(counts: DataFrame, names: Sequence[str] | None) -> DataFrame:
    same = F.col("truth").eqNullSafe(F.col("pred"))
    none = F.lit(0).cast("bigint")
    true = counts.groupBy(F.col("truth").alias("label")).agg(F.sum(F.when(same, F.col("n")).otherwise(0)).alias("tp"), F.sum("n").alias("support"), F.first(none).alias("predicted"))
    guessed = counts.groupBy(F.col("pred").alias("label")).agg(F.first(none).alias("tp"), F.first(none).alias("support"), F.sum("n").alias("predicted"))
    per = true.unionByName(guessed).groupBy("label").agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
    per = per.select(
        "label", _safe(F.col("tp"), F.col("predicted")).alias("precision"), _safe(F.col("tp"), F.col("support")).alias("recall"),
        _safe(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1_score"),
        F.col("support").cast("bigint").alias("support"), "tp")
    index, _ = label_index(counts)
    order = F.col("o")
    text = F.coalesce(F.col("label").cast("string"), F.lit("null"))
    if names is not None:
        text = F.coalesce(F.get(F.array(*[F.lit(n) for n in names]), order.cast("int")), text)
    placed = per.join(index.withColumnRenamed("label", "_l"), F.col("label").eqNullSafe(F.col("_l")))
    rows = placed.select(order.alias("order"), text.alias("label"), "precision", "recall", "f1_score", "support")
    tot = per.agg(
        F.sum("support").alias("total"), F.sum("tp").alias("tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1_score") * F.col("support")).alias("wf"),
    )
    total = F.col("total")
    summary = tot.select(F.explode(F.array(
        _row(1 << 40, "accuracy", F.lit(None), F.lit(None), _safe(F.col("tp"), total), total),
        _row((1 << 40) + 1, "macro avg", F.col("mp"), F.col("mr"), F.col("mf"), total),
        _row((1 << 40) + 2, "weighted avg", _safe(F.col("wp"), total), _safe(F.col("wr"), total),
             _safe(F.col("wf"), total), total),
    )).alias("r")).select("r.*")
    return rows.unionByName(summary)


def classification_report(scored: DataFrame, truth: str = "label", pred: str = "pred",
                          names: Sequence[str] | None = None) -> DataFrame:
    """Per label precision, recall, f1 and support, then ``accuracy``, ``macro avg`` and
    ``weighted avg`` rows. A zero denominator gives 0. Labels of any orderable type; ``names``
    replace the labels in their sorted order. Columns: ``order`` (of the lines), ``label,
    precision, recall, f1_score, support`` (the accuracy row carries its value in
    ``f1_score`` and leaves precision/recall null)."""
    return _report(cells(scored, truth, pred), names)


def mean_of_batch_loss(scored: DataFrame, batch_col: str = "batch", loss: str = "loss") -> DataFrame:
    """Unweighted mean over batches of each batch's mean row loss (a short last batch
    weighs as much as a full one)."""
    per_batch = scored.groupBy(batch_col).agg(F.avg(loss).alias("batch_loss"))
    return per_batch.agg(F.avg("batch_loss").alias("loss"))


def eval_report(scored: DataFrame, batch_col: str = "batch", truth: str = "label", pred: str = "pred",
                names: Sequence[str] | None = None, version: str | None = None) -> DataFrame:
    """One tidy table ``(section, label, other, metric, value, position)``: loss and accuracy,
    the report rows, and the confusion cells (``label`` truth, ``other`` prediction).
    ``position`` orders the rows of a section.

    The scored rows are read once, into ``(batch, truth, pred) -> n, loss`` sums.
    """
    checkpoint_root(scored.sparkSession)
    sums = scored.groupBy(F.col(batch_col).alias("batch"), F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("loss").alias("loss")).checkpoint(eager=True)
    counts = sums.groupBy("truth", "pred").agg(F.sum("n").alias("n"))
    nothing = F.lit(None).cast("string")

    def part(df, section, label, other, metric, value, position):
        return df.select(F.lit(section).alias("section"), label.alias("label"), other.alias("other"), metric.alias("metric"),
                         value.cast("double").alias("value"), position.cast("bigint").alias("position"))

    loss = sums.groupBy("batch").agg((F.sum("loss") / F.sum("n")).alias("l")).agg(F.avg("l").alias("v"))
    right = counts.agg(_safe(F.sum(F.when(F.col("truth").eqNullSafe(F.col("pred")), F.col("n")).otherwise(0)), F.sum("n")).alias("v"))
    rep = _report(counts, names)
    metrics = ("precision", "recall", "f1_score", "support")
    long = rep.select("order", "label", F.posexplode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("i", "m")).where("m.value is not null")
    placed = _matrix(counts)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    out = (part(loss, "summary", F.lit(""), nothing, F.lit("loss"), F.col("v"), F.lit(0))
           .unionByName(part(right, "summary", F.lit(""), nothing, F.lit("accuracy"), F.col("v"), F.lit(1)))
           .unionByName(part(long, "report", F.col("label"), nothing, F.col("m.metric"), F.col("m.value"), F.col("order") * 4 + F.col("i")))
           .unionByName(part(placed, "matrix", name("truth"), name("pred"), F.lit("n"), F.col("n"),
                             F.col("ot") * F.lit(1 << 31) + F.col("op"))))
    return out.withColumn("version", F.lit(version)) if version is not None else out
