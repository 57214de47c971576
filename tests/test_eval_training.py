"""Scoring, reports and training against hand-written and NumPy references."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import evaluation as ev
from quarry.operators import telemetry as tm
from quarry.operators import training as tr
from quarry.operators.scoring import LinearModel, score_linear


def _scored(spark, pairs):
    return spark.createDataFrame([(i, t, p, 0.5, i // 2) for i, (t, p) in enumerate(pairs)],
                                 "id long, label int, pred int, loss double, batch int")


def test_report_with_a_class_never_predicted(spark):
    # truth/pred over labels {0,1,2}; label 2 never predicted, label 1 never true
    pairs = [(0, 0), (0, 1), (2, 0), (2, 0), (0, 0)]
    rep = {r["label"]: r for r in ev.classification_report(_scored(spark, pairs)).collect()}
    assert set(rep) == {"0", "1", "2", "accuracy", "macro avg", "weighted avg"}
    assert math.isclose(rep["0"]["precision"], 2 / 4) and math.isclose(rep["0"]["recall"], 2 / 3)
    assert rep["1"]["precision"] == 0.0 and rep["1"]["support"] == 0
    assert rep["2"]["precision"] == 0.0 and rep["2"]["recall"] == 0.0
    assert math.isclose(rep["accuracy"]["f1_score"], 2 / 5) and rep["accuracy"]["precision"] is None
    m = {(r["truth"], r["pred"]): r["n"] for r in ev.confusion_matrix(_scored(spark, pairs)).collect()}
    assert len(m) == 9 and sum(m.values()) == 5 and m[(1, 1)] == 0


def test_mean_of_batch_loss_is_unweighted(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 10.0)], "batch int, loss double")
    assert ev.mean_of_batch_loss(df).first()[0] == pytest.approx((2.0 + 10.0) / 2)


def test_argmax_first_on_ties_and_loss(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [0.0, 0.0], 1)], "id long, features array<double>, label int")
    model = LinearModel(np.eye(2), np.zeros(2))
    out = {r["id"]: r for r in score_linear(df, model).collect()}
    assert out[1]["pred"] == 0 and out[2]["pred"] == 0
    assert out[2]["loss"] == pytest.approx(math.log(2))


def test_epoch_summary_skip_first_and_single_batch(spark):
    t = spark.createDataFrame([(1, 0, 1.0, 0.5, 9.0), (1, 1, 2.0, 0.5, 1.0), (1, 2, 3.0, 1.0, 3.0), (2, 0, 5.0, 0.0, 4.0)],
                              "epoch int, batch_idx int, loss double, accuracy double, duration double")
    s = {r["epoch"]: r for r in tm.epoch_summary(t, skip_first=True).collect()}
    assert s[1]["avg_batch_duration"] == pytest.approx(2.0)
    assert s[1]["epoch_duration"] == pytest.approx(13.0)
    assert s[2]["avg_batch_duration"] is None  # only the first batch: nothing left
    assert tm.lr_schedule(spark, 300, 100, 1.0).where("step in (0, 50, 100, 200, 299)").orderBy("step") \
        .select("lr").rdd.map(lambda r: r[0]).collect() == pytest.approx([0.0, 0.5, 1.0, 0.5, 0.005])


def _sgd(theta, g, state, n):
    """Momentum SGD written out: the first buffer is the gradient itself."""
    g = g + 1e-4 * theta
    state["v"] = g if n == 0 else 0.9 * state["v"] + g
    return theta - 0.1 * state["v"]


def _adamw(theta, g, state, n, lr=1e-2, warmup=2, total=12):
    """AdamW written out with clipping to norm 1, linear warm-up and decay."""
    norm = math.sqrt(sum(v * v for v in g))
    g = g if norm + 1e-6 <= 1 else g / (norm + 1e-6)
    rate = lr * n / warmup if n < warmup else lr * max(0.0, (total - n) / (total - warmup))
    m = 0.9 * state.get("m", 0.0) + (1 - 0.9) * g
    v = 0.999 * state.get("v", 0.0) + (1 - 0.999) * g ** 2
    state.update(m=m, v=v)
    theta = theta - rate * 0.01 * theta
    return theta - rate * (m / (1 - 0.9 ** (n + 1))) / (np.sqrt(v / (1 - 0.999 ** (n + 1))) + 1e-8)


def _numpy_train(x, y, ids, classes, update, epochs, batch, world, max_batches, seed_order):
    """Independent reference: same batches, plain NumPy math and its own update rules."""
    theta = np.zeros(classes * x.shape[1] + classes)
    state, step = {}, 0
    for epoch in range(1, epochs + 1):
        order = seed_order(epoch)
        pos = {i: p for p, i in enumerate(order)}
        shards = {}
        for i in ids:
            p = pos[i]
            shards.setdefault((p // world) // batch, {}).setdefault(p % world, []).append(i)
        for s in sorted(shards):
            if max_batches is not None and s >= max_batches:
                continue
            grads = []
            for r, members in sorted(shards[s].items()):
                idx = [ids.index(m) for m in members]
                xb, yb = x[idx], y[idx]
                w = theta[: classes * x.shape[1]].reshape(classes, -1)
                b = theta[classes * x.shape[1]:]
                z = xb @ w.T + b
                z -= z.max(axis=1, keepdims=True)
                p_ = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
                p_[np.arange(len(yb)), yb] -= 1
                grads.append(np.concatenate([(p_.T @ xb / len(yb)).ravel(), p_.mean(axis=0)]))
            theta = update(theta, np.mean(grads, axis=0), state, step)
            step += 1
    return theta


@pytest.mark.parametrize("opt,update", [(tr.SGD(), _sgd), (tr.AdamW(lr=1e-2, warmup=2, total_steps=12), _adamw)])
def test_training_matches_numpy_reference(spark, opt, update):
    import hashlib
    rng = np.random.default_rng(0)
    n, d, c = 150, 5, 3
    x = rng.normal(size=(n, d))
    y = rng.integers(0, c, size=n)
    ids = list(range(n))
    df = spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in ids], "id long, features array<double>, label int")
    state = tr.TrainState(tr.zero_model(c, d), opt.init(np.zeros(c * d + c)))
    got = tr.train(df, state, opt, epochs=2, batch_size=8, world_size=4, max_batches=3, seed=7, key="id")

    def order(epoch):
        h = lambda i: int(hashlib.md5(f"7|{epoch}|{i}".encode()).hexdigest()[:8], 16)
        return sorted(ids, key=lambda i: (h(i), i))

    want = _numpy_train(x, y, ids, c, update, 2, 8, 4, 3, order)
    assert np.allclose(got.theta, want, rtol=1e-9, atol=1e-12)
    assert len(got.telemetry) == 6 and all(t[4] > 0 for t in got.telemetry)
    tele = tr.telemetry_frame(spark, got)
    assert tm.epoch_summary(tele).count() == 2 and got.loss == pytest.approx(np.mean([t[2] for t in got.telemetry[3:]]))


@pytest.mark.parametrize("batch,world", [(16, 4), (1 << 40, 1)])
def test_a_step_is_worked_on_by_many_tasks(spark, batch, world):
    from quarry.operators.indexing import assign_batches
    rows = assign_batches(spark.range(2000), "id", batch, shuffle=True, seed=1, epoch=1, world_size=world)
    spread = tr.spread_batches(rows, "id", world, 8).select("step", F.spark_partition_id().alias("p")).distinct()
    per_step = {r.step: r.n for r in spread.groupBy("step").agg(F.count("*").alias("n")).collect()}
    assert min(per_step.values()) >= (world if batch < 1000 else 8)


def test_rows_of_one_key_are_spread(spark):
    from quarry.operators.indexing import assign_batches
    rows = spark.range(2000).select(F.lit(7).alias("id"), F.col("id").alias("x"))
    batched = assign_batches(rows, "id", 1 << 40, shuffle=True, seed=1, epoch=1, world_size=1)
    sizes = [r["count"] for r in tr.spread_batches(batched, "id", 1, 8).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and sum(sizes) == 2000 and max(sizes) <= 2 * 2000 / 8


def test_a_step_of_a_small_batch_is_few_tasks(spark, monkeypatch):
    asked, spread = [], tr.spread_batches
    monkeypatch.setattr(tr, "spread_batches", lambda b, key, world, n: asked.append(n) or spread(b, key, world, n))
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist(), i % 3) for i in range(60)], "id long, features array<double>, label int")
    fresh = lambda: tr.TrainState(tr.zero_model(3, 4), tr.SGD().init(None))
    run = lambda: tr.train(df, fresh(), tr.SGD(), epochs=1, batch_size=8, world_size=2, max_batches=2).theta
    few = run()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        many = run()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert asked == [2, 2] and np.allclose(few, many, rtol=1e-12)
    assert tr.epoch_partitions(10**9, 64, 4, 600) == 600 and tr.epoch_partitions(41 * 256, 64, 4, 600) == 4


def _small_run(spark, how="gather_mean", max_batches=None):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist(), i % 3) for i in range(150)], "id long, features array<double>, label int")
    state = tr.TrainState(tr.zero_model(3, 4), tr.SGD().init(None))
    return tr.train(df, state, tr.SGD(), epochs=1, batch_size=8, world_size=3, max_batches=max_batches, how=how)


def test_a_small_step_is_one_job(spark):
    def jobs(steps):
        spark.sparkContext.setJobGroup(f"steps-{steps}", "")
        try:
            assert len(_small_run(spark, max_batches=steps).telemetry) == steps
        finally:
            spark.sparkContext.setJobGroup("", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"steps-{steps}"))

    assert jobs(6) - jobs(2) == 4


@pytest.mark.parametrize("how", ["gather_mean", "allreduce"])
def test_steps_on_blocks_equal_steps_summed_by_tasks(spark, monkeypatch, how):
    # the last of 7 steps has 6 rows in all, so fewer rows a rank
    runs, summed, made = [], [], []
    step, blocks = tr._summed_step, tr.row_blocks
    monkeypatch.setattr(tr, "_summed_step", lambda *a: summed.append(1) or step(*a))
    monkeypatch.setattr(tr, "row_blocks", lambda b: made.append(1) or blocks(b))
    for sums, cells in ((1 << 17, 1 << 18), (1 << 17, 64), (1, 1 << 18), (1 << 17, 1)):
        monkeypatch.setattr(tr, "SUMS_PER_TASK", sums)
        monkeypatch.setattr(tr, "PARTITION_CELLS", cells)
        state = _small_run(spark, how)
        runs.append((len(summed), len(made), state.theta, np.array([t[:4] for t in state.telemetry])))
        summed.clear(), made.clear()
    # one window, several windows, large sums, large steps
    assert [r[0] for r in runs] == [0, 0, 7, 7] and runs[0][1] == 1 and runs[1][1] > 1 and not runs[2][1] + runs[3][1]
    for r in runs[1:]:
        assert np.allclose(r[2], runs[0][2], rtol=1e-12) and np.allclose(r[3], runs[0][3], rtol=1e-12)


def test_a_window_of_steps_has_partitions_of_its_own(spark, monkeypatch):
    from quarry.operators.indexing import assign_batches
    rows = assign_batches(spark.range(150), "id", 8, shuffle=True, seed=1, epoch=1, world_size=3)
    spread = tr.spread_batches(rows, "id", 3, 3, 2, 4).select("id", "step", F.spark_partition_id().alias("p")).collect()
    assert len({r.id for r in spread}) == 150 and {r.p // 3 for r in spread} == {0, 1, 2, 3}
    assert all(r.step // 2 == r.p // 3 for r in spread)
    read, steps = [], tr.block_gradients
    monkeypatch.setattr(tr, "PARTITION_CELLS", 64)
    monkeypatch.setattr(tr, "block_gradients", lambda b, s, m, own: read.append((s, own, b.getNumPartitions())) or steps(b, s, m, own))
    assert len(_small_run(spark).telemetry) == 7
    (_, first, held), (_, final, _) = read[0], read[-1]
    assert not set(first) & set(final) and held == 2 * len(first)  # a step reads its window, not the epoch


def test_partial_sums_dealt_by_parameter(spark):
    rows = [(i, 1, i % 2, i % 3, [float(i), 1.0], i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, epoch int, step int, rank int, features array<double>, label int").repartition(5)
    sums = lambda n: sorted((*r[:4], round(r[4], 12), r[5]) for r in tr.partial_gradients(df, tr.zero_model(2, 2), n).collect())
    assert sums(None) == sums(1) == sums(3)


def test_resume_equals_straight_run(spark):
    rng = np.random.default_rng(1)
    n, d, c = 120, 4, 3
    df = spark.createDataFrame([(i, rng.normal(size=d).tolist(), int(rng.integers(0, c))) for i in range(n)],
                               "id long, features array<double>, label int")
    fresh = lambda: tr.TrainState(tr.zero_model(c, d), tr.SGD().init(None))
    straight = tr.train(df, fresh(), tr.SGD(), epochs=2, batch_size=8, world_size=2, max_batches=4)
    one = tr.train(df, fresh(), tr.SGD(), epochs=1, batch_size=8, world_size=2, max_batches=4)
    frame = tr.state_frame(spark, one)
    resumed = tr.train(df, tr.state_from_frame(frame, tr.SGD()), tr.SGD(), epochs=1, batch_size=8,
                       world_size=2, max_batches=4)
    assert np.array_equal(straight.theta, resumed.theta)


def test_combiners_with_a_missing_rank(spark):
    cells = {(0, 0): [1.0, 2.0], (0, 1): [3.0, 6.0], (1, 0): [5.0, 5.0]}
    rows = [(1, step, rank, j, v, 2) for (step, rank), g in cells.items() for j, v in zip((-2, -1, 0, 1), [9.0, 1.0, *g])]
    parts = spark.createDataFrame(rows, tr.GRADIENT_SCHEMA)
    gm = {(r["step"], r["j"]): r["grad"] for r in tr.combine_gradients(parts, "gather_mean").collect()}
    ar = {(r["step"], r["j"]): r["grad"] for r in tr.combine_gradients(parts, "allreduce", 2).collect()}
    assert gm[(0, 0)] == 2.0 and ar[(0, 0)] == 2.0 and len(gm) == 4
    assert gm[(1, 0)] == 5.0 and ar[(1, 0)] == 2.5  # one rank present: mean over present ranks vs / world


def test_classes_with_gaps_keep_their_ids(spark):
    from quarry.operators.scoring import class_mean_model, load_linear, parameter_count
    rows = [(1, [9.0, 0.0], 3), (2, [0.0, 9.0], 7), (3, [8.0, 1.0], 3)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label int")
    table = class_mean_model(df)
    model = load_linear(table)
    unseen = df.union(spark.createDataFrame([(4, [0.0, 7.0], 5)], df.schema))
    out = {r["id"]: r for r in score_linear(unseen, model).collect()}
    assert [out[i]["pred"] for i in (1, 2, 3, 4)] == [3, 7, 3, 7]
    assert out[1]["loss"] < 0.1 and out[4]["loss"] is None
    assert parameter_count(table).first()[0] == 6


def test_report_with_text_labels_names_and_many_labels(spark):
    rows = [(i, t, p, 0.5, 0) for i, (t, p) in enumerate([("pos", "pos"), ("neg", "pos"), ("neg", "neg")])]
    df = spark.createDataFrame(rows, "id long, label string, pred string, loss double, batch int")
    rep = ev.classification_report(df).orderBy("order").collect()
    assert [r["label"] for r in rep] == ["neg", "pos", "accuracy", "macro avg", "weighted avg"]
    named = ev.classification_report(df, names=["negative", "positive"]).orderBy("order").collect()
    assert [r["label"] for r in named][:2] == ["negative", "positive"] and named[0]["support"] == 2
    sparse = {(r.truth, r.pred): r.n for r in ev.confusion_matrix(df, max_labels=1).collect()}
    assert sparse == {("pos", "pos"): 1, ("neg", "pos"): 1, ("neg", "neg"): 1}


def test_report_text_in_both_forms(spark):
    from quarry.sinks import report_lines
    rows = [(i, t, p, 0.25, 0) for i, (t, p) in enumerate([(0, 0)] * 12 + [(0, 1)] * 3 + [(1, 1)] * 5)]
    df = spark.createDataFrame(rows, "id long, label int, pred int, loss double, batch int")
    image = [r.value for r in report_lines(ev.eval_report(df), "ck.pt").orderBy("line_no").collect()]
    assert image == [
        "Metrics for the checkpoint: ck.pt", "Test Loss: 0.250, Test Accuracy: 0.850", "Classification Report",
        "              precision    recall  f1-score   support", "",
        "           0      1.000     0.800     0.889        15", "           1      0.625     1.000     0.769         5", "",
        "    accuracy                          0.850        20", "   macro avg      0.812     0.900     0.829        20",
        "weighted avg      0.906     0.850     0.859        20", "", "Confusion Matrix", "[[12  3]", " [ 0  5]]", "--------------------"]
    timing = spark.createDataFrame([(0.5, 2.0)], "avg_batch_duration double, duration double")
    text = [r.value for r in report_lines(ev.eval_report(df, names=["negative", "positive"]), "ck", "text", timing).orderBy("line_no").collect()]
    assert text[:2] == ["Validation Metrics for the checkpoint: ck", "Loss: 0.250, Accuracy: 0.850, Avg Batch Duration: 0.500 seconds, Duration: 2.000 seconds"]
    assert text[5].startswith("    negative ") and text[6].startswith("    positive ")


def test_eval_report_reads_the_scored_rows_once(spark):
    df = _scored(spark, [(0, 0), (1, 0), (1, 1)]).cache()
    rep = ev.eval_report(df)
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" not in plan  # everything comes from the checkpointed sums


def test_checkpoint_round_trip_with_loss(spark):
    from quarry.session import scratch_path
    from quarry.sinks import save_model
    from quarry.sources import load_model
    state = tr.TrainState(LinearModel(np.arange(6.0).reshape(2, 3), np.array([1.0, 2.0])), {"momentum": np.arange(8.0)}, step=5, epoch=2, loss=0.75)
    path = scratch_path(spark, "ck")
    for version in (1, 2, 2):
        save_model(tr.state_frame(spark, state), path, version)
    back = load_model(spark, path, 2)
    assert back.count() == 4 and {r.loss for r in back.collect()} == {0.75}
    loaded = tr.state_from_frame(back, tr.SGD())
    assert np.array_equal(loaded.theta, state.theta) and np.array_equal(loaded.optimizer_state["momentum"], np.arange(8.0))
    assert (loaded.step, loaded.epoch, loaded.loss) == (5, 2, 0.75)


def test_logs_are_appended_per_rank(spark):
    from quarry.session import scratch_path
    from quarry.sinks import append_log
    rows = [(r, 1, b, 1.0, 0.5, 2.0) for r in (0, 1) for b in range(45)]
    tele = spark.createDataFrame(rows, "rank int, epoch int, batch_idx int, loss double, accuracy double, duration double")
    path = scratch_path(spark, "log")
    for _ in range(2):
        append_log(tm.train_log(tele, checkpoint="/ck"), path)
    got = spark.read.text(path).where("rank = 1").groupBy("value").count().collect()
    lines = {r["value"]: r["count"] for r in got}
    assert len(lines) == 5 and set(lines.values()) == {2}  # header, batches 0, 20, 40, epoch
    assert "Logs for the checkpoint stored at: /ck/" in lines
    assert ("Rank: 1, Epoch: 1, Train Loss: 1.000, Train Accuracy: 0.500, Avg Batch Duration: 2.000 seconds, "
            "Epoch Duration: 90.000 seconds") in lines


def test_printed_numbers_are_pythons(spark):
    import random
    from pyspark.sql import functions as F
    from quarry.functions.decimals import fixed, printed
    rng = random.Random(9)
    values = [0.0005, 0.0015, 0.0025, 1.0005, 2.5, -0.0, -0.0004, 0.0, 1e-300, 0.0625, 0.1875, 1e11 + 0.0005, 123456.7895, -7.0005, float("inf"), float("-inf"), float("nan")]
    values += [rng.uniform(-10, 10) for _ in range(4000)] + [round(rng.uniform(0, 100), 4) for _ in range(4000)] + [rng.randrange(10**7) / 16000 for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", fixed(F.col("x")).alias("t"), fixed(F.col("x"), 1).alias("one"), fixed(F.col("x"), 6).alias("six")).collect()
    for r in rows:
        assert (r.t, r.one) == (f"{r.x:.3f}", f"{r.x:.1f}")
        assert r.six == f"{r.x:.6f}" or 2**52 / 10**6 <= abs(r.x) < float("inf")
    lines = spark.createDataFrame([(3, 1.0005, None)], "n int, a double, b double").select(printed("%d: %.3f, %9.3f", "n", "a", "b").alias("v"))
    assert lines.first()[0] == "3: 1.000,      null"


def test_text_log_has_separators(spark):
    from quarry.session import scratch_path
    from quarry.operators.sorting import read_lines_in_order
    from quarry.sinks import append_log
    tele = spark.createDataFrame([(e, b, 1.0005, 0.5, 2.0) for e in (1, 2) for b in range(150)],
                                 "epoch int, batch_idx int, loss double, accuracy double, duration double")
    path = scratch_path(spark, "text_log")
    append_log(tm.text_train_log(tele), path)
    lines = [r.value for r in read_lines_in_order(spark, path).orderBy("line_no").collect()]
    epoch = lambda e: [f"Epoch: {e}, Train Batch Idx: {b}, Train Batch Loss: 1.000, Train Batch Accuracy: 0.500, Train Batch Duration: 2.000 seconds"
                       for b in (0, 100)] + [f"Epoch: {e}, Train Loss: 1.000, Train Accuracy: 0.500, Train Duration: 300.000 seconds, Avg Train Batch Duration: 2.000 seconds", "-" * 46]
    assert lines == epoch(1) + epoch(2) + [
        "Avg Train Loss: 1.000, Avg Train Accuracy: 0.500, Avg Train Duration: 300.000 seconds, Avg Train Batch Duration: 2.000 seconds", "-" * 46]
    assert tm.text_train_log(tele.limit(0)).count() == 0


def test_null_truths_are_a_label_of_their_own(spark):
    rows = [(1, 1), (None, 1), (None, 0), (0, 0), (2, 2)]
    df = spark.createDataFrame([(t, p, 0.5, 0) for t, p in rows], "label int, pred int, loss double, batch int")
    matrix = {(r.truth, r.pred): r.n for r in ev.confusion_matrix(df).collect()}
    assert len(matrix) == 16 and matrix[None, 1] == matrix[None, 0] == 1 and matrix[None, None] == 0
    report = ev.classification_report(df).orderBy("order").collect()
    assert [r.label for r in report] == ["null", "0", "1", "2", "accuracy", "macro avg", "weighted avg"] and report[0].support == 2
    assert ev.accuracy(df).first()[0] == report[4].f1_score == 0.6
    from quarry.sinks import report_lines
    text = [r.value for r in report_lines(ev.eval_report(df), "ck").orderBy("line_no").collect()]
    assert any(line.startswith("        null ") for line in text) and "[[0 1 1 0]" in text


def test_five_thousand_labels(spark):
    df = spark.range(5000).selectExpr("id AS label", "IF(id % 10 = 0, id + 1, id) AS pred", "0.5D AS loss", "0 AS batch")
    report = ev.eval_report(df)
    matrix = report.where("section = 'matrix'")
    assert matrix.count() == 5000 and matrix.where("label <> other").count() == 500
    order = [r.label for r in report.where("section = 'report' and metric = 'support'").orderBy("position").collect()]
    assert order[:5000] == [str(i) for i in range(5000)]


#: 600 vectors of 3 classes by 2 values, in batches of 4 x 2 rows: more than 41 steps an epoch
VECTORS, FIT_BATCH = 600, 2


@pytest.fixture
def vectors(spark, tmp_path, monkeypatch):
    """The folder of a small table, and its training rows as (ids, features, labels)."""
    from quarry.plans import fixtures as fx
    from quarry.plans import queries as q
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=2).tolist(), i % 3) for i in range(VECTORS)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    monkeypatch.setattr(q, "RANK_BATCH", FIT_BATCH)
    train = fx.x_vec(spark, str(tmp_path)).where("split = 'train'").orderBy("vec_id").collect()
    assert 41 < -(-len(train) // (4 * FIT_BATCH))
    return str(tmp_path), [r.vec_id for r in train], np.array([r.features for r in train]), np.array([r.label for r in train])


def _whole_fit(ids, x, y, update, epochs):
    import hashlib
    h = lambda e, i: int(hashlib.md5(f"42|{e}|{i}".encode()).hexdigest()[:8], 16)
    return _numpy_train(x, y, ids, 3, update, epochs, FIT_BATCH, 4, None, lambda e: sorted(ids, key=lambda i: (h(e, i), i)))


def test_checkpoint_sink_fits_every_step(spark, vectors):
    from quarry.plans.queries import QUERIES
    folder, ids, _, _ = vectors
    steps = -(-len(ids) // (4 * FIT_BATCH))
    rows = QUERIES["checkpoint_sink"](spark, folder).collect()
    assert len(rows) == 8 and {(r.version, r.step) for r in rows} == {(1, steps), (2, 2 * steps)}


def test_train_adamw_fits_every_step(spark, vectors):
    from quarry.plans.queries import QUERIES
    folder, ids, x, y = vectors
    total = 3 * -(-len(ids) // (4 * FIT_BATCH))
    want = _whole_fit(ids, x, y, lambda *a: _adamw(*a, lr=5e-3, warmup=2, total=total), 3)
    got = [r.value for r in QUERIES["train_adamw"](spark, folder).orderBy("j").collect()]
    assert np.allclose(got, want, atol=2e-6)


def test_train_resume_fits_every_step(spark, vectors):
    from quarry.plans.queries import QUERIES
    folder, ids, x, y = vectors
    rows = QUERIES["train_resume"](spark, folder).orderBy("j").collect()
    assert np.allclose([r.resumed for r in rows], _whole_fit(ids, x, y, _sgd, 2), atol=2e-6)
    assert {r.max_abs_diff_to_straight for r in rows} == {0.0}
