"""A model as a table of class rows against the literal path and plain NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import scoring as sc


def _rows(spark, n=500, dim=7, classes=23, seed=3):
    rng = np.random.default_rng(seed)
    x, w, b = rng.normal(size=(n, dim)).round(1), rng.normal(size=(classes, dim)).round(1), rng.normal(size=classes).round(1)
    labels = [5 * c + 1 for c in range(classes)]
    truth = [None if i % 50 == 0 else 999 if i % 51 == 0 else labels[i % classes] for i in range(n)]
    df = spark.createDataFrame([(i % 400, x[i].tolist(), truth[i], f"t{i}") for i in range(n)], "id long, features array<double>, label int, note string")
    model = spark.createDataFrame([(labels[c], w[c].tolist(), float(b[c])) for c in range(classes)], "label int, weight array<double>, bias double")
    return x, w, b, labels, truth, df, model


@pytest.mark.parametrize("cells", [sc.CHUNK_CELLS, 300, 7])
def test_scores_do_not_depend_on_the_chunks(spark, cells):
    x, w, b, labels, truth, df, model = _rows(spark)
    z = x @ w.T + b
    log = z - z.max(axis=1, keepdims=True)
    log -= np.log(np.exp(log).sum(axis=1, keepdims=True))
    expected = {f"t{i}": (labels[int(z[i].argmax())], None if truth[i] not in labels else round(-log[i, labels.index(truth[i])], 9)) for i in range(len(x))}
    got = sc.score_by_class_rows(df.repartition(3), model.repartition(4), keep=("id", "note"), chunk_cells=cells).collect()
    assert len(got) == len(x)
    assert {r.note: (r.pred, None if r.loss is None else round(r.loss, 9)) for r in got} == expected


def test_ties_empty_tables_and_no_label(spark):
    model = spark.createDataFrame([(2, [1.0], 0.0), (1, [1.0], 0.0)], "label int, weight array<double>, bias double")
    df = spark.createDataFrame([(1, [3.0]), (2, [-3.0])], "id long, features array<double>")
    got = sc.score_by_class_rows(df, model, label=None).collect()
    assert {(r.id, r.pred, r.loss) for r in got} == {(1, 1, None), (2, 1, None)}
    assert sc.score_by_class_rows(df.limit(0), model, label=None).count() == 0


def test_class_mean_rows_are_the_class_mean_model(spark):
    *_, df, _ = _rows(spark)
    known = df.where("label is not null")
    literal = sc.score_linear(known, sc.load_linear(sc.class_mean_model(known))).select("note", "pred", F.round("loss", 9).alias("loss"))
    rows = sc.score_by_class_rows(known, sc.class_mean_rows(known), keep=("note",)).select("note", "pred", F.round("loss", 9).alias("loss"))
    assert sorted(map(tuple, literal.collect())) == sorted(map(tuple, rows.collect()))
