"""Batches as records of bounded size, and back."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import training as tr

LISTS = {"ids": "id", "labels": "label", "features": "features"}


def _rows(n, seed=0):
    """A third of the rows in one batch, the others in batches of ten; nulls among them."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in rng.permutation(n).tolist():
        step = 0 if i % 3 == 0 else 1 + i // 15
        rows.append((1, i % 2 if step else 0, step, i, None if i % 50 == 1 else i % 7,
                     None if i % 70 == 2 else rng.normal(size=i % 5).tolist()))
    return rows


SCHEMA = "epoch int, rank int, step int, id bigint, label int, features array<double>"


@pytest.mark.parametrize("limit", [1 << 20, 2000, 1])
def test_round_trip_with_a_batch_of_a_third_of_the_table(spark, limit):
    rows = _rows(3000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")  # records span Arrow batches
    try:
        got = tr.collate_batches(df, record_bytes=limit).collect()
        back = tr.uncollate_batches(tr.collate_batches(df, record_bytes=limit), LISTS).select(*df.columns).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert sorted(map(repr, map(tuple, back))) == sorted(map(repr, rows))
    want = {}
    for r in sorted(rows, key=lambda r: r[:4]):
        want.setdefault(r[:3], []).append(r[3])
    parts = {}
    for r in sorted(got, key=lambda r: (r.epoch, r.rank, r.step, r.chunk, r.piece)):
        parts.setdefault((r.epoch, r.rank, r.step), []).append(r)
        size = sum(16 + 8 * len(f or ()) for f in r.features)
        assert len(r.ids) == len(r.labels) == len(r.features) and (size <= limit or len(r.ids) == 1)
    assert {k: [i for r in v for i in r.ids] for k, v in parts.items()} == want
    if limit == 1 << 20:
        assert all(len(v) == 1 for v in parts.values())


def test_a_large_batch_is_dealt_to_many_tasks(spark):
    df = spark.range(5000).select(F.lit(1).alias("epoch"), F.lit(0).alias("rank"), F.lit(0).alias("step"), "id",
                                  F.lit(1).alias("label"), F.array(F.lit(1.0)).alias("features"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = tr.collate_batches(df, record_bytes=2400).groupBy(F.spark_partition_id()).agg(
            F.sum(F.size("ids")).alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(t.n for t in tasks) == 5000 and max(t.n for t in tasks) <= 2500


def test_empty_tables_and_uneven_lists(spark):
    assert tr.collate_batches(spark.createDataFrame([], SCHEMA)).collect() == []
    lists = "b int, x array<int>, y array<string>"
    ok = spark.createDataFrame([(1, [1, None], ["a", "b"]), (2, [], []), (3, None, None)], lists)
    got = tr.uncollate_batches(ok, {"x": "u", "y": "v"}, pos="pos").collect()
    assert sorted(map(tuple, got)) == [(1, 0, 1, "a"), (1, 1, None, "b")]
    for bad in ((1, [1], ["a", "b"]), (1, None, ["a"])):
        with pytest.raises(Exception, match="different lengths"):
            tr.uncollate_batches(spark.createDataFrame([bad], lists), {"x": "u", "y": "v"}).collect()
