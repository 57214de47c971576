"""Global positions, buckets, batches, splits."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators.indexing import assign_batches, assign_split, equal_random_buckets, global_index


def test_global_index_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"))
    out = global_index(df, ["k"], pos="pos", total="n").collect()
    assert sorted(r["pos"] for r in out) == list(range(5000))
    assert all(r["n"] == 5000 for r in out)
    by_pos = sorted(out, key=lambda r: r["pos"])
    assert [r["k"] for r in by_pos] == sorted(r["k"] for r in out)


def test_bucket_sizes_differ_by_at_most_one(spark):
    for n_rows in (7, 20, 53, 1000):
        b = equal_random_buckets(spark.range(n_rows), n=20, key="id", seed=3).collect()
        sizes = Counter(r["bucket"] for r in b)
        if n_rows >= 20:
            assert len(sizes) == 20 and max(sizes.values()) - min(sizes.values()) <= 1
            extra = n_rows % 20
            assert all(sizes[i] == n_rows // 20 + (1 if i < extra else 0) for i in range(20))
        else:
            assert sorted(sizes) == list(range(n_rows))  # one row each in the first buckets


def test_batches_shard_disjointly_and_keep_short_last(spark):
    b = assign_batches(spark.range(0, 1001), "id", batch_size=64, shuffle=True, seed=1, epoch=2, world_size=4).collect()
    assert len({r["id"] for r in b}) == 1001
    per = Counter((r["rank"], r["step"]) for r in b)
    assert max(per.values()) == 64
    assert per[(0, 3)] == 251 - 3 * 64  # rank 0 holds 251 rows
    again = assign_batches(spark.range(0, 1001), "id", 64, True, 1, 2, 4).collect()
    assert {r["id"]: (r["rank"], r["step"]) for r in b} == {r["id"]: (r["rank"], r["step"]) for r in again}


def test_split_is_stable_and_proportional(spark):
    s = assign_split(spark.range(0, 20000), "id", (80, 10, 10), seed=42).groupBy("split").count().collect()
    counts = {r["split"]: r["count"] for r in s}
    assert abs(counts["train"] / 20000 - 0.8) < 0.02
    assert abs(counts["test"] / 20000 - 0.1) < 0.02


def test_lead_in_group_hot_and_cold_paths_agree(spark):
    from quarry.operators.indexing import lead_in_group
    rows = [(0 if i < 300 else i % 17, i % 5, i) for i in range(600)]  # group 0 holds half the rows
    df = spark.createDataFrame(rows, "g long, a int, v long")
    want = {r["v"]: r["nxt"] for r in lead_in_group(df, "g", ["a", "v"], "v", "nxt", hot_threshold=10**9).collect()}
    got = {r["v"]: r["nxt"] for r in lead_in_group(df, "g", ["a", "v"], "v", "nxt", hot_threshold=50).collect()}
    assert got == want
    assert sum(1 for x in want.values() if x is None) == 17


def test_lead_in_group_with_null_groups(spark):
    """Null is a group like any other, hot or not; no row may go."""
    from quarry.operators.indexing import lead_in_group
    for hot, rows in (("null", [(None, i) for i in range(40)] + [(1, 100 + i) for i in range(22)]),
                      ("one", [(1, i) for i in range(40)] + [(None, 100 + i) for i in range(22)])):
        df = spark.createDataFrame(rows, "g long, v long")
        want = sorted(lead_in_group(df, "g", ["v"], "v", "nxt", hot_threshold=10**9).collect(), key=lambda r: r["v"])
        got = sorted(lead_in_group(df, "g", ["v"], "v", "nxt", hot_threshold=25).collect(), key=lambda r: r["v"])
        assert len(got) == 62 and got == want, hot


def test_a_hot_sort_key_spans_many_ranges(spark):
    from quarry.operators.sorting import sort_to_ordered_partitions
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"), "id")
    parts = sort_to_ordered_partitions(df, ["k"], num_partitions=8).withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in parts.groupBy("p").count().collect()]
    assert max(sizes) < 1200  # the null key holds 2000 rows


def test_positions_equal_a_sort_in_the_driver_for_keys_of_many_types(spark):
    """Null, NaN, quotes, microseconds, ties and a value on two thirds of the rows; hot values
    span ranges, and several hundred rows make many ranges."""
    rows = [(None if i % 3 else f'k"{i % 7}\\', [float("nan"), -0.5, None, 1e300][i % 4], i % 11, 1_700_000_000_000_000 + i * 7919 % 1501, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a string, b double, c int, us long, id long").withColumn("t", F.timestamp_micros("us"))
    got = global_index(df, ["a", "b", "t", "c", "id"], pos="pos", total="n", num_partitions=16).collect()

    def order(r):
        rank = lambda v: (v is not None, 0 if v is None else (v != v, 0 if v != v else v))
        return ((r.a is not None, r.a or ""), rank(r.b), r.us, r.c, r.id)

    want = {r.id: i for i, r in enumerate(sorted(got, key=order))}
    assert {r.id: r.pos for r in got} == want and {r.n for r in got} == {3000}


def test_positions_of_empty_tables_and_repeated_rows(spark):
    assert global_index(spark.range(0), ["id"], total="n").collect() == []
    same = global_index(spark.range(500).select(F.lit("x").alias("k")), ["k"]).collect()
    assert sorted(r.pos for r in same) == list(range(500))


def test_positions_write_nothing(spark, tmp_path):
    """The layout is in the plan, not in a copy of the table, and ranges share a hot key."""
    out = global_index(spark.range(6000).select((F.col("id") % 2 * F.col("id")).alias("k"), "id"), ["k"], num_partitions=8)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Scan ExistingRDD" not in plan and "LogicalRDD" not in plan
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3000  # 3000 rows have the key 0
    assert sorted(r.pos for r in out.where("k = 0").collect()) == list(range(3000))


def test_sort_by_keys_deals_a_hot_key_over_tasks(spark):
    """One key on half of the rows: the largest task has at most twice the mean."""
    from quarry.operators.sorting import sort_by_keys
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(40000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
        out = sort_by_keys(df, ["k"]).select("k", "id", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.k for r in out] == sorted(r.k for r in out) and len({r.id for r in out}) == 40000
    sizes = Counter(r.p for r in out)
    assert max(sizes.values()) <= 2 * 40000 / 8, sizes


@pytest.mark.parametrize("least", [0, 100_000])
def test_hashed_positions_are_the_sorted_ones(spark, monkeypatch, least):
    from quarry.functions.hashing import hash_int
    from quarry.operators import indexing
    monkeypatch.setattr(indexing, "UNEVEN_ROWS", least)
    rows = [(i // 3 if i % 2 else 7, None if i % 5 == 0 else str(i % 11)) for i in range(1500)]  # one key has half of the rows
    df = spark.createDataFrame(rows, "k long, v string").repartition(4)
    order = [hash_int(3, F.col("k")), F.col("k"), F.col("v")]
    fast = indexing.global_index(df, order, total="n", hashed=True)
    plain = indexing.global_index(df, order, total="n")
    assert sorted(map(str, fast.collect())) == sorted(map(str, plain.collect()))
    assert indexing.global_index(df.limit(0), order, total="n", hashed=True).count() == 0


def test_buckets_compute_their_rows_twice(spark):
    seen = spark.sparkContext.accumulator(0)
    rows = spark.sparkContext.parallelize(range(1000), 2).map(lambda i: (seen.add(1), (i,))[1])
    assert len(equal_random_buckets(spark.createDataFrame(rows, "id long"), 20).collect()) == 1000
    assert seen.value == 2000
