"""PageRank: hand-computed micro-cases and plan invariants."""

import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import graph


def _edges(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def _reference(pairs, d=0.85, epochs=10):
    """Plain-Python PageRank with the same semantics (inner join on sources)."""
    out = {}
    for s, t in pairs:
        out.setdefault(s, []).append(t)
    ranks = {s: 1.0 for s in out}
    for _ in range(epochs):
        acc = {}
        for s, r in ranks.items():
            for t in out.get(s, []):
                acc[t] = acc.get(t, 0.0) + r / len(out[s])
        ranks = {t: (1 - d) + d * v for t, v in acc.items()}
    return ranks


# a -> b twice (duplicate), a -> c, b -> c, c -> a, c -> d (d is a sink), e -> a (e has no in-edges)
PAIRS = [("a", "b"), ("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("c", "d"), ("e", "a")]


@pytest.mark.parametrize("epochs", [0, 1, 2, 5, 10])
def test_pagerank_matches_reference(spark, epochs):
    got = {r["id"]: r["rank"] for r in graph.pagerank(_edges(spark, PAIRS), 0.85, epochs).collect()}
    want = _reference(PAIRS, 0.85, epochs)
    assert set(got) == set(want)
    for k in want:
        assert math.isclose(got[k], want[k], rel_tol=1e-12)


def test_first_pass_by_hand(spark):
    got = {r["id"]: r["rank"] for r in graph.pagerank(_edges(spark, PAIRS), 0.85, 1).collect()}
    # a: from c (1/2) and e (1); b: 2/3 from a; c: 1/3 from a + 1 from b; d: 1/2 from c
    assert math.isclose(got["a"], 0.15 + 0.85 * 1.5)
    assert math.isclose(got["b"], 0.15 + 0.85 * (2 / 3))
    assert math.isclose(got["c"], 0.15 + 0.85 * (1 / 3 + 1))
    assert math.isclose(got["d"], 0.15 + 0.85 * 0.5)
    assert "e" not in got  # no in-edges: leaves after the first pass


@pytest.mark.parametrize("kwargs", [dict(persist=False), dict(num_partitions=20), dict(hot_threshold=1),
                                    dict(checkpoint_every=1), dict(checkpoint_every=0)])
def test_variants_agree(spark, kwargs):
    base = {r["id"]: r["rank"] for r in graph.pagerank(_edges(spark, PAIRS), 0.85, 6).collect()}
    other = {r["id"]: r["rank"] for r in graph.pagerank(_edges(spark, PAIRS), 0.85, 6, **kwargs).collect()}
    assert base.keys() == other.keys()
    for k in base:
        assert math.isclose(base[k], other[k], rel_tol=1e-12)


def test_salted_hot_sources_on_chain(spark):
    from quarry.plans import fixtures as fx
    edges = fx.g_chain(spark, "/root/testdata/sf0.001")
    a = {r["id"]: r["rank"] for r in graph.pagerank(edges, 0.85, 4).collect()}
    b = {r["id"]: r["rank"] for r in graph.pagerank(edges, 0.85, 4, hot_threshold=2).collect()}
    assert a.keys() == b.keys()
    assert max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_rank_sum_equals_vertex_count_on_closed_chain(spark):
    from quarry.plans import fixtures as fx
    edges = fx.g_chain(spark, "/root/testdata/sf0.01")
    r = graph.pagerank(edges, 0.85, 10)
    n, total = r.agg(F.count("*"), F.sum("rank")).first()
    assert n == 2000
    assert math.isclose(total, 2000.0, rel_tol=1e-9)


def test_as_written_character_pass(spark):
    got = {r["id"]: r["rank"] for r in graph.pagerank_as_written(_edges(spark, [("x", "ab"), ("y", "b"), ("z", "")])).collect()}
    assert math.isclose(got["a"], 0.15 + 0.85 * 0.5)
    assert math.isclose(got["b"], 0.15 + 0.85 * 1.5)
    assert set(got) == {"a", "b"}


def test_no_exchange_on_cached_edges_per_pass(spark):
    from quarry.plans import fixtures as fx
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    prepared = graph.weighted_edges(fx.g_chain(spark, "/root/testdata/sf0.001"))
    try:
        ranks = prepared.sources.withColumn("rank", F.lit(1.0))
        plan = graph._pass(prepared, ranks, 0.85)._jdf.queryExecution().executedPlan().toString().splitlines()
        depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
        cached = next(i for i, line in enumerate(plan) if "InMemoryTableScan" in line and "weight" in line)
        join = max(i for i in range(cached) if "Join" in plan[i])
        # between the join and the cached edges there may be a sort, but nothing that moves them
        above = [line for line in plan[join + 1:cached] if depth(line) < depth(plan[cached])]
        assert not any("Exchange" in line for line in above), above
    finally:
        prepared.release()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _counted(spark, rows, schema):
    """The rows as a table, and how many of them have been computed so far."""
    seen = spark.sparkContext.accumulator(0)
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(lambda r: (seen.add(1), r)[1]), schema), seen


def test_cached_edges_are_derived_once(spark):
    edges, seen = _counted(spark, PAIRS, "src string, dst string")
    got = {r["id"]: r["rank"] for r in graph.pagerank(edges, 0.85, 4).collect()}
    assert seen.value == len(PAIRS)
    assert {k: round(v, 12) for k, v in got.items()} == {k: round(v, 12) for k, v in _reference(PAIRS, 0.85, 4).items()}


@pytest.mark.parametrize("hot_threshold", [None, 1])
def test_passes_hash_the_ranks_and_sort_no_edges(spark, hot_threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    prepared = graph.weighted_edges(_edges(spark, PAIRS), hot_threshold=hot_threshold)
    try:
        ranks = prepared.sources.withColumn("rank", F.lit(1.0))
        plan = graph._pass(prepared, ranks, 0.85)._jdf.queryExecution().executedPlan().toString()
        above = plan[:plan.index("InMemoryTableScan")]
        assert "ShuffledHashJoin" in above and "Sort" not in above
    finally:
        prepared.release()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("kwargs", [{}, dict(hot_threshold=1)])
def test_null_ends(spark, kwargs):
    pairs = [("a", "b"), ("a", None), (None, "a"), (None, "b"), ("b", "a")]
    assert sorted(map(tuple, graph.adjacency(_edges(spark, pairs), **kwargs).select("src", "dst", "out_degree").fillna("-").collect())) == [
        ("a", "-", 2), ("a", "b", 2), ("b", "a", 1)]
    assert {r["id"] for r in graph.pagerank(_edges(spark, pairs), 0.85, 0, **kwargs).collect()} == {"a", "b", None}
    assert {r["id"] for r in graph.pagerank(_edges(spark, pairs), 0.85, 2, **kwargs).collect()} == {"a", "b", None}


def test_pagerank_frees_its_caches(spark):
    spark.catalog.clearCache()
    graph.pagerank(_edges(spark, PAIRS), 0.85, 3).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_edge_partitions_grow_with_the_graph(spark):
    assert graph.edge_partitions(spark, 10**9) == 4000


def test_step_operators_keep_duplicate_edges(spark):
    edges = _edges(spark, PAIRS)
    joined = graph.join_ranks(edges, graph.initial_ranks(edges))
    assert joined.count() == len(PAIRS)
    degree = edges.groupBy("src").agg(F.count("*").alias("out_degree"))
    got = graph.damped_sum(graph.contributions(joined.join(degree, "src")), 0.85, out_key="id")
    want = _reference(PAIRS, 0.85, 1)
    assert {r["id"]: round(r["rank"], 12) for r in got.collect()} == {k: round(v, 12) for k, v in want.items()}
