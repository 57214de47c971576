"""Source mixing, URL filter, the pipeline and the registered queries."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import mixing, queries, urls
from tests.conftest import SMOKE
from tests.llm.cases import DOCS, edge_docs, edge_rows, no_docs, words
from tests.test_oracles import TABLES, _canon


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    got, want = queries.QUERIES[key](spark, SMOKE).toPandas(), con.sql(queries.ORACLES[key]).df()
    assert sorted(got.columns) == sorted(want.columns) and _canon(got) == _canon(want)


@pytest.mark.parametrize("key", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_covers_its_table(spark, key):
    whole = spark.read.parquet(f"{SMOKE}/{'pages' if key.startswith('op9') else 'documents'}.parquet").count()
    n = queries.QUERIES[key](spark, SMOKE).count()
    assert n == whole or key.startswith(("op7", "op8")) and n > 0


def test_native_queries_run_no_python(spark):
    for key in ("op1_mix_sources", "op4_url_filter"):
        plan = queries.QUERIES[key](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_copies_of_documents_without_a_key_are_spread(spark):
    docs = spark.range(4000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("a").alias("source"),
                                    F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in mixing.mix_sources(docs, epochs=3.0).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) >= 4000 and max(sizes) <= 1.5 * sum(sizes) / n


def test_counts_follow_the_poisson_law_and_the_weights(spark):
    docs = spark.range(30000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"),
                                     F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("source"))
    weights = spark.createDataFrame([("rare", 3.0), ("hot", 1.0), ("absent", 5.0)], "source string, weight double")
    out = mixing.mix_sources(docs, weights)
    n = {r.source: (r.n, r.d, r.rate) for r in out.groupBy("source").agg(
        F.count("*").alias("n"), F.countDistinct("doc_id").alias("d"), F.max("mix_rate").alias("rate")).collect()}
    assert abs(n["rare"][2] - 7.5) < 1e-9 and abs(n["hot"][2] - 1 / 3.6) < 1e-9
    assert abs(n["rare"][0] / 22500 - 1) < 0.03 and abs(n["hot"][0] / 7500 - 1) < 0.05
    for source, rows in (("rare", 3000), ("hot", 27000)):
        assert abs(n[source][1] / (rows * (1 - math.exp(-n[source][2]))) - 1) < 0.03
    counts = out.where("source = 'rare'").groupBy("doc_id").count().agg(F.var_samp("count")).first()[0]
    assert 6 < counts < 9


def test_mixing_edge_cases(spark):
    out = mixing.mix_sources(edge_docs(spark, clashing=True).withColumn("mix_rate", F.lit("old")), epochs=3.0)
    assert out.columns[-3:] == ["mix_rate", "mix_copy", "mix_order"] and out.count() > 0
    assert {r.source for r in out.select("source").distinct().collect()} == {"a", "b", None}
    repeated = out.where("doc_id = 10").groupBy("mix_copy").count().collect()
    assert all(r["count"] == 2 for r in repeated)
    assert mixing.mix_sources(no_docs(spark)).collect() == []
    blank = spark.createDataFrame([(1, "", "x", "s", 0), (2, None, "x", "s", 0)], DOCS)
    assert mixing.mix_sources(blank).collect() == []


def test_order_is_a_global_shuffle(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("ab").alias("text"), F.lit("s").alias("source"))
    rows = [r.doc_id for r in mixing.mix_sources(docs).collect()]
    n = len(rows)
    mean = sum(range(n))  # rank correlation of place and id is near 0
    corr = (12 * sum(i * r for i, r in enumerate(rows)) / n - 12 * (n - 1) / 2 * sum(rows) / n) / (n * 4000)
    assert abs(corr) < 0.1 and mean > 0


URLS = [(1, "HTTP://WWW.Example.com:80/a/b/?utm_source=x&q=1#top"), (2, "https://example.com/a/b?q=1"), (3, None), (4, "no scheme"),
        (5, "http://sub.example.org/es/x"), (6, "http://badexample.org/es/x"), (7, "http://example.org/en/12"), (8, "http://x.com"),
        (9, "http://x.com/de/1?u=http://y.org/es/"), (2, "https://example.com/a/b?q=1"), (10, "https://listed.net/"), (11, "")]


def test_url_parts_rules_and_list(spark):
    pages = spark.createDataFrame([(*r, "z", "z", 1) for r in URLS], "page_id bigint, url string, host string, rule string, listed int")
    listed = spark.createDataFrame([("http://example.com/a/b?q=1",), ("http://LISTED.net",), (None,), ("http://listed.net/",)], "url string")
    rows = urls.filter_urls(pages, listed, queries.URL_RULES).collect()
    got = {r.page_id: r for r in rows}
    assert len(rows) == len(URLS)
    assert [got[i].verdict for i in range(1, 12)] == ["block", "block", "allow", "allow", "block", "allow", "block", "allow", "block", "block", "allow"]
    assert (got[5].rule, got[6].rule, got[7].rule, got[9].rule) == ("example.org/es/", "org/", "example.org/en/1", "com/de/")
    assert (got[1].host, got[1].path) == ("www.example.com:80", "/a/b/") and (got[3].host, got[4].path) == ("", "")
    assert got[1].canonical == got[2].canonical and got[3].canonical is None
    nothing = urls.filter_urls(pages, listed.limit(0), queries.URL_RULES)
    assert nothing.count() == len(URLS) and nothing.where("listed").count() == 0
    assert urls.filter_urls(pages.limit(0), listed, queries.URL_RULES).collect() == []


def test_bloom_filter_has_no_false_negatives_and_few_positives(spark):
    listed = spark.range(5000).select(F.concat(F.lit("http://h.net/"), "id").alias("url"))
    pages = spark.range(20000).select(F.col("id").alias("page_id"), F.concat(F.lit("https://h.net/"), "id").alias("url"))
    got = urls.filter_urls(pages, listed, [])
    assert got.where("listed").count() == 5000 and got.where("listed and page_id >= 5000").count() == 0


def test_stages_keep_columns_and_edge_cases(spark):
    docs = edge_docs(spark, clashing=True)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMOKE)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == edge_docs(spark, clashing=True).columns
    docs.collect()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, no_docs(spark), SMOKE)
        assert empty.columns == no_docs(spark).columns and empty.collect() == []


def test_stage_decisions_equal_brute_force(spark):
    passage = words(500, 60)
    rows = [(i, words(i, 80), "en", "s", 0) for i in range(30)]
    rows += [(100, rows[3][1], "en", "s", 0), (101, rows[4][1].replace(rows[4][1].split()[40], "changed", 1), "en", "s", 0)]
    rows += [(200 + i, words(600 + i, 30) + "\n" + passage + "\n" + words(700 + i, 30), "en", "s", 0) for i in range(3)]
    item = spark.read.parquet(f"{SMOKE}/benchmark.parquet").orderBy("item_id").first().text
    rows += [(300, words(800, 30) + "\n" + item + "\n" + words(801, 30), "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    near = corpus_pipeline.near_dedup(spark, docs, SMOKE)
    assert sorted(r.doc_id for r in near.collect()) == [r[0] for r in rows if r[0] not in (100, 101)]
    cut = {r.doc_id: r for r in corpus_pipeline.substring_dedup(spark, near, SMOKE).collect()}
    assert passage in cut[200].text and cut[201].text == words(601, 30) + "\n" + words(701, 30)
    assert all(cut[i].text == rows[i][1] and cut[i].n_chars == len(rows[i][1]) for i in range(30))
    clean = corpus_pipeline.decontamination(spark, near, SMOKE)
    assert 300 not in {r.doc_id for r in clean.collect()} and clean.count() == near.count() - 1


def test_pipeline_runs_whole_tables(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept.count(), stage(spark, kept, SMOKE).cache()
        assert 0 < kept.count() <= before
    out = corpus_pipeline.run(spark, SMOKE)
    want = mixing.mix_sources(kept)
    assert sorted((r.doc_id, r.mix_copy) for r in out.collect()) == sorted((r.doc_id, r.mix_copy) for r in want.collect())
    assert edge_rows()
