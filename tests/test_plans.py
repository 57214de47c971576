"""Plan checks: column pruning reaches the Parquet scans."""

import re

import __spark_entry__ as entry
from tests.conftest import SMOKE


def _read_schemas(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"ReadSchema: (struct<[^>]*>)", plan)


def test_split_scan_reads_only_the_key(spark):
    schemas = _read_schemas(entry.queries()["dataset_split"](spark, SMOKE))
    assert schemas == ["struct<event_id:bigint>"]


def test_edge_fixture_scan_reads_three_lineitem_columns(spark):
    from quarry.operators import graph
    from quarry.plans import fixtures as fx
    df = graph.adjacency(fx.g_chain(spark, SMOKE))
    schemas = set(_read_schemas(df))
    assert schemas == {"struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>"}
