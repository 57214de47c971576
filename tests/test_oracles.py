"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from quarry.plans.oracles import ORACLES
from quarry.plans.queries import QUERIES
from tests.conftest import SMOKE

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


def _canon(df):
    df = df[sorted(df.columns)]
    rows = [tuple("None" if v is None or v != v else (repr(round(float(v), 9)) if isinstance(v, float) else str(v))
                  for v in row) for row in df.itertuples(index=False)]
    return sorted(rows)


FORBIDDEN = ("BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def _assert_plan_is_scalable(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{op} in plan"


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SMOKE)
    _assert_plan_is_scalable(df)
    got = df.toPandas()
    want = con.sql(entry.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _canon(got) == _canon(want)


@pytest.mark.parametrize("key", ["checkpoint_sink", "train_adamw", "train_resume"])
def test_training_oracles_cover_every_step(spark, tmp_path, key):
    # 900 vectors: more training rows than two steps of 4 x 64
    rows = [(i, [math.sin(i), math.cos(3 * i)], i % 2) for i in range(900)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert _canon(entry.queries()[key](spark, str(tmp_path)).toPandas()) == _canon(c.sql(entry.oracle_sql()[key]).df())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "rank"]
    assert df.count() > 0
