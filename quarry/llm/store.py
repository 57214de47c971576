"""Shared folder of the cluster for tables written between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a local session without that setting
    (tests) gets a folder of its own; any other master must name one."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="quarry-llm-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: cuts the lineage,
    and later jobs survive lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/quarry-llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: rows of an Arrow batch between the JVM and Python
BATCH_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir``. Its texts have kilobytes each, so Spark's default of 10,000 rows an
    Arrow batch would take tens of megabytes several times over in every Python worker; a
    session with larger batches is set to ``BATCH_ROWS``."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def splittable(key: str) -> Column:
    """An integer join key for a table and an aggregate of it by the same key. The aggregate is
    already dealt by ``key``, and a join on the bare key would take it as it is; Spark splits
    a hot key only if both sides are dealt for the join, which another form of it brings."""
    return F.col(key).bitwiseXOR(F.lit(1))
