"""Sources: delimited tables, edge-list text, model checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Header CSV. Without a schema every column is a string (nothing is inferred), so
    values sort as text; pass a schema for typed ordering."""
    reader = spark.read.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", "false")
    return reader.csv(path)


def _is_dir(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory()


def read_edge_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of every file under ``path`` (a directory) or of ``path`` itself
    (a file or glob) as ``value``."""
    if not any(ch in path for ch in "*?[") and _is_dir(spark, path):
        path = path.rstrip("/") + "/*"
    return spark.read.text(path)


def drop_comments(lines: DataFrame, prefix: str = "#", col: str = "value") -> DataFrame:
    """Keep lines that do not start with ``prefix``."""
    return lines.where(~F.col(col).startswith(prefix))


def parse_edges(lines: DataFrame, comment: str = "#", mode: str = "dropmalformed",
                col: str = "value") -> DataFrame:
    """Edge lines -> ``(src, dst)``.

    Comment lines are skipped; the rest is split on runs of (Unicode) whitespace, at most three
    pieces, and the first two are kept (leading whitespace gives ``src = ''``, a single
    trailing blank gives ``dst = ''``). A line with fewer than two pieces is malformed:
    ``mode="dropmalformed"`` drops it, ``mode="failfast"`` fails the job,
    ``mode="flag"`` keeps every line and adds a boolean ``malformed``.
    """
    body = drop_comments(lines, comment, col) if comment else lines
    parts = F.split(F.col(col), r"(?U)\s+", 3)
    parsed = body.select(F.get(parts, 0).alias("src"), F.get(parts, 1).alias("dst"),
                         (F.size(parts) < 2).alias("malformed"))
    if mode == "dropmalformed":
        return parsed.where(~F.col("malformed")).drop("malformed")
    if mode == "failfast":
        checked = F.when(F.col("malformed"),
                         F.raise_error(F.lit("malformed edge line: fewer than two tokens")))
        return parsed.select(F.coalesce(checked.cast("string"), F.col("src")).alias("src"), "dst")
    if mode == "flag":
        return parsed
    raise ValueError(f"unknown mode {mode!r}")


def load_model(spark: SparkSession, path: str, version: int) -> DataFrame:
    """Parameters (and optimizer slots) of one saved version; partition pruning on
    ``version`` keeps the scan to that folder."""
    return spark.read.parquet(path).where(F.col("version") == version)
