"""Sorting by text keys and the sorted-CSV job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.indexing import global_index, spread_ties
from quarry.session import checkpoint_root
from quarry.sinks import write_csv
from quarry.sources import read_table_csv


def sort_by_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ascending sort, nulls first (range-partition exchange + per-partition sort). Rows that
    tie on ``keys`` are ordered by a hash of the whole row, so a key value that holds much
    of the table is dealt over many ranges in proportion to its rows."""
    return df.orderBy(*spread_ties(df, [F.col(k) for k in keys]))


def with_sorted_position(df: DataFrame, keys: Sequence[str], pos: str = "pos") -> DataFrame:
    """The sort made visible: each row's 0-based position under ``ORDER BY keys``."""
    return global_index(df, list(keys), pos=pos)


def sort_to_one(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sorted rows in exactly one partition -- for small outputs only, since one task
    holds everything.

    ``repartition(1).sortWithinPartitions`` -- sorting first and then moving to one
    partition would not keep the order across the exchange.
    """
    return df.repartition(1).sortWithinPartitions(*keys)


def sort_to_ordered_partitions(df: DataFrame, keys: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """Sorted rows as a sequence of range partitions: every key in partition ``i`` sorts
    before every key in partition ``i + 1`` and each partition is sorted, so reading the
    partitions (or their part files) in order gives the single sorted sequence without
    any task holding all rows."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = spread_ties(df, [F.col(k) for k in keys])
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order)


def ordered_position(df: DataFrame, pos: str = "pos") -> DataFrame:
    """0-based position of each row in partition order (partition id, row in partition),
    from per-partition counts. Partition numbers are no property of a row, so the tagged
    rows are checkpointed before they are counted."""
    checkpoint_root(df.sparkSession)
    tagged = df.select("*", F.spark_partition_id().alias("_op_pid"), F.monotonically_increasing_id().alias("_op_mid")).checkpoint()
    return global_index(tagged, ["_op_pid", "_op_mid"], pos=pos).drop("_op_pid", "_op_mid")


def sort_csv(spark, src: str, dst: str, keys: Sequence[str], single: bool = False,
             schema=None) -> None:
    """Read a header CSV, sort by ``keys`` and write header CSV part files in global
    order (part files in name order = the sorted file). ``single=True`` writes one
    file through one task, as the studied job does; use it for small outputs."""
    df = read_table_csv(spark, src, schema)
    if single:
        write_csv(df, dst, single=True, sort_keys=list(keys))
    else:
        write_csv(sort_to_ordered_partitions(df, keys), dst)


def read_lines_in_order(spark, path: str, pos: str = "line_no") -> DataFrame:
    """Lines of the text files under ``path`` in (file name, offset) order with their
    0-based position; used to check what a writer put where."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_mid"), "value")
    return global_index(lines, ["_file", "_mid"], pos=pos).drop("_file", "_mid")
