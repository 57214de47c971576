"""Global positions, seeded splits, equal buckets and mini-batch numbering.

``global_index`` gives every row its 0-based position in a total order without a
single-task window and without a copy of the table: range bounds come from a hash sample
and are constants of the plan, one job counts the rows of each range, and a row's position
is the number of rows in earlier ranges plus its place in its own. Nothing depends on where
a row was computed, so a lost executor's rows get the same positions again.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_int, hash_mod
from quarry.session import shuffle_partitions

#: ranges per shuffle partition: several to a task level out what hashing them deals unevenly
RANGES_PER_PARTITION = 3
#: sampled rows per range, and least rows that are worth a range
SAMPLED, LEAST_ROWS = 16, 64
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _cols(keys: Sequence) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def spread_ties(df: DataFrame, order: Sequence[Column]) -> list[Column]:
    """Order keys for range partitioning: rows that tie on ``order`` are told apart by a hash
    of the whole row, so one key value that holds much of the table spans many ranges."""
    hashable = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return [*order, F.xxhash64(*hashable)] if hashable else list(order)


def _with_range(df: DataFrame, key: str, sample: DataFrame, ranges: int, col: str) -> DataFrame:
    """Add the number of the range that the struct ``key`` falls in: how many of ``ranges - 1``
    bounds are not above it. ``sample`` has the same struct as its column ``k``.

    The bounds are every so-manieth row of the sorted sample. They stand in the plan as one
    constant, in blocks of about the square root of their number, so that a row is compared with the first
    bounds of the blocks and then with those of one block. Any bounds give right
    positions; it does not matter that their JSON form may round a value.
    """
    rows = [r.k for r in sample.orderBy("k").select(F.to_json("k", _JSON).alias("k")).collect()] if ranges > 1 else []
    bounds = list(dict.fromkeys(rows[len(rows) * i // ranges] for i in range(1, ranges))) if rows else []
    if not bounds:
        return df.withColumn(col, F.lit(0))
    width = math.isqrt(len(bounds)) + 1
    blocks = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    kind = sample.schema["k"].dataType.simpleString()
    array = lambda texts: "[" + ",".join(texts) + "]"
    heads = F.from_json(F.lit(array(x[0] for x in blocks)), f"array<{kind}>", _JSON)
    table = F.from_json(F.lit(array(map(array, blocks))), f"array<array<{kind}>>", _JSON)
    # the key as the bounds' type, and the block, are columns: not worked out again per comparison
    below = lambda bound: F.size(F.filter(bound, lambda x: x <= F.col("_gi_bound")))
    blocked = df.withColumn("_gi_bound", F.col(key).cast(kind)).withColumn("_gi_block", below(heads) - 1)
    place = F.when(F.col("_gi_block") < 0, 0).otherwise(F.col("_gi_block") * width + below(F.get(table, F.col("_gi_block"))))
    return blocked.withColumn(col, place).drop("_gi_bound", "_gi_block")


#: a range of hashed keys with more than so many times the mean's rows (and so many rows at
#: least) makes the ranges be sampled: one key value holds much of the table
UNEVEN, UNEVEN_ROWS = 8, 100_000


def _index_by_hash(df: DataFrame, keys: Sequence[Column], pos: str, total: str | None, parts: int) -> DataFrame | None:
    """:func:`global_index` by a first key that is a hash from 0 to 2^32 - 1: ranges of equal
    width need no sample, and a row's range is arithmetic whatever their number. The rows are
    computed twice. None if a range is far above the others."""
    ranges = parts * RANGES_PER_PARTITION
    placed = df.withColumn("_gi_hash", keys[0]).withColumn(
        "_gi_range", F.shiftright(F.col("_gi_hash") * F.lit(ranges).cast("bigint"), 32).cast("int"))
    sizes = {r._gi_range: r.n for r in placed.groupBy("_gi_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = sum(sizes.values())
    if max(sizes.values(), default=0) > max(UNEVEN * rows // ranges, UNEVEN_ROWS):
        return None
    before = [0, *itertools.accumulate(sizes.get(i, 0) for i in range(ranges))]
    offset = F.get(F.from_json(F.lit(str(before)), "array<bigint>"), F.col("_gi_range"))
    ties = spread_ties(df, [])
    place = F.row_number().over(Window.partitionBy("_gi_range").orderBy("_gi_hash", *keys[1:], *ties))
    out = placed.withColumn(pos, (offset + place - 1).cast("bigint"))
    if total:
        out = out.withColumn(total, F.lit(rows).cast("bigint"))
    return out.drop("_gi_hash", "_gi_range")


def global_index(df: DataFrame, keys: Sequence, pos: str = "pos", total: str | None = None,
                 num_partitions: int | None = None, hashed: bool = False) -> DataFrame:
    """Append ``pos`` = 0-based rank of each row under ascending ``keys``, nulls first.

    ``keys`` should form a total order (add a unique column as the last key); rows that
    tie on them are ordered by a hash of the whole row, so one value that holds much of
    the table spans many ranges, and rows that tie completely are interchangeable.
    With ``total`` set, the row count is appended as well.

    The rows of ``df`` are computed four times (counted, sampled, counted by range, placed), so
    ``df`` must give the same rows again; nothing is written. A range holds about 1 /
    (``RANGES_PER_PARTITION`` x partitions) of the rows. ``hashed``: the first key is a
    :func:`hash_int`; then two times are enough, unless one key holds much of the table.
    """
    spark = df.sparkSession
    parts = num_partitions or shuffle_partitions(spark)
    if hashed:
        out = _index_by_hash(df, _cols(keys), pos, total, parts)
        if out is not None:
            return out
    order = {f"k{i}": c for i, c in enumerate(spread_ties(df, _cols(keys)))}
    keyed = df.withColumn("_gi_key", F.struct(*[c.alias(k) for k, c in order.items()]))
    rows = df.count()
    ranges = max(1, min(parts * RANGES_PER_PARTITION, rows // LEAST_ROWS))
    draw = F.pmod(F.xxhash64("_gi_key"), F.lit(max(1, rows // (ranges * SAMPLED))))
    placed = _with_range(keyed, "_gi_key", keyed.where(draw == 0).select(F.col("_gi_key").alias("k")), ranges, "_gi_range")
    counts = [(r._gi_range, r.n) for r in placed.groupBy("_gi_range").agg(F.count(F.lit(1)).alias("n")).collect()]
    sizes = dict(counts)
    before = [0, *itertools.accumulate(sizes.get(i, 0) for i in range(max(sizes, default=0)))]
    offset = F.get(F.from_json(F.lit(str(before)), "array<bigint>"), F.col("_gi_range"))
    place = F.row_number().over(Window.partitionBy("_gi_range").orderBy(*[f"_gi_key.{k}" for k in order]))
    out = placed.withColumn(pos, (offset + place - 1).cast("bigint"))
    if total:
        out = out.withColumn(total, F.lit(sum(sizes.values())).cast("bigint"))
    return out.drop("_gi_key", "_gi_range")


def assign_split(df: DataFrame, key: str, fractions: Sequence[int] = (80, 10, 10),
                 seed: int = 42, names: Sequence[str] = ("train", "validation", "test"),
                 col: str = "split") -> DataFrame:
    """Stable train/validation/test membership from ``hash_int(seed, key) % 100``.

    ``fractions`` are whole percentages summing to 100.
    """
    if sum(fractions) != 100 or len(fractions) != len(names):
        raise ValueError("fractions must be percentages summing to 100, one per name")
    bucket = hash_mod(100, seed, F.col(key))
    expr = None
    upper = 0
    for frac, name in zip(fractions, names):
        upper += frac
        cond = bucket < upper
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(col, expr)


def seeded_order(key: str, seed: int, *salt) -> list[Column]:
    """Order keys for a seeded random permutation: (hash, key)."""
    return [hash_int(seed, *salt, F.col(key)), F.col(key)]


def equal_random_buckets(df: DataFrame, n: int = 20, key: str | Sequence[str] = "id",
                         seed: int = 42, col: str = "bucket") -> DataFrame:
    """Split rows into ``n`` buckets of (almost) equal size in a seeded random order.

    With ``N`` rows and ``s = N div n``: position ``p < n*s`` goes to bucket ``p div s``,
    a leftover position ``p`` goes to bucket ``p - n*s``; sizes differ by at most one and
    the extra rows sit in the first buckets.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [hash_int(seed, *[F.col(k) for k in keys])] + [F.col(k) for k in keys]
    ranked = global_index(df, order, pos="_eb_pos", total="_eb_n", hashed=True)
    size = F.floor(F.col("_eb_n") / F.lit(n))
    bucket = F.when(F.col("_eb_pos") < F.lit(n) * size, F.floor(F.col("_eb_pos") / size)).otherwise(
        F.col("_eb_pos") - F.lit(n) * size
    )
    return ranked.withColumn(col, bucket.cast("int")).drop("_eb_pos", "_eb_n")


def assign_batches(df: DataFrame, key: str, batch_size: int, shuffle: bool = False,
                   seed: int = 0, epoch: int = 0, world_size: int = 1) -> DataFrame:
    """Mini-batch numbering of one epoch.

    Position ``p`` follows ``key`` order, or a seeded per-epoch permutation when
    ``shuffle``. Rank ``p % world_size`` gets every ``world_size``-th row (disjoint
    shards, no padding), and its local position ``p div world_size`` gives
    ``step = local div batch_size``. The short last batch is kept.
    Adds ``epoch``, ``pos``, ``rank``, ``step``.
    """
    order = seeded_order(key, seed, epoch) if shuffle else [F.col(key)]
    ranked = global_index(df, order, pos="pos", hashed=shuffle)
    local = F.floor(F.col("pos") / F.lit(world_size))
    return ranked.select(
        "*",
        F.lit(epoch).cast("int").alias("epoch"),
        F.pmod(F.col("pos"), F.lit(world_size)).cast("int").alias("rank"),
        F.floor(local / F.lit(batch_size)).cast("int").alias("step"),
    )


def next_in_group(df: DataFrame, group: str, order: Sequence[str], value: str,
                  out: str = "next_value") -> DataFrame:
    """``lead(value) over (partition by group order by order...)`` without a per-group
    window: rows get global positions under ``(group, order...)`` and each row is
    joined to the row one position later, kept only if it is in the same group.
    Range partitioning and the positional equi-join spread even a group that holds a
    large share of all rows over many tasks. Rows without a successor get null."""
    ranked = global_index(df, [group, *order], pos="_ng_pos")
    succ = ranked.select((F.col("_ng_pos") - 1).alias("_ng_pos"), F.col(group).alias("_ng_group"),
                         F.col(value).alias(out))
    joined = ranked.join(succ, "_ng_pos", "left")
    return joined.select(*[c for c in df.columns],
                         F.when(F.col("_ng_group").eqNullSafe(F.col(group)), F.col(out)).alias(out))


def lead_in_group(df: DataFrame, group: str, order: Sequence[str], value: str,
                  out: str = "next_value", hot_threshold: int | None = None) -> DataFrame:
    """``lead(value)`` within ``group`` in ``order``, skew-safe.

    A null ``group`` is a group like any other. Groups of at most ``hot_threshold`` rows (default ``ceil(N / (2n))``) use an
    ordinary window partitioned by the group; the few larger groups (fewer than ``2n``
    by construction, so their keys are fetched once as a literal list) go through
    :func:`next_in_group`, which spreads a group over many tasks. One small aggregate
    job decides whether there are any.
    """
    spark = df.sparkSession
    n = shuffle_partitions(spark)
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_lg_n"))
    total, largest = sizes.agg(F.sum("_lg_n"), F.max("_lg_n")).first()
    if hot_threshold is None:
        hot_threshold = max(1, -(-(total or 0) // (2 * n)))
    w = Window.partitionBy(group).orderBy(*order)
    if not largest or largest <= hot_threshold:
        return df.withColumn(out, F.lead(value).over(w))
    hot = [r[0] for r in sizes.where(F.col("_lg_n") > hot_threshold).select(group).collect()]
    # null is a group like any other: membership must never be null
    is_hot = F.coalesce(F.col(group).isin([h for h in hot if h is not None]), F.lit(None in hot))
    cold = df.where(~is_hot).withColumn(out, F.lead(value).over(w))
    return cold.unionByName(next_in_group(df.where(is_hot), group, order, value, out))
