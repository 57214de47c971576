"""Edge-list PageRank and its building blocks.

Semantics (unnormalised PageRank over a multiset of directed edges):

* ranks start at 1.0 on every distinct source (pure sinks get none);
* each pass, a source hands ``rank / out_degree`` to every out-edge (duplicate edges
  count in both numerator and degree), and every destination that received something
  gets ``(1 - d) + d * sum``;
* the rank table is inner-joined with the edges by source, so a vertex without in-edges
  leaves after the first pass and a vertex without out-edges receives but never gives.

Physical plan: the edge multiset is de-duplicated once into
``(src, salt, dst, weight = multiplicity / out_degree)``, hash-partitioned on
``(src, salt)`` and cached. ``salt`` is 0 except for the few *hot* sources whose fan-out
exceeds ``R / (2n)`` (``R`` distinct edges, ``n`` partitions); their edges are spread
over several salts so one huge source cannot fill one task. Each pass replicates the
rank row of a hot source once per salt (a broadcast of fewer than ``2n`` rows tells
which), shuffles the rank table -- vertex-sized -- to the cached edges' partitioning,
joins without moving or sorting the edges (a hash table of a partition's ranks), and
aggregates contributions by ``dst`` with a map-side partial sum, so a hot destination is
combined before it is shuffled.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import checkpoint_root, shuffle_partitions


def initial_ranks(edges: DataFrame) -> DataFrame:
    """One row ``(src, rank=1.0)`` per distinct source."""
    return edges.select("src").distinct().withColumn("rank", F.lit(1.0).cast("double"))


def join_ranks(edges: DataFrame, ranks: DataFrame) -> DataFrame:
    """Inner equi-join of edges with the current ranks on the source."""
    return edges.join(ranks, "src", "inner")


def adjacency(edges: DataFrame, hot_threshold: int | None = None) -> DataFrame:
    """Adjacency in flat form: ``(src, dst, multiplicity, out_degree)`` per distinct edge.

    Flat rows instead of one list per source, so a source with a huge fan-out never
    becomes one huge record; the out-degree reaches hot sources by broadcast.
    """
    table, _, _ = salted_edges(edges, hot_threshold=hot_threshold)
    return table.select("src", "dst", F.col("mult").alias("multiplicity"), "out_degree")


def contributions(edges_with_rank: DataFrame) -> DataFrame:
    """``(src, dst, contribution)`` from ``(src, dst, rank, out_degree)`` rows (one per edge)."""
    return edges_with_rank.select(
        "src", "dst", (F.col("rank") / F.col("out_degree")).alias("contribution")
    )


def damped_sum(contribs: DataFrame, d: float = 0.85, key: str = "dst",
               value: str = "contribution", out_key: str = "src") -> DataFrame:
    """Per destination: ``(1 - d) + d * sum(contribution)`` (map-side combined)."""
    return contribs.groupBy(key).agg(
        (F.lit(1.0 - d) + F.lit(d) * F.sum(value)).alias("rank")
    ).withColumnRenamed(key, out_key)


def map_values(df: DataFrame, fn, value: str = "rank") -> DataFrame:
    """Change the value column, keep the key (e.g. the damping ``(1-d) + d * sum``)."""
    return df.withColumn(value, fn(F.col(value)))


def char_contributions(edges: DataFrame, rank: float = 1.0) -> DataFrame:
    """As-written contribution step: every *character* of ``dst`` receives
    ``rank / length(dst)``; an empty ``dst`` hands out nothing."""
    return (
        edges.where(F.length("dst") > 0)
        .select(F.explode(F.split("dst", "")).alias("dst"),
                (F.lit(rank) / F.length("dst")).alias("contribution"))
    )


def pagerank_as_written(edges: DataFrame, d: float = 0.85) -> DataFrame:
    """One character-level pass with every source at rank 1.0 (the number of passes has
    no effect on this variant)."""
    return damped_sum(char_contributions(edges), d, out_key="id")


@contextmanager
def _cache_keeps_partitioning(spark):
    """Cache with the plan's hash partitioning kept visible to later joins.

    An adaptive plan reports unknown partitioning once it is cached, which would make every
    pass shuffle the cached edges again. With adaptive execution off while the cache entry
    is made, ``hashpartitioning(src, n)`` stays known.
    """
    key = "spark.sql.adaptive.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


class PreparedEdges:
    """De-duplicated, weighted, salted edge table reused by every pass."""

    def __init__(self, table: DataFrame, hot: DataFrame, sources: DataFrame,
                 num_partitions: int, cached: list[DataFrame], hashed: bool = False):
        self.table = table          # (src, salt, dst, weight), hash-partitioned on (src, salt)
        self.hot = hot              # (src, n_salt) for hot sources (< 2n rows), None if none
        self.sources = sources      # (src) distinct sources
        self.num_partitions = num_partitions
        self.hashed = hashed        # a partition's ranks are few enough for a hash table
        self._cached = cached

    def release(self) -> None:
        for df in self._cached:
            df.unpersist()


EDGES_PER_PARTITION = 250_000
#: distinct edges a partition, and so sources at most, up to which its ranks are hashed
HASHED_EDGES = 2_000_000


def edge_partitions(spark, distinct_edges: int) -> int:
    """Partitions for the edge table: about ``EDGES_PER_PARTITION`` distinct edges each, so the
    count grows with the graph; at least the session's parallelism and shuffle partitions
    (a join would deal a table with fewer partitions anew)."""
    return max(shuffle_partitions(spark), spark.sparkContext.defaultParallelism, math.ceil(distinct_edges / EDGES_PER_PARTITION))


def _distinct_edges(edges: DataFrame) -> DataFrame:
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("mult"))


def _degrees(dedup: DataFrame) -> DataFrame:
    return dedup.groupBy("src").agg(F.sum("mult").alias("out_degree"), F.count(F.lit(1)).alias("fanout"))


def _sizes(degree: DataFrame) -> tuple[int, int]:
    """Distinct edges and the largest fan-out."""
    edges, fanout = degree.agg(F.sum("fanout"), F.max("fanout")).first()
    return edges or 0, fanout or 0


def salted_edges(edges: DataFrame, num_partitions: int | None = None,
                 hot_threshold: int | None = None, dedup: DataFrame | None = None,
                 sizes: tuple[int, int] | None = None, sum_partitions: int | None = None):
    """De-duplicate and salt an edge multiset.

    Returns ``(table, hot, degree)``: ``table`` is ``(src, salt, dst, mult, out_degree)``
    hash-partitioned on ``(src, salt)``, or on ``src`` without hot sources; ``hot`` is ``(src, n_salt, hot_degree)`` for the
    hot sources; ``degree`` is ``(src, out_degree, fanout)``.

    A source whose fan-out (distinct destinations) exceeds ``hot_threshold`` is *hot*:
    its edges are spread over ``ceil(fanout / hot_threshold)`` salts by destination
    hash, so no partition holds more than about ``hot_threshold`` of its edges. The
    default threshold ``ceil(R / (2n))`` (``R`` distinct edges, ``n`` partitions)
    guarantees fewer than ``2n`` hot sources, which bounds every broadcast of ``hot``.
    ``dedup`` and ``sizes`` (distinct edges, largest fan-out) are given if they are there;
    without hot sources the degrees are summed in ``sum_partitions`` (default ``n``).
    """
    spark = edges.sparkSession
    if dedup is None:
        dedup = _distinct_edges(edges)
    degree = _degrees(dedup)
    distinct_edges, max_fanout = sizes or _sizes(degree)
    n = num_partitions or edge_partitions(spark, distinct_edges)
    if hot_threshold is None:
        hot_threshold = max(1, math.ceil(distinct_edges / (2 * n)))
    if max_fanout <= hot_threshold:
        # no hot source: one salt for everyone, nothing to broadcast, and a source's edges
        # are together anyway; a null source joins with no rank, as in the join below
        table = (dedup.where(F.col("src").isNotNull()).repartition(sum_partitions or n, "src")
                 .withColumn("out_degree", F.sum("mult").over(Window.partitionBy("src")))
                 .select("src", F.lit(0).alias("salt"), "dst", "mult", "out_degree"))
        return table, None, degree
    # Fewer than 2n rows with the default threshold (each has > R / 2n distinct edges); a
    # smaller threshold makes more, and Catalyst then chooses the join by their size.
    bounded = hot_threshold >= math.ceil(distinct_edges / (2 * n))
    hot = degree.where(F.col("fanout") > hot_threshold).select(
        "src", F.col("out_degree").alias("hot_degree"),
        F.ceil(F.col("fanout") / F.lit(hot_threshold)).cast("int").alias("n_salt"))
    marked = dedup.join(F.broadcast(hot) if bounded else hot, "src", "left")
    hot_edges = marked.where(F.col("hot_degree").isNotNull()).select(
        "src", F.pmod(F.xxhash64("dst"), F.col("n_salt")).cast("int").alias("salt"), "dst", "mult",
        F.col("hot_degree").alias("out_degree"))
    # cold sources have at most hot_threshold distinct edges: a plain shuffle join is even
    cold_edges = (
        marked.where(F.col("hot_degree").isNull())
        .join(degree.select("src", "out_degree"), "src")
        .select("src", F.lit(0).alias("salt"), "dst", "mult", "out_degree")
    )
    table = hot_edges.unionByName(cold_edges).repartition(n, "src", "salt")
    return table, hot, degree


def weighted_edges(edges: DataFrame, num_partitions: int | None = None,
                   persist: bool = True, hot_threshold: int | None = None) -> PreparedEdges:
    """Cached ``(src, salt, dst, weight)`` with ``weight = multiplicity / out_degree``
    (see :func:`salted_edges`)."""
    spark = edges.sparkSession
    level = StorageLevel.MEMORY_AND_DISK
    dedup = _distinct_edges(edges)
    if persist:  # the edges are derived once; held until the table is there
        dedup = dedup.persist(level)
    sizes = _sizes(_degrees(dedup))
    n = num_partitions or edge_partitions(spark, sizes[0])
    full, hot, degree = salted_edges(edges, n, hot_threshold, dedup, sizes, None if persist else n + 1)
    table = full.select("src", "salt", "dst", (F.col("mult") / F.col("out_degree")).alias("weight"))
    sources = degree.select("src")
    cached: list[DataFrame] = []
    if persist:
        with _cache_keeps_partitioning(spark):
            table = table.persist(level)
        sources = sources.persist(level)
        hot = None if hot is None else hot.select("src", "n_salt").persist(level)
        cached = [table, sources] if hot is None else [table, sources, hot]
        for df in cached:
            df.count()
        dedup.unpersist()
    elif hot is None:
        # the last step is an exchange, which the passes reuse; into as many partitions as the sum
        # it would be dropped as redundant, and every pass would sort and sum anew
        table = table.repartition(n, "src")
    return PreparedEdges(table, None if hot is None else hot.select("src", "n_salt"), sources, n, cached,
                         hashed=sizes[0] <= n * HASHED_EDGES)


def expand_ranks(ranks: DataFrame, hot: DataFrame | None) -> DataFrame:
    """One rank row per salt of its source (hot sources get several)."""
    if hot is None:
        return ranks.select("src", "rank", F.lit(0).alias("salt"))
    return ranks.join(hot.select("src", "n_salt"), "src", "left").select(
        "src", "rank",
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("n_salt"), F.lit(1)) - 1)).alias("salt"))


def join_ranks_salted(table: DataFrame, ranks: DataFrame, hot: DataFrame | None, hashed: bool = False) -> DataFrame:
    """Skew-safe edge-rank join: salted edges meet the salt-expanded rank rows, of which each
    task builds a hash table if ``hashed`` (else both sides are sorted)."""
    side = (lambda df: df.hint("shuffle_hash")) if hashed else (lambda df: df)
    if hot is None:  # a constant salt would be folded away, and with it the table's partitioning
        return table.join(side(ranks.select("src", "rank")), "src")
    return table.join(side(expand_ranks(ranks, hot)), ["src", "salt"])


def _pass(prepared: PreparedEdges, ranks: DataFrame, d: float) -> DataFrame:
    """One pass; ``ranks`` is referenced once, so unrolled passes grow the plan linearly."""
    contribs = join_ranks_salted(prepared.table, ranks, prepared.hot, prepared.hashed).select(
        "dst", (F.col("rank") * F.col("weight")).alias("contribution"))
    return contribs.groupBy("dst").agg(
        (F.lit(1.0 - d) + F.lit(d) * F.sum("contribution")).alias("rank")
    ).withColumnRenamed("dst", "src")


def pagerank(edges: DataFrame, d: float = 0.85, epochs: int = 10,
             num_partitions: int | None = None, persist: bool = True,
             checkpoint_every: int | None = None, hot_threshold: int | None = None) -> DataFrame:
    """Iterate contributions -> damped sum ``epochs`` times; returns ``(id, rank)``.

    ``epochs = 0`` returns the initial ranks. The rank table is cut from its lineage
    with a reliable checkpoint every ``checkpoint_every`` passes (the plan would
    otherwise grow by one join and one aggregation per pass; a checkpoint also bounds
    the recomputation after a lost executor). Default: every 3 passes with cached
    edges, every 10 without: each checkpoint job would re-derive uncached edges, while
    one unrolled plan shares that derivation through exchange reuse (measured faster).
    """
    if checkpoint_every is None:
        checkpoint_every = 3 if persist else 10
    spark = edges.sparkSession
    checkpoint_root(spark)
    prepared = weighted_edges(edges, num_partitions, persist, hot_threshold)
    ranks = prepared.sources.withColumn("rank", F.lit(1.0).cast("double"))
    for epoch in range(1, epochs + 1):
        ranks = _pass(prepared, ranks, d)
        if checkpoint_every and epoch % checkpoint_every == 0 and epoch != epochs:
            ranks = ranks.checkpoint(eager=True)
    if persist and epochs:
        # the result must not hold on to the cached edges: cut it off, then free them
        ranks = ranks.checkpoint(eager=True)
        prepared.release()
    return ranks.withColumnRenamed("src", "id")
