"""Adapters from the given Parquet tables to the inputs the jobs expect.

Each function reads whole tables from ``sf_dir`` and derives its input with Spark, so
the work grows with the tables. The SQL twins live in :mod:`quarry.plans.oracles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_mod
from quarry.operators.indexing import assign_split, global_index, lead_in_group


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------------------- graphs

def g_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part-to-next-part edges inside each order (ordered by line number, part key).

    The successor comes from a window per order, except for orders so large that one
    task would hold too much of the table: those are spread over many tasks by global
    positions and a positional join (:func:`lead_in_group`).
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    nxt = lead_in_group(li, "l_orderkey", ["l_linenumber", "l_partkey"], "l_partkey", out="_next")
    return nxt.where(F.col("_next").isNotNull()).select(
        F.col("l_partkey").cast("string").alias("src"), F.col("_next").cast("string").alias("dst"))


def g_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed graph with pure sources and pure sinks.

    ``P<part> -> P<next part>`` chain edges, ``S<supplier> -> P<part>`` for every line
    (suppliers never receive), and ``P<first part> -> C<customer>`` per order
    (customers never give).
    """
    li = table(spark, sf_dir, "lineitem")
    chain = g_chain(spark, sf_dir).select(
        F.concat(F.lit("P"), "src").alias("src"), F.concat(F.lit("P"), "dst").alias("dst"))
    supply = li.select(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("src"),
                       F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("dst"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    buyer = (
        li.where(F.col("l_linenumber") == 1)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("src"),
                F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("dst"))
    )
    return chain.unionByName(supply).unionByName(buyer)


def g_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (customer name, nation name) string edges."""
    c = table(spark, sf_dir, "customer").select("c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_name").alias("src"), F.col("n_name").alias("dst"))
        .distinct()
    )


def g_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``G_chain`` rendered as edge-list text with varied whitespace, extra tokens,
    comment lines and malformed lines; the style comes from a seeded hash."""
    e = g_chain(spark, sf_dir)
    s = F.concat(F.lit("P"), "src")
    t = F.concat(F.lit("P"), "dst")
    style = hash_mod(10, 7, F.col("src"), F.col("dst"))
    line = (
        F.when(style == 0, F.concat_ws("\t", s, t))
        .when(style == 1, F.concat(s, F.lit("   "), t))
        .when(style == 2, F.concat(s, F.lit(" "), t, F.lit(" w="), F.col("src")))
        .when(style == 3, F.concat(s, F.lit("\t \t"), t, F.lit("\t")))
        .when(style == 4, F.concat(F.lit(" "), s, F.lit(" "), t))
        .when(style == 5, s)
        .when(style == 6, F.concat(F.lit("# "), s, F.lit(" "), t))
        .when(style == 7, F.concat(s, F.lit(" ")))
        .otherwise(F.concat(s, F.lit(" "), t))
    )
    return e.select(line.alias("value"))


# ----------------------------------------------------------------------------- sort

def t_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an all-text table with ``cca2`` and ``timestamp`` keys.

    ``cca2`` is the order priority, null for pending orders; ``timestamp`` is the
    order day as unpadded day-number text (4 and 5 digits, so text order differs
    from numeric order).
    """
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("cca2"),
        F.datediff(F.to_date("o_orderdate"), F.lit("1970-01-01").cast("date")).cast("string").alias("timestamp"),
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        F.col("o_orderstatus"),
    )


SORT_KEYS = ["cca2", "timestamp", "o_orderkey"]


# ------------------------------------------------------------------------ rows/batches

def b_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")


# --------------------------------------------------------------------------- vectors

def x_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as ``(vec_id, features array<double>, label)`` with a stable split
    (60 % train, 20 % validation, 20 % test)."""
    e = table(spark, sf_dir, "embeddings")
    df = e.select("vec_id", F.col("embedding").cast("array<double>").alias("features"), "label")
    return assign_split(df, "vec_id", (60, 20, 20), seed=42)


def x_img(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 64 embedding values as a raw 8x8 RGB image (flat, H x W x C ints 0..255): a pixel's
    three channels are its value, the negative value and half the value."""
    e = table(spark, sf_dir, "embeddings")

    def channel(x, factor):
        return F.least(F.greatest(F.floor((x.cast("double") * factor + 1.0) * 127.5), F.lit(0)), F.lit(255)).cast("int")

    cells = F.flatten(F.transform("embedding", lambda x: F.array(*[channel(x, f) for f in (1.0, -1.0, 0.5)])))
    image = F.struct(F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(3).alias("channels"), cells.alias("cells"))
    return e.select(F.col("vec_id").alias("id"), image.alias("pixels"), "label")


# ---------------------------------------------------------------------------- text

#: labels (16 bytes each) that are sent to the documents' scan; more are joined
SENT_LABELS = 2_000_000


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(idx, label)``, to be sent to the texts where the table is small enough: a join would move
    every text."""
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("idx"), F.col("quality").alias("label"))
    return F.broadcast(lab) if lab.count() <= SENT_LABELS else lab


def s_sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled sentences ``(idx, sentence, label)`` = documents joined to labels,
    with a stable split (80/10/10 by ``idx``)."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("idx"), F.col("text").alias("sentence"))
    df = d.join(_quality(spark, sf_dir), "idx").select("idx", "sentence", "label")
    return assign_split(df, "idx", (80, 10, 10), seed=42)


def s_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as ``(idx, sentence, label)``; the label is null where there is none."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("idx"), F.col("text").alias("sentence"))
    return d.join(_quality(spark, sf_dir), "idx", "left")


# ------------------------------------------------------------------------ telemetry

def l_tele(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as per-batch training telemetry.

    ``epoch = user_id % 3 + 1``; ``batch_idx`` = position by ``(ts, event_id)`` inside
    the epoch (global position minus the epoch's first position: no per-epoch window);
    ``loss = value``, ``accuracy = props.k / 100``, ``duration = value / 10``.
    """
    ev = table(spark, sf_dir, "events")
    base = ev.select(
        (F.pmod(F.col("user_id"), F.lit(3)) + 1).cast("int").alias("epoch"),
        "ts", "event_id",
        F.col("value").alias("loss"),
        (F.get_json_object("props", "$.k").cast("double") / 100.0).alias("accuracy"),
        (F.col("value") / 10.0).alias("duration"),
    )
    ranked = global_index(base, ["epoch", "ts", "event_id"], pos="_p")
    # One row per epoch: bounded by the number of epochs.
    starts = ranked.groupBy("epoch").agg(F.min("_p").alias("_p0"))
    return (
        ranked.join(F.broadcast(starts), "epoch")
        .select("epoch", (F.col("_p") - F.col("_p0")).cast("int").alias("batch_idx"),
                "event_id", "loss", "accuracy", "duration")
    )
