"""Merkle manifest of a dataset by slot pivots: digests of rows, groups and the whole table,
and the proof that a row belongs to them.

1. Rows are placed: range partitions by (group, order), written sorted; counts per file and
   group give every row its position in its group. No window sees a whole group.
2. A level groups nodes by (group, position div ``FANOUT``). Conditional aggregates spread the
   children into one column a slot; their concatenation is hashed into the parent. A hot
   group is many small parents, and partial aggregation leaves about one row a parent.
3. Groups' roots are placed and pivoted likewise, up to the root.
4. Proofs go down: a parent's row is turned back into its children, each with the
   concatenated slots left and right of its own. The steps above a parent are carried once a
   parent, and the last level hashes them without another exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.store import written

FANOUT = 16
_STEP = "array<struct<before: string, after: string>>"
_FILE_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def field(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 (lowercase hex) of a row's fields."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def group_key(group: Column) -> Column:
    """A never-null key in the order of ``group``: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def placed(rows: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``rows`` (with a key ``g``) with ``pos``, their 0-based position in ``g`` by ``order``, and
    ``n``, the rows of ``g``. Rows equal in all of ``order`` are spread by their place in the input."""
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange("g", *order, "_tie").sortWithinPartitions("g", *order).drop("_tie")
    kept = written(ranged.withColumn("_mid", F.monotonically_increasing_id()), name)
    kept = kept.withColumn("_file", F.shiftright("_mid", _FILE_BITS))
    runs = kept.groupBy("_file", "g").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    mine = Window.partitionBy("g")  # at most one row a file
    before = F.sum("_rows").over(mine.orderBy("_file")) - F.col("_rows")
    runs = runs.select("_file", "g", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(mine).alias("n"))
    return kept.join(runs, ["_file", "g"]).withColumn("pos", F.col("_mid") + F.col("_shift")).drop("_file", "_mid", "_shift")


def _pivot(nodes: DataFrame, payload: Sequence[str]) -> DataFrame:
    """(g, pos, n, s0 ..., digest): the parents of ``nodes`` (g, pos, n, digest, payload), ``n`` being
    the nodes of the group below them. A group's single node is passed on as it is."""
    cell = f"struct({', '.join(['digest', *payload])})"
    spread = [F.expr(f"max(if(pmod(pos, {FANOUT}) = {k}, {cell}, null)) AS s{k}") for k in range(FANOUT)]
    parents = nodes.groupBy("g", F.expr(f"pos div {FANOUT} AS pos")).agg(F.max("n").alias("n"), *spread)
    return parents.selectExpr("*", f"if(n > 1, sha2(concat_ws('', {_slots(range(FANOUT))}), 256), s0.digest) AS digest")


def _slots(slots: Sequence[int]) -> str:
    return ", ".join(f"s{k}.digest" for k in slots) or "''"


def _up(nodes: DataFrame, payload: Sequence[str], name: str) -> list[DataFrame]:
    """The levels of pivots over ``nodes``, leaves' parents first; the last has one row a group."""
    levels = []
    while True:
        levels.append(written(_pivot(nodes, payload), f"{name}-level"))
        if levels[-1].where(f"n > {FANOUT}").isEmpty():
            return levels
        payload = ()
        nodes = levels[-1].selectExpr("g", "pos", f"(n + {FANOUT - 1}) div {FANOUT} AS n", "digest")


def _down(parents: DataFrame, above: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """One row a child: (g, pos, digest, payload, above, steps), the child's own step put before
    its parent's ``steps``."""
    more = "".join(f", s{{k}}.{c} AS {c}" for c in payload)

    def child(k: int) -> str:
        own = f"array(struct(concat_ws('', {_slots(range(k))}) AS before, concat_ws('', {_slots(range(k + 1, FANOUT))}) AS after))"
        return (f"if(s{k} IS NULL, null, struct(pos * {FANOUT} + {k} AS pos, s{k}.digest AS digest{more.format(k=k)}, "
                f"if(n > 1, {own}, cast(array() AS {_STEP})) AS step))")

    kids = f"explode(array_compact(array({', '.join(child(k) for k in range(FANOUT))}))) AS _kid"
    rows = parents.selectExpr("g", *above, "steps AS _up", kids)
    return rows.selectExpr("g", *above, *[f"_kid.{c}" for c in ("pos", "digest", *payload)], "concat(_kid.step, _up) AS steps")


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and the siblings of its way up give."""
    return F.aggregate(steps, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def proof_digest(steps: Column) -> Column:
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def manifest(rows: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """The manifest of ``rows``, (g, key, leaf, payload): ``g`` is a never-null text key
    (``group_key``), ``key`` the order inside a group (nulls first, equal keys by leaf).

    One row per input row: (g, key, leaf, payload, subroot, root, steps); ``steps`` lists, from
    the leaf to the root, the siblings ``before`` and ``after`` the node, hex digests
    concatenated. Per group and then over the groups in the order of ``g``, every ``FANOUT``
    consecutive nodes become one until one is left. Repeated rows are leaves of their own;
    equal ones may change places, which changes no digest. An empty table has no row and
    no root.
    """
    payload = ["key", *payload]
    leaves = placed(rows.select("g", F.col("leaf").alias("digest"), *payload), [F.col("key"), F.col("digest")], "leaves")
    levels = _up(leaves, payload, "leaf")
    tops = levels[-1].select(F.lit(0).alias("one"), "g", "digest")
    # the groups are the leaves of the upper tree: its only group is 0
    roots = placed(tops.select(F.lit("").alias("g"), F.col("g").alias("of"), "digest"), [F.col("of")], "roots")
    upper = _up(roots, ["of"], "root")
    none = F.array().cast(_STEP)
    here = upper[-1].select("*", F.col("digest").alias("root"), none.alias("steps"))
    for below in reversed(upper[:-1]):
        kids = _down(here, ["root"], []).drop("digest")
        here = below.join(kids, ["g", "pos"])
    subroots = _down(here, ["root"], ["of"]).select(F.col("of").alias("g"), F.lit(0).cast("bigint").alias("pos"), F.col("digest").alias("subroot"), "root", "steps")
    here = levels[-1].join(written(subroots, "subroots"), ["g", "pos"])
    for below in reversed(levels[:-1]):
        kids = _down(here, ["subroot", "root"], []).drop("digest")
        here = below.join(kids, ["g", "pos"])
    return _down(here, ["subroot", "root"], payload).withColumnRenamed("digest", "leaf").drop("pos")


def tampered_documents(docs: DataFrame) -> DataFrame:
    """Every document's place in the manifest of ``documents`` and whether its proof still holds
    after a change: (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified).

    A leaf is the digest of doc_id, source, lang, n_chars and text, nulls included; sources are
    the groups, null first. Where 5 divides crc32 of the decimal doc_id the text's A-Z are
    lower-cased before the proof is folded; a null doc_id is not changed, a null text stays.
    Texts are hashed whole, whatever their length; other columns are not read, an empty
    table gives no rows.
    """
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    rows = docs.select(group_key(F.col("source")).alias("g"), F.col("doc_id").alias("key"), leaf_digest([*head, F.col("text")]).alias("leaf"),
                       F.when(chosen & (low != F.col("text")), leaf_digest([*head, low])).alias("changed"))
    found = manifest(rows, ["changed"])
    root_now = folded(F.coalesce("changed", "leaf"), F.col("steps"))
    return found.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("steps")).alias("proof_sha256"),
                        root_now.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
