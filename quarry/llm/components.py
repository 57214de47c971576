"""Connected components of an edge table by repeated least-label propagation with pointer
jumping; every round is a written table, nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.store import written


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every vertex of ``edges`` (a, b): the least id reachable.

    A round takes the least label among a vertex and its neighbours (map-side combined, so
    a hub is no hot group) and then the label of that label; paths shorten by half or
    more. Rounds end when no label changes. An empty table gives no rows.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select(
        "id", F.least("id", "m").alias("component"))
    while True:
        offers = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(
            F.min("component").alias("offer"))
        hooked = labels.join(offers, "id").select("id", F.col("component").alias("old"), F.least("component", "offer").alias("to"))
        target = labels.select(F.col("id").alias("to"), F.col("component").alias("further"))
        labels = written(hooked.join(target, "to").select(
            "id", F.least("to", "further").alias("component"), (F.least("to", "further") < F.col("old")).alias("moved")), "labels")
        if labels.where("moved").isEmpty():
            return labels.select("id", "component")
        labels = labels.drop("moved")
