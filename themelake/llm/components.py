"""Connected components of a link table, by label passing with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, landed


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Links between numbers -> (node, component), the component being the smallest node reachable.

    Every round a node takes the smallest label next to it, then the label of
    its label, so long chains shrink geometrically. Labels of a hub with many
    links are folded in the map tasks. Nodes without links do not appear. Rounds
    end when no label changes; only that count reaches the driver.
    """
    spark, spent = links.sparkSession, []
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    edges = landed(edges.unionAll(edges.select("b", "a")).distinct(), "edges", spent=spent)
    labels = edges.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("component"))
    last: list[str] = []
    labels = landed(labels, "labels", spent=last)
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        hooked = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("component").alias("root"))
        moved = hooked.join(jump, "low").select(
            "node", F.least("low", "root").alias("component"), (F.least("low", "root") < F.col("component")).alias("changed")
        )
        this: list[str] = []
        moved = landed(moved, "labels", spent=this)
        forget(spark, *last)  # the labels before these
        labels, last = moved.select("node", "component"), this
        if moved.where("changed").isEmpty():
            forget(spark, *spent)
            return labels
