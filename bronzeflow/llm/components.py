"""Connected components of a link table, as rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzeflow.workspace import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links (a, b); label is the component's smallest node.

    Each round takes the smallest label among the neighbours and then that
    label's own label, so a chain halves its length. Rounds end when no label
    changed. Links with a null end are ignored; no links give no rows. A hub
    with very many links is reduced by map-side minima, and the joins are
    plain shuffle joins of written tables, which adaptive execution may split.
    """
    ends = links.select("a", "b").filter("a is not null and b is not null")
    both = materialize(ends.union(ends.select("b", "a")).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        stepped = materialize(
            labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("was")), "labels"
        )
        parent = stepped.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = materialize(
            stepped.join(parent, "label").select("node", F.least("label", "up").alias("label"), (F.least("label", "up") != F.col("was")).alias("moved")),
            "labels",
        )
        labels = jumped.select("node", "label")
        if jumped.filter("moved").isEmpty():
            return labels
