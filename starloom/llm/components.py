"""Connected components of a table of links, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import store


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b); label is the smallest node of its component.

    Each turn takes the smallest label among a node's neighbours and then follows labels one step
    (pointer jumping), so the number of turns grows with the logarithm of a component's diameter.  Labels
    are written after each step: the joins are between plain tables, whose frequent keys AQE can split.
    """
    both = store(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        step = store(labels.join(near, F.col("node") == F.col("a"), "left")
                     .select("node", F.least("label", F.coalesce("near", "label")).alias("label"), F.col("label").alias("old")), "labels")
        jump = step.select(F.col("node").alias("n2"), F.col("label").alias("l2"))
        new = store(step.join(jump, F.col("label") == F.col("n2"), "left")
                    .select("node", F.least("label", F.coalesce("l2", "label")).alias("label"), "old"), "labels")
        changed = new.filter("label <> old").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
