"""Connected components of a graph whose links are rows.

Every node takes the smallest label among itself and its neighbours, then the label of the node its label names
(pointer jumping), until nothing changes. Each round is an aggregate with map-side combining and two equi-joins
on unique labels, so no task sees a whole component; rounds follow the logarithm of a component's diameter in
practice. Each round is written to the shared folder, which cuts lineage and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import staged


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of all nodes in ``links`` (``a``, ``b``).

    Links count in both directions, repeated ones once. Nodes without a link are not in the result.
    """
    both = staged(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "labels")
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy(F.col("a").alias("at"))
            .agg(F.min("root").alias("lowest"))
        )
        lowered = labels.join(near, labels["node"] == near["at"], "left").select(
            "node", F.col("root").alias("old"), F.least("root", F.coalesce("lowest", "root")).alias("root")
        )
        lowered = staged(lowered, "labels")
        jump = lowered.select(F.col("node").alias("via"), F.col("root").alias("further"))
        labels = staged(
            lowered.join(jump, lowered["root"] == jump["via"], "left").select(
                "node", F.least("root", F.coalesce("further", "root")).alias("root"), "old"
            ),
            "labels",
        )
        if labels.where("root <> old").isEmpty():
            return labels.select("node", "root")
        labels = labels.select("node", "root")
