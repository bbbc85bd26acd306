"""Connected components of a table of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm import _shared


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b), root being the smallest node of its component.

    Each round gives a node the smallest label among its own and its neighbours', then the label of its label; labels only fall, and
    rounds end when none does. A node with many links is pre-aggregated before its rows move.
    """
    both = _shared.settle(links.select(F.col("a").alias("node"), F.col("b").alias("next")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("next"))).distinct(), "links")
    labels = _shared.settle(both.groupBy("node").agg(F.least(F.min("next"), F.min("node")).alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("next"), "root"), "next").groupBy("node").agg(F.min("root").alias("near"))
        step = labels.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("to"))
        new = _shared.settle(step.join(jump, "root").select("node", "was", F.least("root", "to").alias("root")), "labels")
        changed = new.where("root < was").limit(1).count()
        _shared.unsettle(labels)
        labels = new.select("node", "root")
        if not changed:
            _shared.unsettle(both)
            return labels
