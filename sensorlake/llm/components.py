"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.common import materialise


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node reachable) for every node of ``links`` (columns ``x``, ``y``).

    In each round a node takes the smallest label among its neighbours' and its
    own, then the label of that label, until nothing changes; the number of
    rounds follows the logarithm of a component's diameter in practice.  Rounds
    are written to the shared folder.
    """
    both = materialise(links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "links")
    labels = both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("y")).select("node", F.least("node", "y").alias("label"))
    labels = materialise(labels, "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("y"), F.col("label").alias("theirs")), "y").groupBy("x").agg(F.min("theirs").alias("theirs"))
        lower = labels.join(near, F.col("node") == F.col("x")).select("node", F.least("label", "theirs").alias("next"), F.col("label").alias("was"))
        lower = materialise(lower, "labels")
        jump = lower.select(F.col("node").alias("at"), F.col("next").alias("further"))
        new = lower.join(jump, F.col("next") == F.col("at")).select("node", F.least("next", "further").alias("label"), "was")
        new = materialise(new, "labels")
        labels = new.select("node", "label")
        if new.filter("label != was").isEmpty():
            return labels
