"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.storage import discard, stored


def connected(links: DataFrame) -> DataFrame:
    """node and label of every node of links (a, b long): the smallest node that it reaches.

    Labels spread along links and then to the label of the label, so that a path of n nodes takes about log(n) rounds, each
    a written table; nothing but a count reaches the driver.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        low = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        far = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        new = stored(low.join(far, "low").select("node", F.col("label").alias("old"), F.least("low", "far").alias("label")), "labels")
        discard(labels)
        if new.where("old != label").isEmpty():
            discard(both)
            return new.select("node", "label")
        labels = new.select("node", "label")
