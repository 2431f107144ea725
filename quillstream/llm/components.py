"""Connected components of links, in DataFrame operations; nothing is collected but a count per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import core


def components(links: DataFrame) -> DataFrame:
    """(v, label) for every end of a link (x, y): label is the smallest id reachable.

    Each round takes the least label among neighbours (an aggregate with map-side combining, so a hub is no hot spot), then
    jumps to the label's own label, which halves the depth of what is left. Every round is written to the shared folder.
    """
    links = core.written(links.select("x", "y").where("x <> y").distinct())
    ends = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    after = core.written(ends.groupBy(F.col("x").alias("v")).agg(F.min("y").alias("label")).select("v", F.least("v", "label").alias("label"), F.lit(True).alias("moved")))
    while after.where("moved").limit(1).count():
        last, labels = after, after.select("v", "label")
        near = ends.join(labels, ends["y"] == labels["v"]).groupBy("x").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels["v"] == near["x"]).select("v", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        own = labels.select(F.col("v").alias("of"), F.col("label").alias("jump"))
        jumped = lower.join(own, lower["label"] == own["of"], "left").withColumn("label", F.least("label", F.coalesce("jump", "label")))
        after = core.written(jumped.select("v", "label", (F.col("label") < F.col("old")).alias("moved")))
        core.dropped(last)
    core.dropped(links)
    labels = after.select("v", "label")
    labels._written = after._written
    return labels
