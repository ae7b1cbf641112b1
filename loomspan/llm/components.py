"""Connected components of links by joins: smallest label among neighbours, then the label's own label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node of links (a, b).

    Each round joins the links with the labels and takes the smallest (partial
    aggregation comes before the shuffle, so a node with very many links is no
    hot spot), then follows labels one step, which shortens chains by powers of
    two.  Each round's labels are a table in the shared folder.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).select(F.col("a").alias("node"), "component"), "labels")
    while True:  # some label falls in each round, and chains shorten by powers of two
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("least"))
        low = labels.join(near, F.col("node") == F.col("a")).select("node", "component", F.least("component", "least").alias("low"))
        up = labels.select(F.col("node").alias("n2"), F.col("component").alias("c2"))
        new = stored(low.join(up, F.col("low") == F.col("n2")).select("node", F.least("low", "c2").alias("component"), (F.least("low", "c2") < F.col("component")).alias("changed")), "labels")
        labels = new.select("node", "component")
        if not new.where("changed").limit(1).count():
            return labels
