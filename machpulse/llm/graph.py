"""Connected components of a stored graph."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from machpulse.sources.storage import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``a, b``): the smallest node that can be reached.

    Each round every node takes the smallest label among its neighbours' and its own, then the label of that label,
    so long chains shorten to a half. The rounds end when no label changes; every round is a written table.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    both = stored(both.filter("node != other").distinct(), "component-links")
    labels = stored(
        both.groupBy("node").agg(F.min("other").alias("_o")).select("node", F.least("node", "_o").alias("component")), "component-labels"
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), F.col("component").alias("_c")), "other")
        lowest = near.groupBy("node").agg(F.min("_c").alias("_low"))
        moved = labels.join(lowest, "node").select("node", F.col("component").alias("_was"), F.least("component", "_low").alias("_new"))
        roots = labels.select(F.col("node").alias("_new"), F.col("component").alias("_root"))
        jumped = stored(
            moved.join(roots, "_new", "left").select("node", "_was", F.least("_new", F.coalesce("_root", "_new")).alias("component")),
            "component-labels",
        )
        labels = jumped.select("node", "component")
        if jumped.filter("component != _was").isEmpty():
            return labels
