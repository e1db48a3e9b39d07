"""Connected components of a table of edges, with joins and checkpointed rounds."""

from pyspark.sql import DataFrame, functions as F

from oddspend.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node it is connected with, for every node of edges (a, b).

    Rounds of smallest-neighbour and pointer jumping: a node takes the smallest label beside
    it, then the label of that label. Each round is written, so a lost executor repeats one
    round at most; minima are partial aggregates, so nodes of any degree are no single task.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        beside = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        taken = labels.join(beside, labels["node"] == beside["a"]).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        # the node a label names has a label of its own, which may be smaller
        over = labels.select(F.col("node").alias("via"), F.col("label").alias("next"))
        jumped = taken.join(over, taken["label"] == over["via"], "left").select("node", "old", F.least("label", F.coalesce("next", "label")).alias("label"))
        jumped = materialize(jumped, "labels")
        labels = jumped.select("node", "label")
        if jumped.filter("label != old").isEmpty():
            return labels
