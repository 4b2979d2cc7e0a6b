"""Connected components of a graph in tables: least labels spread along edges and jump to their own labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridloom.llm.session import materialize, release


def components(edges: DataFrame) -> DataFrame:
    """(v, label): for every end of an edge (a, b) the least vertex that it is connected with.

    Each round takes the least label among a vertex's neighbours, pre-aggregated before the shuffle, then the
    label of that label; the rounds grow with the logarithm of the longest path. Rounds are written to the shared
    folder, so a lost executor costs one round's tasks.
    """
    edges = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    written = materialize(edges.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        labels = written.select("v", "label")
        near = edges.join(labels, edges["b"] == labels["v"]).groupBy(F.col("a").alias("w")).agg(F.min("label").alias("near"))
        hooked = materialize(labels.join(near, labels["v"] == near["w"]).select("v", F.col("label").alias("old"), F.least("label", "near").alias("label")), "hooked")
        up = hooked.select(F.col("v").alias("u"), F.col("label").alias("up"))
        jumped = materialize(hooked.join(up, hooked["label"] == up["u"]).select("v", "old", F.least("label", "up").alias("label")), "labels")
        release(written, hooked)
        written = jumped
        if not jumped.filter("label < old").limit(1).count():
            release(edges)
            return jumped.select("v", "label")
