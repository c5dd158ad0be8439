"""Connected components of an edge table, with no vertex's neighbours in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stored


def components(edges: DataFrame, name: str) -> DataFrame:
    """v, root: the least vertex that v is linked with.  edges: a, b (long).  Vertices without an edge don't appear.

    Rounds of two steps.  Every vertex hands the least of its neighbours and itself to its neighbours, which combines
    before the shuffle; then labels are followed once more, so distances shrink at least by half in each round.
    """
    both = stored(edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select("b", "a")).distinct(), f"{name}-edges")
    labels = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("root")), f"{name}-labels", light=True)
    while True:
        near = both.join(labels, both.b == labels.v).select(F.col("a").alias("v"), "root", F.lit(None).cast("long").alias("old"))
        mine = near.unionByName(labels.select("v", "root", F.col("root").alias("old"))).groupBy("v").agg(F.max("old").alias("old"), F.min("root").alias("root"))
        # a label is a vertex too: what its holders have learnt is handed to it, and all follow it once
        learnt = mine.groupBy(F.col("old").alias("v")).agg(F.min("root").alias("hint"))
        mine = mine.join(learnt, "v", "left").select("v", "old", F.least("root", F.coalesce("hint", "root")).alias("root"))
        step = stored(mine, f"{name}-step", light=True)
        up = step.select(F.col("v").alias("u"), F.col("root").alias("up"))
        new = stored(step.join(up, step.root == up.u, "left").select("v", "old", F.least("root", F.coalesce("up", "root")).alias("root")), f"{name}-labels", light=True)
        dropped(step, labels)
        labels = new.select("v", "root")
        labels._scratch = new._scratch
        if not new.filter("old <> root").limit(1).count():
            dropped(both)
            return labels
