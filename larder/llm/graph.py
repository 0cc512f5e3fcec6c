"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import staged


def few(df: DataFrame, rows: int, each: int = 1 << 14) -> DataFrame:
    """``df`` in no more tasks than its rows need, ``rows`` being a measured bound: hundreds of tasks with a row or two cost seconds each time."""
    return df.coalesce(max(1, -(-rows // each)))


def components(edges: DataFrame, broadcast_ids: int = 2_000_000) -> DataFrame:
    """``(id, component)`` of every node of ``edges (a, b)``: the smallest id it is connected with.

    Labels go to the neighbours and then jump to the label of their label, so a chain of n nodes takes about
    log n rounds. Each round is written to the shared folder, which cuts the lineage. Labels of up to
    ``broadcast_ids`` nodes are sent to the links instead of shuffling both.
    """
    n = 2 * edges.count()
    links = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = staged(few(links.filter("a <> b").distinct(), n), "links")
    labels = staged(few(links.groupBy("a").agg(F.min(F.least("a", "b")).alias("l")), n).withColumnRenamed("a", "v"), "labels")
    small = labels.count() <= broadcast_ids
    while True:
        sent = F.broadcast(labels) if small else labels
        near = links.join(sent, links["b"] == sent["v"]).select("a", "l", F.lit(None).cast("bigint").alias("old"))
        own = labels.select(F.col("v").alias("a"), "l", F.col("l").alias("old"))
        lower = near.union(own).groupBy("a").agg(F.min("l").alias("l"), F.max("old").alias("old"))
        roots = sent.select(F.col("v").alias("r"), F.col("l").alias("rl"))
        jumped = lower.join(F.broadcast(roots) if small else roots, lower["l"] == roots["r"], "left")
        after = staged(few(jumped.select(F.col("a").alias("v"), "old", F.least("l", "rl").alias("l")), n), "labels")
        changed = after.filter("l <> old").limit(1).count()
        labels = after.select("v", "l")
        if not changed:
            return labels.select(F.col("v").alias("id"), F.col("l").alias("component"))
