"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vejrkraft.llm.steps import Steps


def components(links: DataFrame, steps: Steps | None = None) -> DataFrame:
    """``id`` and ``label`` (the smallest id of its component) of every id in ``links`` (a, b).

    Alternates two steps that keep components whole: every node's larger neighbours are linked to its
    smallest one, then its smaller neighbours are. Hubs are halved each time, and the smallest
    neighbour is found by partial aggregation, so a node with very many links is no single task.
    """
    forward = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    steps = steps or Steps(links.sparkSession)
    edges = steps.write(forward.distinct())
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = steps.write(small.where("a <> b").unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("label"))
    return edges.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(roots)
