"""Connected components of links between documents, without collecting any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import scratch_path


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``links(a, b)``.

    Alternating large-star and small-star steps: each joins a node's neighbours
    to the smallest of them, so components shrink to stars in a logarithmic
    number of rounds.  Every round is a written table, which cuts the lineage
    and survives lost executors.  A node with very many neighbours never meets
    them in one task: minima are aggregated, and joined back.
    """
    spark = links.sparkSession

    def store(edges: DataFrame) -> DataFrame:
        path = scratch_path(spark, name)
        edges.write.parquet(path)
        return spark.read.parquet(path)

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both if large else both.where("b < a")
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = near.join(least, "a")
        kept = joined.where("b > a") if large else joined
        moved = kept.select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            moved = moved.union(least.select("a", F.col("m").alias("b")))
        return moved.where("a <> b").distinct()

    def mark(edges: DataFrame):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = store(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = mark(edges)
    while True:
        edges = store(star(star(edges, True), False))
        after = mark(edges)
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = after
