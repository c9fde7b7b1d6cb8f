"""Tags against a taxonomy: lookups, ancestors and deepest tags.

``nodes``: id, lang, name, synonyms, properties.  ``edges``: child, parent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import scratch_path


def lookup_tags(tagged: DataFrame, nodes: DataFrame, lang: str, tag: str = "tag") -> DataFrame:
    """Name, synonyms and properties of each tag; ``in_taxonomy`` flags unknown tags.

    A hash table per partition of ``nodes``: broadcast, they would all sit in
    every task, as text a hundred times their compressed size, and a merge would
    sort all rows of a common tag in one task.
    """
    known = nodes.filter(F.col("lang") == lang).select(
        F.col("id").alias("_id"), "name", "synonyms", "properties"
    ).hint("shuffle_hash")
    return (
        tagged.join(known, F.col(tag) == F.col("_id"), "left")
        .withColumn("in_taxonomy", F.col("_id").isNotNull())
        .drop("_id")
    )


def ancestors(edges: DataFrame) -> DataFrame:
    """All (node, ancestor) pairs of the graph.

    Each round joins the pairs found in the round before with all known pairs,
    so the length of the paths doubles, and stores what is new: the lineage stays
    short, diamonds or cycles add nothing twice, and it ends by itself.
    """
    spark = edges.sparkSession
    root = scratch_path(spark, "ancestors")
    base = edges.select(F.col("child").alias("node"), F.col("parent").alias("ancestor")).distinct()
    base.write.parquet(f"{root}/round=0")
    n = 1
    while True:
        last = spark.read.parquet(f"{root}/round={n - 1}")
        found = spark.read.parquet(*[f"{root}/round={i}" for i in range(n)])
        if last.isEmpty():
            return found
        known = found.select(F.col("node").alias("_from"), F.col("ancestor").alias("_to"))
        fresh = (
            last.join(known, F.col("ancestor") == F.col("_from"))
            .select("node", F.col("_to").alias("ancestor"))
            .distinct()
            .join(found, ["node", "ancestor"], "left_anti")
        )
        fresh.write.parquet(f"{root}/round={n}")
        n += 1


def deepest_tags(tagged: DataFrame, nodes: DataFrame, pairs: DataFrame, key: str, tag: str = "tag") -> DataFrame:
    """Tags of each ``key`` that are in the taxonomy and no ancestor of another of its tags.

    One join gives a row for each known tag and one for each of its ancestors,
    and one grouping by key and tag tells which tags are only the former.  The
    rows of a common tag pass through a hash table without being sorted or held;
    rows without a key cover nothing.
    """
    ids = nodes.select(F.col("id").alias("node")).distinct()
    above = pairs.filter("ancestor <> node").select("node", "ancestor").join(ids.hint("shuffle_hash"), "node", "left_semi")
    reached = ids.select("node", F.col("node").alias("_tag"), F.lit(False).alias("_covered")).unionByName(
        above.select("node", F.col("ancestor").alias("_tag"), F.lit(True).alias("_covered"))
    )
    rows = (
        tagged.select(key, tag)
        .join(reached.hint("shuffle_hash"), F.col(tag) == F.col("node"))
        .filter(~F.col("_covered") | F.col(key).isNotNull())
        .select(key, F.col("_tag").alias(tag), "_covered")
    )
    # Dealt first, so that nothing is grouped where the rows of a common tag meet.
    tags = rows.repartition(key, tag).groupBy(key, tag).agg(F.max("_covered").alias("_covered"))
    return tags.filter(~F.col("_covered")).select(key, tag)
