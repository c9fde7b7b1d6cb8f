"""A Parquet layout for look-ups: files cut by ranges of a key, with an index of the ranges.

Files are sorted by the key and hold row groups of a bounded number of rows, each
with a Bloom filter on the key.  The index, a small Parquet table that readers of
the dataset do not see, holds the least and greatest key of every file; a look-up
opens only the files whose range holds a key, and of those only the row groups
whose filter may.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources.files import move_into_place, staging_path

ROW_GROUP_ROWS = 122_880
INDEX = "_ranges"


def row_groups(rows: int = ROW_GROUP_ROWS, bloom: str | None = None) -> dict[str, str]:
    """Options of a Parquet write: rows per group at most, and a column with a Bloom filter."""
    options = {"parquet.block.row.count.limit": str(rows)}
    if bloom:
        # Adaptive: of ten sizes, the least that suits the keys a row group turns out to have.
        options |= {
            f"parquet.bloom.filter.enabled#{bloom}": "true", "parquet.bloom.filter.adaptive.enabled": "true",
            f"parquet.bloom.filter.candidates.number#{bloom}": "10",
        }
    return options


def write_clustered(df: DataFrame, target: str, key: str, files: int | None = None, rows_per_group: int = ROW_GROUP_ROWS) -> None:
    """Write ``df`` by ranges of ``key``; without ``files``, Spark sizes them.

    Rows without a key come first.  One shuffle; ``df`` should be stored, as the
    ranges are found by a pass over its keys.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    staged = staging_path(target)
    ranged.sortWithinPartitions(key).write.options(**row_groups(rows_per_group, key)).parquet(staged)
    stored = spark.read.parquet(staged).select(F.col("_metadata.file_name").alias("file"), F.col(key).alias("k"))
    index = stored.groupBy("file").agg(F.min("k").alias("least"), F.max("k").alias("most"), F.count("*").alias("n"))
    index.write.parquet(f"{staged}/{INDEX}")
    move_into_place(spark, staged, target)


def files_with(spark: SparkSession, target: str, keys: list) -> list[str]:
    """Names of the files whose range holds one of ``keys``."""
    index = spark.read.parquet(f"{target}/{INDEX}")
    wanted = spark.createDataFrame([(k,) for k in keys], "k " + index.schema["least"].dataType.simpleString())
    return sorted(r.file for r in index.join(wanted, F.col("k").between(F.col("least"), F.col("most")), "left_semi").select("file").collect())


def look_up(spark: SparkSession, target: str, key: str, keys: list) -> DataFrame:
    """Rows of a clustered dataset with one of ``keys``."""
    files = files_with(spark, target, keys)
    schema = spark.read.parquet(target).schema
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{target}/{name}" for name in files]).filter(F.col(key).isin(*keys))
