"""Analysis steps over product tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_facet(products: DataFrame, tags: str, k: int, name: str = "tag") -> DataFrame:
    """The k most frequent tags; ties go to the smaller tag.

    Counts are combined before the shuffle and the top k is kept per task, so
    neither a hot tag nor many tags reach one place.
    """
    return (
        products.select(F.explode(tags).alias(name))
        .groupBy(name)
        .agg(F.count("*").alias("occurrences"))
        .orderBy(F.desc("occurrences"), F.asc(name))
        .limit(k)
    )


def with_tag(products: DataFrame, tags: str, tag: str) -> DataFrame:
    return products.filter(F.array_contains(tags, tag))


def with_tag_and_value(products: DataFrame, tags: str, tag: str, column: str) -> DataFrame:
    """Rows carrying the tag and having a value in ``column``."""
    return with_tag(products, tags, tag).filter(F.col(column).isNotNull())


def mostly_known(known: str, unknown: str) -> Column:
    """Something is known, and less than a third of it is unknown."""
    k, u = F.col(known), F.col(unknown)
    return (k > 0) & ((u == 0) | (F.try_divide(u, k) < F.lit(1) / F.lit(3)))


def nutrient_rows(products: DataFrame, key: str, nutriments: str, names: list[str]) -> DataFrame:
    """One row per listed nutrient: name, 100g, unit, serving."""
    wanted = F.filter(F.col(nutriments), lambda x: x["name"].isin(*names))
    rows = products.select(key, F.explode(wanted).alias("n"))
    return rows.select(key, "n.name", "n.`100g`", "n.unit", "n.serving")


def create_table_as(df: DataFrame, path: str) -> DataFrame:
    """Store a selection and hand back the stored table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
