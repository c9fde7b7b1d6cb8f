"""From nested columns to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.variants import pinned


def exploded(df: DataFrame, keep: list, sql: str, name: str) -> DataFrame:
    """``keep`` columns plus one row per element of the array expression ``sql``.

    Spark drops rows with empty arrays before exploding.  Pinning the array first
    keeps that test from computing a costly expression several times.
    """
    arrays = df.select(*keep, pinned(sql).alias(name))
    kept = arrays.columns[:-1]
    return arrays.select(*kept, F.explode(name).alias(name))
