"""Lookups of reference rows, de-duplication and foreign-key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows without a key never match; they are spread over this many join keys so
# that they do not meet in one task.
NULL_KEY_SPREAD = 4096


def last_wins_rows(df: DataFrame, key: str | list[str], order: str | list[str], unique: bool = False) -> DataFrame:
    """One row per key: the one with the greatest ``order`` (columns, or structs of them; null is least).

    First a hash aggregate of keys and the leading order column alone, combined
    before its shuffle; then a semi-join keeps the rows that reach the greatest.
    It joins on key and order, so the rows of a hot key are spread by their order.
    Rows that tie there are ranked by the rest of ``order``.  ``unique`` says that
    the leading column decides, which saves that step.
    """
    keys = [key] if isinstance(key, str) else list(key)
    parts = []
    for name in [order] if isinstance(order, str) else order:
        kind = df.schema[name].dataType
        parts += [F.col(name)[f.name] for f in kind] if isinstance(kind, T.StructType) else [F.col(name)]
    greatest = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(parts[0]).alias("_most"))
    same = parts[0].eqNullSafe(F.col("_most"))
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    won = df.join(greatest, same, "left_semi")
    if unique:
        return won
    ranked = Window.partitionBy(*keys).orderBy(*[p.desc() for p in parts[1:]] or [F.lit(0)])
    return won.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    fact_key: str,
    lookup_key: str,
    columns: list[str],
    prefix: str,
    spread_by: Column | None = None,
    must_exist: bool = False,
    unknown: str | None = None,
    hashed: bool = False,
) -> DataFrame:
    """Left join carrying ``columns`` of ``lookup`` (unique on its key) under ``prefix``.

    Spark picks broadcast or shuffle from the sizes it sees, and splits the
    partitions of hot keys at run time.  ``must_exist`` makes the job fail on a
    key that is set but unknown, inside the same pass; ``unknown`` names a flag
    column for such keys instead.  ``hashed`` is for a lookup that grows with the
    facts: it goes to hash tables by partition, and wide facts are not sorted.
    """
    # A non-constant zero: a literal would be folded out of the join keys.
    zero = F.expr(f"CAST(pmod(hash(`{lookup_key}`), 1) AS INT)")
    side = lookup.filter(F.col(lookup_key).isNotNull()).select(
        F.col(lookup_key).alias("_key"),
        zero.alias("_zero"),
        F.lit(True).alias("_found"),
        *[F.col(c).alias(prefix + c) for c in columns],
    )
    if hashed:
        side = side.hint("shuffle_hash")
    spread_by = spread_by if spread_by is not None else F.xxhash64(*facts.columns)
    left = facts.withColumn(
        "_spread",
        F.when(F.col(fact_key).isNull(), F.pmod(spread_by, F.lit(NULL_KEY_SPREAD)).cast("int") + 1).otherwise(0),
    )
    joined = left.join(
        side, (F.col(fact_key) == F.col("_key")) & (F.col("_spread") == F.col("_zero")), "left"
    )
    absent = F.col(fact_key).isNotNull() & F.col("_found").isNull()
    if unknown:
        joined = joined.withColumn(unknown, absent)
    if must_exist:
        message = F.concat(F.lit(f"unknown {fact_key}: "), F.col(fact_key).cast("string"))
        kind = facts.schema[fact_key].dataType
        joined = joined.withColumn(
            fact_key, F.when(absent, F.raise_error(message).cast(kind)).otherwise(F.col(fact_key))
        )
    return joined.drop("_key", "_zero", "_found", "_spread")


def unknown_keys(facts: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str) -> DataFrame:
    """Fact rows whose key is set but not in ``lookup``."""
    known = lookup.select(F.col(lookup_key).alias("_known"))
    return facts.filter(F.col(fact_key).isNotNull()).join(
        known, F.col(fact_key) == F.col("_known"), "left_anti"
    )


def owner_hash(owner: str) -> str:
    """First eight hex digits of the SHA-256 of an owner name; NULL stays NULL."""
    return f"substr(sha2({owner}, 256), 1, 8)"
