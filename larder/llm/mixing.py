"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

Every source gets a mean repetition rate that brings its expected bytes to the
wanted share of the output.  A document's number of copies is the Poisson
quantile of a uniform number taken from a seeded hash of its id, so the draw
needs no state, is the same after a retry, and any machine can repeat it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.llm.common import unused
from larder.session import scratch_path

HASH_BITS = 52  # bits of the hash that make the uniform number


def _uniform(*parts: Column) -> Column:
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(2**HASH_BITS))


def source_rates(
    docs: DataFrame, targets: dict | None = None, temper: float = 0.5, epochs: float = 1.0, source: str = "source", text: str = "text"
) -> DataFrame:
    """One row per source: bytes, share wanted, mean repetitions, Poisson distribution function.

    ``targets`` maps a source to its weight (sources not named get none); without
    it the weight of a source is its bytes to the power ``temper``.  ``epochs``
    times the input's bytes are expected in the output.  Sources without bytes
    count as one byte, so that their rate is defined.
    """
    spark = docs.sparkSession
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.greatest(F.sum(F.coalesce(F.octet_length(text), F.lit(0))), F.lit(1)).cast("double").alias("n_bytes")
    )
    if targets is None:
        weighted = sizes.withColumn("weight", F.pow("n_bytes", F.lit(float(temper))))
    else:
        named = spark.createDataFrame([(k, float(v)) for k, v in targets.items()], "source string, weight double")
        weighted = sizes.join(named.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select(
            "source", "n_bytes", F.coalesce("weight", F.lit(0.0)).alias("weight")
        )
    all_bytes, all_weight = (weighted.agg(F.sum(name)).scalar() for name in ("n_bytes", "weight"))
    rates = weighted.withColumns({"all_bytes": all_bytes, "all_weight": all_weight}).select(
        "source", "n_bytes", (F.col("weight") / F.col("all_weight")).alias("share"),
        (F.lit(float(epochs)) * F.col("all_bytes") * F.col("weight") / F.col("all_weight") / F.col("n_bytes")).alias("rate"),
    )
    # Counts up to twelve deviations above the mean: beyond them lies less than 2**-52.
    terms = rates.withColumn(
        "k", F.explode(F.sequence(F.lit(0), (F.col("rate") + 12 * F.sqrt("rate") + 40).cast("int")))
    )
    upto = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    log_factorial = F.sum(F.log(F.greatest(F.col("k"), F.lit(1)).cast("double"))).over(upto)
    log_rate = F.when(F.col("rate") > 0, F.log("rate"))
    terms = terms.withColumn("log_factorial", log_factorial).withColumn(
        "p",
        F.when(F.col("rate") > 0, F.exp(F.col("k") * log_rate - F.col("rate") - F.col("log_factorial"))).otherwise(
            (F.col("k") == 0).cast("double")
        ),
    )
    terms = terms.withColumn("upto", F.sum("p").over(upto))
    return terms.groupBy("source").agg(
        F.first("n_bytes").alias("n_bytes"), F.first("share").alias("share"), F.first("rate").alias("rate"),
        F.sort_array(F.collect_list("upto")).alias("distribution"),
    )


def replicate(
    docs: DataFrame, targets: dict | None = None, temper: float = 0.5, epochs: float = 1.0, seed: int = 17,
    source: str = "source", text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """The columns of ``docs`` plus ``mix_copy`` (from 1) and ``mix_key``, ordered by ``mix_key``.

    A row whose draw is 0 does not appear.  Rows with the same key share one
    draw; rows without a key draw by their text.  A null source is a source of
    its own.  Columns of ``docs`` named like the two new ones are replaced.  An
    empty table gives an empty table.

    The rates are one small row per source.  They are stored first, so Spark
    knows their size before it plans the join and broadcasts them without moving
    a text; were there very many sources, the join would shuffle and adaptive
    execution would split the hot ones.
    """
    docs = docs.drop("mix_copy", "mix_key")
    own, steps, name, u, n = unused(docs, "_source", "_distribution", "_identity", "_u", "_count")
    path = scratch_path(docs.sparkSession, "rates")
    source_rates(docs, targets, temper, epochs, source, text).select(
        F.col("source").alias(own), F.col("distribution").alias(steps)
    ).write.parquet(path)
    rates = docs.sparkSession.read.parquet(path)
    identity = F.coalesce(F.col(key).cast("string"), F.md5(F.coalesce(F.col(text), F.lit(""))))
    drawn = docs.withColumn(name, identity)
    drawn = drawn.join(rates, F.col(source).eqNullSafe(F.col(own)), "left").withColumn(u, _uniform(F.lit(str(seed)), F.col(name)))
    count = F.size(F.filter(steps, lambda upto: upto <= F.col(u)))
    copies = drawn.withColumn(n, count).where(F.col(n) > 0).withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col(n))))
    spot = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(name), F.col("mix_copy"))), 1, 15), 16, 10).cast("long")
    return copies.withColumn("mix_key", spot).drop(name, own, steps, u, n).orderBy("mix_key", key, "mix_copy")


def replicate_sql(table: str = "documents", temper: float = 0.5, epochs: float = 1.0, seed: int = 17, columns: str = "d.*") -> str:
    """The same rows in DuckDB's SQL."""
    return f"""
WITH mix_sizes AS (
  SELECT source, CAST(greatest(sum(coalesce(strlen(text), 0)), 1) AS DOUBLE) AS n_bytes FROM {table} GROUP BY source),
mix_weights AS (SELECT source, n_bytes, pow(n_bytes, {temper}) AS weight FROM mix_sizes),
mix_rates AS (
  SELECT source, CAST({epochs} AS DOUBLE) * sum(n_bytes) OVER () * weight / sum(weight) OVER () / n_bytes AS rate FROM mix_weights),
mix_terms AS (
  SELECT source, rate, unnest(range(0, CAST(floor(rate + 12 * sqrt(rate) + 40) AS BIGINT) + 1)) AS k FROM mix_rates),
mix_logs AS (
  SELECT source, rate, k, sum(ln(CAST(greatest(k, 1) AS DOUBLE))) OVER (PARTITION BY source ORDER BY k) AS log_factorial FROM mix_terms),
mix_steps AS (
  SELECT source, k, sum(exp(k * ln(rate) - rate - log_factorial)) OVER (PARTITION BY source ORDER BY k) AS upto FROM mix_logs),
mix_cdf AS (SELECT source, list(upto ORDER BY k) AS steps FROM mix_steps GROUP BY source),
mix_draws AS (
  SELECT d.*, coalesce(CAST(d.doc_id AS VARCHAR), md5(coalesce(d.text, ''))) AS mix_identity, c.steps
  FROM {table} d LEFT JOIN mix_cdf c ON d.source IS NOT DISTINCT FROM c.source),
mix_counts AS (
  SELECT *, len(list_filter(steps, lambda x: x <= CAST('0x' || substr(md5('{seed}|' || mix_identity), 1, 13) AS BIGINT) / 4503599627370496.0)) AS mix_count
  FROM mix_draws),
mix_copies AS (
  SELECT *, unnest(range(1, mix_count + 1)) AS mix_copy FROM mix_counts WHERE mix_count > 0)
SELECT {columns}, CAST(d.mix_copy AS INTEGER) AS mix_copy,
  CAST('0x' || substr(md5('{seed}|' || d.mix_identity || '|' || d.mix_copy), 1, 15) AS BIGINT) AS mix_key
FROM mix_copies d"""
