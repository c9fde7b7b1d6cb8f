"""Runs registered queries on Spark and their SQL on DuckDB and compares the rows."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, Decimal):
        return round(float(value), 6)
    return value


def compare(spark_df, con, sql: str) -> str | None:
    """None when both give the same columns and the same bag of rows, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    order = sorted(names)
    expected = Counter(
        tuple(_plain(row[names.index(n)]) for n in order) for row in cursor.fetchall()
    )
    got = Counter(tuple(_plain(row[n]) for n in order) for row in spark_df.collect())
    if expected == got:
        return None
    return f"{sum(got.values())} rows != {sum(expected.values())}; only here {list((got - expected).items())[:3]}; missing {list((expected - got).items())[:3]}"
