"""Price queries: line items as prices, orders as proofs, suppliers as locations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import Catalog, spread_table, table
from larder.operators.joins import last_wins_rows, unknown_keys
from larder.operators.joins import owner_hash as owner_hash_sql
from larder.plans.prices import export_prices, join_prices, parse_proofs, strict
from larder.schemas import LOCATION_COLUMNS, PRICE_COLUMNS, PROOF_COLUMNS, ddl
from larder.session import scratch_path

catalog = Catalog()


def _filled(df, columns, values, *extra):
    """Columns of a record type: given SQL, else NULL."""
    return df.select(
        *[
            F.expr(values.get(f.name, "NULL")).cast(f.dataType).alias(f.name)
            for f in ddl(columns)
        ],
        *[F.expr(sql).alias(name) for name, sql in extra],
    )


def _prices(spark, sf):
    return _filled(
        table(spark, sf, "lineitem"),
        PRICE_COLUMNS,
        {
            "id": "l_orderkey * 10 + l_linenumber",
            "type": "'PRODUCT'",
            "product_code": "CAST(l_partkey AS STRING)",
            "price": "l_extendedprice",
            "currency": "'EUR'",
            "proof_id": "CASE WHEN l_returnflag <> 'N' THEN l_orderkey END",
            "location_id": "CASE WHEN l_linestatus <> 'O' THEN l_suppkey END",
            "receipt_quantity": "l_quantity",
        },
    )


def _proofs(spark, sf):
    """Every order twice; the second record is the later one."""
    orders = table(spark, sf, "orders").withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    return _filled(
        orders,
        PROOF_COLUMNS,
        {
            "type": "'RECEIPT'",
            "file_path": "concat(o_orderkey, CASE WHEN n = 2 THEN '/new' ELSE '/old' END)",
            "date": "o_orderdate",
            "currency": "o_orderstatus",
            "receipt_price_total": "o_totalprice",
            "owner": owner_hash_sql("CAST(o_custkey AS STRING)"),
        },
        ("id", "o_orderkey"),
        ("pos", "n"),
    )


def _locations(spark, sf):
    return _filled(
        table(spark, sf, "supplier"),
        LOCATION_COLUMNS,
        {"type": "'OSM'", "osm_display_name": "s_name", "osm_lat": "s_acctbal"},
        ("id", "s_suppkey"),
        ("pos", "1"),
    )


@catalog.query("""
    SELECT l_orderkey * 10 + l_linenumber AS id, CAST(l_partkey AS VARCHAR) AS product_code,
           CAST(CAST(l_extendedprice AS DECIMAL(10,3)) AS VARCHAR) AS price,
           o.o_orderkey || '/new' AS proof_file_path, o.o_orderstatus AS proof_currency,
           strftime(o.o_orderdate, '%Y-%m-%d') AS proof_date,
           CAST(CAST(o.o_totalprice AS DECIMAL(10,3)) AS VARCHAR) AS proof_receipt_price_total,
           substr(sha256(CAST(o.o_custkey AS VARCHAR)), 1, 8) AS proof_owner,
           s.s_name AS location_osm_display_name, round(s.s_acctbal, 2) AS location_osm_lat
    FROM lineitem
    LEFT JOIN orders o ON l_returnflag <> 'N' AND l_orderkey = o.o_orderkey
    LEFT JOIN supplier s ON l_linestatus <> 'O' AND l_suppkey = s.s_suppkey
""")
def price_join(spark, sf):
    flat = join_prices(_prices(spark, sf), _proofs(spark, sf), _locations(spark, sf))
    return flat.select(
        "id", "product_code", F.col("price").cast("string").alias("price"),
        "proof_file_path", "proof_currency",
        F.date_format("proof_date", "yyyy-MM-dd").alias("proof_date"),
        F.col("proof_receipt_price_total").cast("string").alias("proof_receipt_price_total"),
        "proof_owner", "location_osm_display_name",
        F.round("location_osm_lat", 2).alias("location_osm_lat"),
    )


@catalog.query("""
    WITH p AS (
        SELECT l_orderkey * 10 + l_linenumber AS id,
               CASE WHEN l_linenumber = 3 THEN 'type' END AS a,
               CASE WHEN l_returnflag <> 'N' AND l_orderkey % 7 = 0 THEN 'unknown proof_id' END AS b,
               CASE WHEN l_linestatus <> 'O' AND l_suppkey % 5 = 0 THEN 'unknown location_id' END AS c
        FROM lineitem)
    SELECT 'price' AS record, id, concat_ws(',', a, b, c) AS reasons FROM p
    UNION ALL SELECT 'proof', o_orderkey, 'currency' FROM orders WHERE o_orderkey % 7 = 0
    UNION ALL SELECT 'location', s_suppkey, 'type' FROM supplier WHERE s_suppkey % 5 = 0
""")
def price_quarantine(spark, sf):
    """A whole export of JSON lines that goes on: kept prices without a reason, refused records with all of theirs."""
    root = scratch_path(spark, "prices")
    records = {
        "price": table(spark, sf, "lineitem").selectExpr(
            "to_json(named_struct('id', l_orderkey * 10 + l_linenumber, 'type', CASE WHEN l_linenumber <> 3 THEN 'PRODUCT' END, "
            "'product_code', CAST(l_partkey AS STRING), 'proof_id', CASE WHEN l_returnflag <> 'N' THEN l_orderkey END, "
            "'location_id', CASE WHEN l_linestatus <> 'O' THEN l_suppkey END)) AS value"),
        "proof": table(spark, sf, "orders").selectExpr(
            "concat('{\"id\":', o_orderkey, ',\"type\":\"RECEIPT\",\"currency\":', CASE WHEN o_orderkey % 7 = 0 THEN '5' ELSE '\"EUR\"' END, '}') AS value"),
        "location": table(spark, sf, "supplier").selectExpr(
            "to_json(named_struct('id', s_suppkey, 'type', CASE WHEN s_suppkey % 5 <> 0 THEN 'OSM' END)) AS value"),
    }
    for name, lines in records.items():
        lines.write.text(f"{root}/{name}")
    export_prices(spark, {name: f"{root}/{name}" for name in records}, f"{root}/out", "quarantine", f"{root}/refused")
    kept = spark.read.parquet(f"{root}/out").select(F.lit("price").alias("record"), "id", F.lit("").alias("reasons"))
    refused = spark.read.parquet(f"{root}/refused").select("record", F.expr("CAST(get_json_object(line, '$.id') AS BIGINT) AS id"), F.array_join("errors", ",").alias("reasons"))
    return kept.withColumn("id", F.col("id").cast("bigint")).unionByName(refused)


@catalog.query("""
    SELECT l_orderkey, count(*) AS n FROM lineitem
    WHERE l_returnflag <> 'N' AND NOT EXISTS (
        SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')
    GROUP BY l_orderkey
""")
def fk_violations(spark, sf):
    facts = table(spark, sf, "lineitem").withColumn("proof_id", F.expr("CASE WHEN l_returnflag <> 'N' THEN l_orderkey END"))
    known = table(spark, sf, "orders").filter("o_orderstatus <> 'P'")
    bad = unknown_keys(facts, known, "proof_id", "o_orderkey")
    return bad.groupBy("l_orderkey").agg(F.count("*").alias("n"))


@catalog.query("""
    SELECT l_partkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1
""")
def last_wins(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice",
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice").alias("pos"),
    )
    return last_wins_rows(rows, "l_partkey", "pos").drop("pos")


@catalog.query("""
    SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN substr(sha256(c_name), 1, 8) END AS owner FROM customer
""")
def owner_hash(spark, sf):
    owners = table(spark, sf, "customer").withColumn("owner", F.expr("CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END"))
    return owners.select("c_custkey", F.expr(owner_hash_sql("owner")).alias("owner"))


@catalog.query("""
    SELECT o_orderkey AS id, o_orderstatus AS currency, strftime(o_orderdate, '%Y-%m-%d') AS date,
           CAST(CAST(o_totalprice AS DECIMAL(10,3)) AS VARCHAR) AS total,
           substr(sha256(CAST(o_custkey AS VARCHAR)), 1, 8) AS owner
    FROM orders
""")
def strict_validate(spark, sf):
    """Orders as proof records in JSON, checked so that one bad record would stop the job."""
    lines = spread_table(spark, sf, "orders").select(
        F.expr(
            "to_json(named_struct('id', o_orderkey, 'type', 'RECEIPT', 'currency', o_orderstatus, "
            "'date', date_format(o_orderdate, 'yyyy-MM-dd'), "
            "'receipt_price_total', CAST(o_totalprice AS DECIMAL(12,2)), 'owner', CAST(o_custkey AS STRING)))"
        ).alias("line")
    )
    proofs = strict(parse_proofs(lines), "proof")
    return proofs.select(
        "id", "currency", F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.col("receipt_price_total").cast("string").alias("total"), "owner",
    )


@catalog.query("""
    SELECT o_orderkey,
           CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(CAST(o_totalprice AS DECIMAL(10,3)) AS VARCHAR) END AS price,
           CASE WHEN o_orderkey * 1000000 <= 2147483647 THEN CAST(o_orderkey * 1000000 AS INTEGER) END AS whole,
           round(CAST(CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 0.0001 ELSE o_totalprice END AS FLOAT) AS DOUBLE), 1) AS single
    FROM orders
""")
def narrow_types(spark, sf):
    """Urgent orders carry a fourth decimal, which the exact decimal column refuses."""
    from larder.functions.variants import to_decimal, to_float, to_int

    docs = spread_table(spark, sf, "orders").select(
        "o_orderkey",
        F.expr(
            "parse_json(concat('{\"p\":', CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING), "
            "CASE WHEN o_orderpriority = '1-URGENT' THEN '01' ELSE '' END, ',\"n\":', o_orderkey * 1000000, '}'))"
        ).alias("d"),
    ).selectExpr("o_orderkey", "try_variant_get(d, '$.p', 'variant') AS p", "try_variant_get(d, '$.n', 'variant') AS n")
    return docs.select(
        "o_orderkey",
        F.expr(f"CAST({to_decimal('p')} AS STRING)").alias("price"),
        F.expr(to_int("n")).alias("whole"),
        F.expr(f"round(CAST({to_float('p')} AS DOUBLE), 1)").alias("single"),
    )
