"""Analysis queries: facets, filters, counts, taxonomy."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import Catalog, table
from larder.functions.facets import main_text, tag_language, tag_name
from larder.operators import analysis
from larder.operators.taxonomy import ancestors, deepest_tags, lookup_tags
from larder.session import scratch_path
from larder.sources.clustered import look_up, write_clustered

catalog = Catalog()


def _tagged_parts(spark, sf):
    return table(spark, sf, "part").withColumn("tags", F.split("p_name", " "))


@catalog.query("""
    SELECT tag, count(*) AS occurrences
    FROM (SELECT unnest(string_split(p_name, ' ')) AS tag FROM part)
    GROUP BY tag ORDER BY occurrences DESC, tag LIMIT 20
""")
def tag_facet(spark, sf):
    return analysis.tag_facet(_tagged_parts(spark, sf), "tags", 20)


@catalog.query("""
    SELECT p_partkey, p_name, p_size FROM part
    WHERE list_contains(string_split(p_name, ' '), 'ring') AND p_size IS NOT NULL
""")
def ctas_subset(spark, sf):
    subset = analysis.with_tag_and_value(_tagged_parts(spark, sf), "tags", "ring", "p_size")
    stored = analysis.create_table_as(subset, scratch_path(spark, "subset"))
    return stored.select("p_partkey", "p_name", "p_size")


@catalog.query("""
    SELECT p_partkey, p_name, p_size FROM part
    WHERE list_contains(string_split(p_name, ' '), 'widget')
    ORDER BY p_partkey LIMIT 5
""")
def membership_limit(spark, sf):
    found = analysis.with_tag(_tagged_parts(spark, sf), "tags", "widget")
    return found.select("p_partkey", "p_name", "p_size").orderBy("p_partkey").limit(5)


@catalog.query("""
    SELECT count(*) AS n_all, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned FROM lineitem
""")
def count_all(spark, sf):
    return table(spark, sf, "lineitem").agg(
        F.count("*").alias("n_all"), F.count_if(F.col("l_returnflag") == "R").alias("n_returned")
    )


@catalog.query("""
    SELECT count(owner) AS n_owned, count(*) FILTER (WHERE owner = 'F') AS n_f
    FROM (SELECT nullif(o_orderstatus, 'O') AS owner FROM orders)
""")
def null_count(spark, sf):
    owners = table(spark, sf, "orders").select(F.expr("nullif(o_orderstatus, 'O')").alias("owner"))
    return owners.agg(F.count("owner").alias("n_owned"), F.count_if(F.col("owner") == "F").alias("n_f"))


@catalog.query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
           strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate
    FROM orders WHERE o_orderkey = 42
""")
def point_lookup(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderkey") == 42).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
    )


@catalog.query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderkey IN (SELECT max(o_orderkey) // d FROM orders, range(1, 6) t(d) GROUP BY d)
""")
def clustered_lookup(spark, sf):
    """Orders laid out by key, and a few of them found again through the index of key ranges."""
    orders = table(spark, sf, "orders")
    target = scratch_path(spark, "orders")
    write_clustered(orders, target, "o_orderkey", files=8)
    last = orders.agg(F.max("o_orderkey")).head()[0]
    found = look_up(spark, target, "o_orderkey", sorted({last // d for d in range(1, 6)}))
    return found.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


@catalog.query("""
    SELECT count(*) AS n FROM (
        SELECT CAST(round(l_discount * 100) AS INTEGER) AS known, CAST(round(l_tax * 100) AS INTEGER) AS unknown
        FROM lineitem)
    WHERE known > 0 AND (unknown = 0 OR unknown / known < 1 / 3)
""")
def ratio_count(spark, sf):
    counts = table(spark, sf, "lineitem").selectExpr(
        "CAST(round(l_discount * 100) AS INT) AS known", "CAST(round(l_tax * 100) AS INT) AS unknown"
    )
    return counts.filter(analysis.mostly_known("known", "unknown")).agg(F.count("*").alias("n"))


@catalog.query("""
    SELECT o_orderkey, string_split(o_orderpriority, '-')[1] AS lang, string_split(o_orderpriority, '-')[2] AS name
    FROM orders
""")
def tag_split(spark, sf):
    tags = table(spark, sf, "orders").withColumn("tag", F.expr("replace(o_orderpriority, '-', ':')"))
    return tags.select("o_orderkey", F.expr(tag_language("tag")).alias("lang"), F.expr(tag_name("tag")).alias("name"))


@catalog.query("SELECT doc_id, CASE WHEN lang <> 'en' THEN text END AS main_text FROM documents")
def main_language(spark, sf):
    listed = table(spark, sf, "documents").withColumn(
        "texts",
        F.expr(
            "CASE WHEN lang = 'en' THEN array(named_struct('lang', lang, 'text', text)) "
            "ELSE array(named_struct('lang', lang, 'text', upper(text)), "
            "named_struct('lang', 'main', 'text', text)) END"
        ),
    )
    return listed.select("doc_id", F.expr(main_text("texts")).alias("main_text"))


def _geography(spark, sf):
    """Region, nation and customer as taxonomy nodes and edges."""
    region = table(spark, sf, "region").selectExpr("concat('r:', r_regionkey) AS id", "r_name AS name")
    nation = table(spark, sf, "nation")
    customer = table(spark, sf, "customer")
    names = region.union(nation.selectExpr("concat('n:', n_nationkey)", "n_name")).union(
        customer.selectExpr("concat('c:', c_custkey)", "c_name")
    )
    nodes = names.selectExpr(
        "id", "'en' AS lang", "name", "array(name, lower(name)) AS synonyms",
        "map('kind', left(id, 1)) AS properties",
    )
    edges = nation.selectExpr(
        "concat('n:', n_nationkey) AS child", "concat('r:', n_regionkey) AS parent"
    ).union(customer.selectExpr("concat('c:', c_custkey)", "concat('n:', c_nationkey)"))
    return nodes, edges


def _tagged_orders(spark, sf):
    """Each order with its place tags and one unknown tag; low-priority orders name no customer."""
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    placed = (
        table(spark, sf, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    tags = (
        "array_compact(array(CASE WHEN o_orderpriority <> '5-LOW' THEN concat('c:', c_custkey) END, "
        "concat('n:', n_nationkey), concat('r:', n_regionkey), 'x:unknown'))"
    )
    return placed.select("o_orderkey", F.explode(F.expr(tags)).alias("tag"))


_TAGGED_SQL = """
    WITH tagged AS (
        SELECT o_orderkey, unnest([CASE WHEN o_orderpriority <> '5-LOW' THEN 'c:' || c_custkey END,
               'n:' || n_nationkey, 'r:' || n_regionkey, 'x:unknown']) AS tag
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
    nodes AS (
        SELECT 'r:' || r_regionkey AS id, r_name AS name FROM region
        UNION ALL SELECT 'n:' || n_nationkey, n_name FROM nation
        UNION ALL SELECT 'c:' || c_custkey, c_name FROM customer),
    edges AS (
        SELECT 'n:' || n_nationkey AS child, 'r:' || n_regionkey AS parent FROM nation
        UNION ALL SELECT 'c:' || c_custkey, 'n:' || c_nationkey FROM customer)
"""


@catalog.query(_TAGGED_SQL + """
    SELECT o_orderkey, tag, name, lower(name) AS synonym,
           CASE WHEN id IS NOT NULL THEN left(id, 1) END AS kind, id IS NOT NULL AS in_taxonomy
    FROM tagged LEFT JOIN nodes ON tag = id WHERE tag IS NOT NULL
""")
def taxonomy_lookup(spark, sf):
    nodes, _ = _geography(spark, sf)
    found = lookup_tags(_tagged_orders(spark, sf), nodes, "en")
    return found.select(
        "o_orderkey", "tag", "name", F.expr("synonyms[1]").alias("synonym"),
        F.expr("properties['kind']").alias("kind"), "in_taxonomy",
    )


@catalog.query(_TAGGED_SQL.replace("WITH", "WITH RECURSIVE", 1) + """
    , up AS (
        SELECT child AS node, parent AS ancestor FROM edges
        UNION SELECT up.node, edges.parent FROM up JOIN edges ON up.ancestor = edges.child)
    SELECT t.o_orderkey, t.tag FROM tagged t JOIN nodes ON t.tag = nodes.id
    WHERE NOT EXISTS (
        SELECT 1 FROM tagged o JOIN up ON o.tag = up.node
        WHERE o.o_orderkey = t.o_orderkey AND up.ancestor = t.tag)
""")
def leaf_tags(spark, sf):
    nodes, edges = _geography(spark, sf)
    return deepest_tags(_tagged_orders(spark, sf), nodes, ancestors(edges), "o_orderkey")
