"""Product queries: documents shaped from the given tables, parsed back by the engine."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import Catalog, spread_table, table
from larder.functions.facets import nth_ingredient
from larder.functions.variants import pinned, to_bigint, to_bool, to_double, to_str, to_text
from larder.operators import images, ingredients, language, members, nutriments
from larder.operators.analysis import nutrient_rows
from larder.operators.rows import exploded
from larder.plans import products as plan
from larder.plans.mobile import mobile_columns
from larder.schemas import LANGUAGE_FIELDS, ingredient_fields, product_schema
from larder.session import scratch_path
from larder.sources.files import read_lines, read_tsv, write_parquet, write_tsv

catalog = Catalog()


def _docs(df, key: str, text: str):
    """(key, d): a JSON text per row, as VARIANT."""
    return df.selectExpr(key, f"parse_json({text}) AS d")


# --- scans and schema ---------------------------------------------------------------


@catalog.query("SELECT p_partkey, p_name, p_brand, p_size, round(p_retailprice, 2) AS p_retailprice FROM part")
def jsonl_scan(spark, sf):
    """Parts written as gzipped JSON lines and scanned back."""
    target = scratch_path(spark, "lines")
    table(spark, sf, "part").select(F.to_json(F.struct("*")).alias("value")).write.text(target, compression="gzip")
    doc = read_lines(spark, target).select(
        F.from_json("line", "p_partkey BIGINT, p_name STRING, p_brand STRING, p_size INT, p_retailprice DOUBLE").alias("d")
    )
    return doc.select("d.*").withColumn("p_retailprice", F.round("p_retailprice", 2))


def _product_lines(spark, sf):
    """One product document per part."""
    return spread_table(spark, sf, "part").select(
        F.expr(
            "to_json(named_struct('code', CAST(p_partkey AS STRING), 'product_name', p_name, "
            "'product_name_fr', upper(p_name), 'brands', p_brand, 'rev', p_size, 'obsolete', true, "
            "'categories_tags', split(p_name, ' '), 'unknown_member', p_type, "
            "'product_quantity', p_retailprice, 'schema_version', 999))"
        ).alias("line")
    )


_PRODUCT_SQL = """
    SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS main_name, upper(p_name) AS french_name,
           p_brand AS brands, p_size AS rev, false AS obsolete,
           replace(p_name, ' ', '|') AS categories, CAST(p_retailprice AS VARCHAR) AS product_quantity,
           999 AS schema_version
    FROM part
"""


def _product_view(products):
    return products.select(
        "code", F.expr("product_name[0].text").alias("main_name"),
        F.expr("product_name[1].text").alias("french_name"), "brands", "rev", "obsolete",
        F.array_join("categories_tags", "|").alias("categories"), "product_quantity", "schema_version",
    )


@catalog.query(_PRODUCT_SQL)
def project_schema(spark, sf):
    rows = plan.parse_products(_product_lines(spark, sf), "food")
    return _product_view(plan.good_rows(rows, "food"))


@catalog.query(_PRODUCT_SQL)
def parquet_roundtrip(spark, sf):
    """The beauty export, written to Parquet and read back."""
    target = scratch_path(spark, "beauty")
    rows = plan.parse_products(_product_lines(spark, sf), "beauty")
    write_parquet(plan.good_rows(rows, "beauty"), target, product_schema("beauty"))
    return _product_view(spark.read.parquet(target))


@catalog.query("""
    SELECT CAST(p_partkey AS VARCHAR) AS code,
           CASE WHEN p_type = 'PROMO' THEN 'brands_tags' WHEN p_type = 'SMALL' THEN 'rev'
                WHEN p_type = 'LARGE' THEN 'overflow:max_imgid' ELSE '' END AS errors
    FROM part
""")
def quarantine(spark, sf):
    """Good and refused products side by side; each refused one names its fields."""
    lines = spread_table(spark, sf, "part").select(
        F.expr(
            "concat('{\"code\":\"', p_partkey, '\",\"brands_tags\":', "
            "CASE p_type WHEN 'PROMO' THEN '[\"a\",1]' ELSE '[\"a\"]' END, "
            "',\"rev\":', CASE p_type WHEN 'SMALL' THEN '\"x\"' ELSE CAST(p_size AS STRING) END, "
            "',\"max_imgid\":', CASE p_type WHEN 'LARGE' THEN '99999999999' ELSE '1' END, '}')"
        ).alias("line")
    )
    rows = plan.parse_products(lines, "beauty")
    good = plan.good_rows(rows, "beauty").select("code", F.lit("").alias("errors"))
    return good.union(plan.quarantine(rows).select("code", F.array_join("errors", ",")))


@catalog.query("""
    WITH r AS (
        SELECT CASE WHEN p_type = 'PROMO' THEN 'brands_tags' WHEN p_type = 'SMALL' THEN 'rev'
                    WHEN p_type = 'LARGE' THEN 'overflow:max_imgid' WHEN p_partkey % 50 = 0 THEN 'ingredients' END AS reason FROM part)
    SELECT 'read' AS counted, '' AS reason, count(*) AS n FROM r
    UNION ALL SELECT 'kept', '', count(*) FROM r WHERE reason IS NULL
    UNION ALL SELECT 'refused', '', count(*) FROM r WHERE reason IS NOT NULL
    UNION ALL SELECT 'refused', reason, count(*) FROM r WHERE reason IS NOT NULL GROUP BY reason
""")
def export_report(spark, sf):
    """What a whole export says it read, kept and refused; every tenth list is nested deeper than unrolled."""
    lines = spread_table(spark, sf, "part").select(
        F.expr(
            "concat('{\"code\":\"', p_partkey, '\",\"brands_tags\":', "
            "CASE p_type WHEN 'PROMO' THEN '[\"a\",1]' ELSE '[\"a\"]' END, "
            "',\"rev\":', CASE p_type WHEN 'SMALL' THEN '\"x\"' ELSE CAST(p_size AS STRING) END, "
            "',\"max_imgid\":', CASE p_type WHEN 'LARGE' THEN '99999999999' ELSE '1' END, "
            "CASE WHEN p_partkey % 10 = 0 AND p_type NOT IN ('PROMO', 'SMALL', 'LARGE') THEN concat(',\"ingredients\":[', "
            f"repeat('{{\"text\":\"a\",\"ingredients\":[', 8), '{{\"text\":', CASE WHEN p_partkey % 50 = 0 THEN '5' ELSE '\"b\"' END, '}}', "
            "repeat(']}', 8), ']') ELSE '' END, '}')"
        ).alias("line")
    )
    report = plan.export_products(spark, lines, scratch_path(spark, "report"), "beauty")
    rows = [("read", "", report.read), ("kept", "", report.kept), ("refused", "", report.refused)]
    rows += [("refused", reason, n) for reason, n in report.reasons.items()]
    return spark.createDataFrame(rows, "counted string, reason string, n long")


# --- scalars --------------------------------------------------------------------------


def _event_values(spark, sf, text: str):
    """(event_id, v): one JSON value per event; ``k`` is the number in its props."""
    events = spread_table(spark, sf, "events").selectExpr(
        "event_id", "value", "get_json_object(props, '$.k') AS k"
    )
    return _docs(events, "event_id", f"concat('{{', {text}, '}}')").selectExpr(
        "event_id", "try_variant_get(d, '$.v', 'variant') AS v"
    )


_K = "(SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"


@catalog.query(f"""
    SELECT event_id,
           CASE event_id % 9 WHEN 0 THEN k WHEN 1 THEN k WHEN 2 THEN k WHEN 4 THEN 1 WHEN 6 THEN k END AS as_int,
           CASE event_id % 9 WHEN 0 THEN k WHEN 1 THEN k WHEN 2 THEN k WHEN 3 THEN k + 0.5 WHEN 4 THEN 1
                WHEN 6 THEN k WHEN 7 THEN k + 0.5 END::DOUBLE AS as_float,
           CASE event_id % 9 WHEN 1 THEN k || '' WHEN 6 THEN k || '.0' WHEN 7 THEN k || '.5' WHEN 8 THEN 'k' || k END AS as_str,
           CASE WHEN event_id % 9 = 4 THEN true WHEN event_id % 9 IN (0, 1, 2) AND k = 1 THEN true
                WHEN event_id % 9 IN (0, 1, 2) AND k = 0 THEN false END AS as_bool
    FROM {_K}
""")
def coerce_scalars(spark, sf):
    """Each JSON value read as every scalar type."""
    docs = _event_values(
        spark, sf,
        "'\"v\":', CASE event_id % 9 WHEN 0 THEN k WHEN 1 THEN concat('\"', k, '\"') WHEN 2 THEN concat(k, '.0') "
        "WHEN 3 THEN concat(k, '.5') WHEN 4 THEN 'true' WHEN 5 THEN 'null' WHEN 6 THEN concat('\"', k, '.0\"') "
        "WHEN 7 THEN concat('\"', k, '.5\"') ELSE concat('\"k', k, '\"') END",
    )
    return docs.select(
        "event_id", F.expr(to_bigint("v")).alias("as_int"), F.expr(to_double("v")).alias("as_float"),
        F.expr(to_str("v")).alias("as_str"), F.expr(to_bool("v")).alias("as_bool"),
    )


@catalog.query(f"""
    SELECT event_id, CASE event_id % 5 WHEN 0 THEN k || '' WHEN 1 THEN k || '.5' WHEN 2 THEN k || ' g'
           WHEN 4 THEN k || '.0' END AS quantity
    FROM {_K}
""")
def num_to_string(spark, sf):
    docs = _event_values(
        spark, sf,
        "'\"v\":', CASE event_id % 5 WHEN 0 THEN k WHEN 1 THEN concat(k, '.50') WHEN 2 THEN concat('\"', k, ' g\"') "
        "WHEN 3 THEN 'true' ELSE concat(k, '.0') END",
    )
    return docs.select("event_id", F.expr(to_text("v")).alias("quantity"))


@catalog.query(f"""
    SELECT event_id, CASE event_id % 5 WHEN 0 THEN CASE WHEN k <> 0 THEN k || '' END WHEN 1 THEN k || ''
           WHEN 2 THEN 'True' END AS nova_groups
    FROM {_K}
""")
def int_to_string(spark, sf):
    docs = _event_values(
        spark, sf,
        "'\"v\":', CASE event_id % 5 WHEN 0 THEN k WHEN 1 THEN concat('\"', k, '\"') WHEN 2 THEN 'true' "
        "WHEN 3 THEN 'false' ELSE concat(k, '.5') END",
    )
    return docs.select("event_id", F.expr(plan.group_text("v")).alias("nova_groups"))


@catalog.query("""
    SELECT event_id, CAST(trunc(CASE WHEN event_id % 2 = 0 THEN -value ELSE value END) AS BIGINT) AS score FROM events
""")
def truncate_score(spark, sf):
    docs = _event_values(
        spark, sf, "'\"v\":', CAST(CASE WHEN event_id % 2 = 0 THEN -value ELSE value END AS STRING)"
    )
    return docs.select("event_id", F.expr(plan.score_text("v")).alias("score"))


@catalog.query("""
    SELECT event_id, CASE event_id % 9 WHEN 6 THEN NULL ELSE event_id % 9 IN (0, 1, 2, 3, 8) END AS flag FROM events
""")
def parse_bool(spark, sf):
    docs = _event_values(
        spark, sf,
        "CASE event_id % 9 WHEN 0 THEN '\"v\":\"on\"' WHEN 1 THEN '\"v\":\"true\"' WHEN 2 THEN '\"v\":1' "
        "WHEN 3 THEN '\"v\":true' WHEN 4 THEN '\"v\":\"1\"' WHEN 5 THEN '\"v\":null' WHEN 6 THEN '' "
        "WHEN 7 THEN '\"v\":false' ELSE '\"v\":1.0' END",
    )
    return docs.select("event_id", F.expr(plan.flag("v")).alias("flag"))


@catalog.query("""
    SELECT p_partkey,
           CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN p_size END AS ciqual,
           CASE WHEN p_type IN ('LARGE', 'STANDARD') THEN p_size + 1 END AS agribalyse,
           CASE WHEN p_type = 'SMALL' THEN p_size END AS proxy,
           p_type NOT IN ('MEDIUM', 'PROMO') AS fits
    FROM part
""")
def fix_category_keys(spark, sf):
    """Repaired keys; a key that is still unknown refuses the whole object."""
    docs = table(spark, sf, "part").selectExpr(
        "p_partkey",
        "CASE p_type WHEN 'ECONOMY' THEN concat('{\"ciqual_food_code:en\":\"', p_size, '\"}') "
        "WHEN 'LARGE' THEN concat('{\"agribalyse_food_cod:en\":', p_size + 1, '}') "
        "WHEN 'SMALL' THEN concat('{\"agribalyse_proxy_food_code:en\":', p_size, '}') "
        "WHEN 'MEDIUM' THEN '{\"ciqual_food_name:en\":\"x\"}' "
        "WHEN 'PROMO' THEN '{\"ciqual_food_code:fr\":1}' "
        "ELSE concat('{\"ciqual_food_code\":', p_size, '.0,\"agribalyse_food_code\":', p_size + 1, '}') END AS t",
    )
    fixed = docs.select("p_partkey", F.expr(members.category_codes("t")).alias("c"))
    return fixed.select(
        "p_partkey", F.col("c.ciqual_food_code").alias("ciqual"), F.col("c.agribalyse_food_code").alias("agribalyse"),
        F.col("c.agribalyse_proxy_food_code").alias("proxy"), F.col("c").isNotNull().alias("fits"),
    )


# --- nested members ---------------------------------------------------------------------


@catalog.query("""
    SELECT doc_id, 'main' AS lang, text FROM documents WHERE lang <> 'de'
    UNION ALL SELECT doc_id, lang, source || ' ' || lang FROM documents
    UNION ALL SELECT doc_id, 'xx', text FROM documents
""")
def language_pivot(spark, sf):
    """Whole document texts under suffixed keys, pivoted to (lang, text)."""
    docs = table(spark, sf, "documents").withColumn(
        "line",
        F.expr(
            "to_json(map('generic_name', CASE WHEN lang = 'de' THEN '' ELSE text END, "
            "concat('generic_name_', lang), concat(source, ' ', lang), "
            "'generic_name_with_notes_xx', text, "
            "'generic_name_yy', '', 'generic_name_debug', 'x', 'other', 'y'))"
        ),
    )
    parsed = docs.select("doc_id", F.expr("from_json(line, 'map<string,variant>')").alias("m"))
    entries = parsed.select(
        "doc_id", F.expr("element_at(m, 'generic_name')").alias("main"),
        F.expr(language.language_members("m", LANGUAGE_FIELDS)).alias("e"),
    )
    rows = exploded(entries, ["doc_id"], language.language_list("main", "e", "generic_name"), "x")
    return rows.select("doc_id", "x.lang", "x.text")


_IMAGE_TEXT = """CASE WHEN p_size % 2 = 0 THEN
    concat('{"1":{"sizes":{"100":{"h":', p_size, ',"w":2},"400":null,"other":{"h":1}},"uploaded_t":"', p_partkey,
           '","uploader":"u', p_size, '"},"front_fr":{"imgid":"', p_size, '","rev":3.0,"sizes":{"other":{"h":1,"w":1}}}}')
    ELSE concat('{"selected":{"front":{"de":{"imgid":', p_size, ',"rev":"7","sizes":{"full":{"h":"', p_size,
           '","w":9,"url":"x"}},"generation":{"angle":null}}}},"uploaded":{"2":{"uploader":"v","uploaded_t":', p_partkey, '}}}') END"""


def _images(spark, sf):
    docs = table(spark, sf, "part").selectExpr("p_partkey", _IMAGE_TEXT + " AS t")
    return exploded(docs, ["p_partkey"], images.images_array("t"), "i")


@catalog.query("""
    SELECT p_partkey, '1' AS key, NULL::INTEGER AS imgid, NULL::INTEGER AS rev, p_partkey AS uploaded_t, 'u' || p_size AS uploader
    FROM part WHERE p_size % 2 = 0
    UNION ALL SELECT p_partkey, 'front_fr', p_size, 3, NULL, NULL FROM part WHERE p_size % 2 = 0
    UNION ALL SELECT p_partkey, '2', NULL, NULL, p_partkey, 'v' FROM part WHERE p_size % 2 = 1
    UNION ALL SELECT p_partkey, 'front_de', p_size, 7, NULL, NULL FROM part WHERE p_size % 2 = 1
""")
def images_to_array(spark, sf):
    """Flat and grouped image layouts side by side."""
    return _images(spark, sf).select("p_partkey", "i.key", "i.imgid", "i.rev", "i.uploaded_t", "i.uploader")


@catalog.query("""
    SELECT p_partkey, '1' AS key, true AS sized, p_size AS h100, NULL::INTEGER AS h400, NULL::INTEGER AS hfull FROM part WHERE p_size % 2 = 0
    UNION ALL SELECT p_partkey, 'front_fr', true, NULL, NULL, NULL FROM part WHERE p_size % 2 = 0
    UNION ALL SELECT p_partkey, '2', false, NULL, NULL, NULL FROM part WHERE p_size % 2 = 1
    UNION ALL SELECT p_partkey, 'front_de', true, NULL, NULL, p_size FROM part WHERE p_size % 2 = 1
""")
def image_sizes(spark, sf):
    return _images(spark, sf).select(
        "p_partkey", "i.key", F.col("i.sizes").isNotNull().alias("sized"),
        F.col("i.sizes.`100`.h").alias("h100"), F.col("i.sizes.`400`.h").alias("h400"), F.col("i.sizes.full.h").alias("hfull"),
    )


@catalog.query("""
    SELECT s_suppkey, 'nation' AS field_name, CAST(s_nationkey AS BIGINT) AS timestamp FROM supplier
    UNION ALL SELECT s_suppkey, 'key', s_suppkey FROM supplier
""")
def owner_fields(spark, sf):
    docs = table(spark, sf, "supplier").selectExpr(
        "s_suppkey", "concat('{\"nation\":\"', s_nationkey, '\",\"key\":', s_suppkey, '}') AS t"
    )
    return exploded(docs, ["s_suppkey"], members.owner_fields("t"), "o").select("s_suppkey", "o.*")


@catalog.query("""
    SELECT p_partkey, p_type AS material, CAST(p_size AS BIGINT) AS number_of_units, p_size || '' AS quantity_per_unit_value,
           round(p_retailprice, 1) AS weight_measured FROM part
    UNION ALL SELECT p_partkey, NULL, NULL, p_size || ' g', NULL FROM part
""")
def packagings(spark, sf):
    docs = _docs(
        table(spark, sf, "part"), "p_partkey",
        "concat('[{\"material\":\"', p_type, '\",\"number_of_units\":\"', p_size, '\",\"quantity_per_unit_value\":', p_size, "
        "',\"weight_measured\":', p_retailprice, '},{\"quantity_per_unit_value\":\"', p_size, ' g\",\"material\":null}]')",
    )
    rows = exploded(docs, ["p_partkey"], members.packagings("d"), "p")
    return rows.select(
        "p_partkey", "p.material", "p.number_of_units", "p.quantity_per_unit_value",
        F.round(F.col("p.weight_measured").cast("double"), 1).alias("weight_measured"),
    )


@catalog.query("""
    SELECT CAST(s_suppkey AS VARCHAR) AS code, '{"z":' || s_nationkey || ',"a":["' || s_name || '",1.5]}' AS score_data FROM supplier
""")
def object_to_json(spark, sf):
    """An open object stays whole, in its own member order, as compact text."""
    lines = table(spark, sf, "supplier").select(
        F.expr(
            "concat('{\"code\": \"', s_suppkey, '\", \"environmental_score_data\": { \"z\": ', s_nationkey, "
            "', \"a\": [\"', s_name, '\", 1.5] } }')"
        ).alias("line")
    )
    rows = plan.good_rows(plan.parse_products(lines, "food"), "food")
    return rows.select("code", F.col("environmental_score_data").alias("score_data"))


# --- nutrients -----------------------------------------------------------------------------

_FLAT_NUTRIENTS = (
    "concat('{\"quantity_100g\":', l_quantity, ',\"quantity_unit\":\"', l_returnflag, '\",\"tax_serving\":\"', l_tax, "
    "'\",\"tax_prepared_value\":', l_discount, ',\"x_100g_value\":', l_linenumber, ',\"plain\":1}')"
)


@catalog.query("""
    WITH n AS (
        SELECT 'quantity' AS name, l_returnflag AS unit, l_quantity AS per_100g, NULL AS serving, NULL AS value, NULL AS prepared_value FROM lineitem
        UNION ALL SELECT 'tax', NULL, NULL, l_tax, NULL, l_discount FROM lineitem
        UNION ALL SELECT 'x_100g', NULL, NULL, NULL, l_linenumber, NULL FROM lineitem
        UNION ALL SELECT 'x', NULL, l_linenumber, NULL, NULL, NULL FROM lineitem)
    SELECT name, unit, count(*) AS n,
           sum(CAST(round(per_100g * 100) AS BIGINT))::BIGINT AS per_100g, sum(CAST(round(serving * 100) AS BIGINT))::BIGINT AS serving,
           sum(CAST(round(value * 100) AS BIGINT))::BIGINT AS value, sum(CAST(round(prepared_value * 100) AS BIGINT))::BIGINT AS prepared_value
    FROM n GROUP BY name, unit
""")
def nutriment_pivot(spark, sf):
    """Flat keys of every line item pivoted; a key with two suffixes fills two nutrients."""
    docs = spread_table(spark, sf, "lineitem").selectExpr(_FLAT_NUTRIENTS + " AS t")
    rows = exploded(nutriments.pivoted(docs, "t", "p"), [], "p", "n").select("n.*")

    def cents(column: str):
        return F.sum(F.round(F.col(column).cast("double") * 100).cast("bigint"))

    return rows.groupBy("name", "unit").agg(
        F.count("*").alias("n"), cents("`100g`").alias("per_100g"), cents("serving").alias("serving"),
        cents("value").alias("value"), cents("prepared_value").alias("prepared_value"),
    )


_SET_TEXT = (
    "concat('{\"aggregated_set\":{\"nutrients\":{\"salt\":{\"unit\":\"g\",\"value\":', p_size, '.5,\"source\":\"x\"},"
    "\"fat\":{\"unit\":\"mg\",\"value\":', p_size, '}},\"per\":\"', CASE p_size % 3 WHEN 0 THEN '100g' WHEN 1 THEN '100ml' ELSE 'serving' END, "
    "'\",\"preparation\":\"', CASE WHEN p_type = 'PROMO' THEN 'prepared' ELSE 'as_sold' END, '\"},\"input_sets\":[]}')"
)


def _nutrient_view(rows, key):
    return rows.select(
        key, "n.name", F.col("n.`100g`").cast("double").alias("per_100g"), F.col("n.serving").cast("double").alias("serving"),
        "n.unit", F.col("n.prepared_100g").cast("double").alias("prepared_100g"),
        F.col("n.prepared_serving").cast("double").alias("prepared_serving"), "n.prepared_unit",
    )


@catalog.query("""
    SELECT p_partkey, name,
           CASE WHEN sold AND per100 THEN v END AS per_100g, CASE WHEN sold AND NOT per100 THEN v END AS serving,
           CASE WHEN sold THEN u END AS unit, CASE WHEN NOT sold AND per100 THEN v END AS prepared_100g,
           CASE WHEN NOT sold AND NOT per100 THEN v END AS prepared_serving, CASE WHEN NOT sold THEN u END AS prepared_unit
    FROM (
        SELECT p_partkey, p_type <> 'PROMO' AS sold, p_size % 3 <> 2 AS per100, 'salt' AS name, p_size + 0.5::DOUBLE AS v, 'g' AS u FROM part
        UNION ALL SELECT p_partkey, p_type <> 'PROMO', p_size % 3 <> 2, 'fat', p_size::DOUBLE, 'mg' FROM part)
""")
def nutrition_v3(spark, sf):
    docs = table(spark, sf, "part").selectExpr("p_partkey", _SET_TEXT + " AS t")
    rows = exploded(docs, ["p_partkey"], nutriments.aggregated_nutrients("t"), "n")
    return _nutrient_view(rows, "p_partkey")


@catalog.query("""
    SELECT CAST(p_partkey AS VARCHAR) AS code,
           CASE p_size % 4 WHEN 0 THEN 999 WHEN 1 THEN 1002 WHEN 2 THEN 1003 END AS schema_version,
           CASE p_size % 4 WHEN 0 THEN 'sugars' WHEN 1 THEN 'sugars' WHEN 2 THEN 'salt|fat' END AS nutrients,
           CASE p_size % 4 WHEN 3 THEN 'nutriments' ELSE '' END AS errors
    FROM part
""")
def version_dispatch(spark, sf):
    """Version absent, old, new with a set, and new with a stray flat object (refused)."""
    lines = spread_table(spark, sf, "part").select(
        F.expr(
            "concat('{\"code\":\"', p_partkey, '\"', CASE p_size % 4 WHEN 0 THEN ',\"nutriments\":{\"sugars_100g\":1}' "
            "WHEN 1 THEN ',\"schema_version\":1002,\"nutriments\":{\"sugars_100g\":1}' "
            f"WHEN 2 THEN concat(',\"schema_version\":1003,\"nutrition\":', {_SET_TEXT}) "
            "ELSE ',\"schema_version\":1003,\"nutriments\":{\"sugars_100g\":1}' END, '}')"
        ).alias("line")
    )
    rows = plan.parse_products(lines, "food")
    fine = F.size("_errors") == 0
    return rows.select(
        "code", F.when(fine, F.col("schema_version")).alias("schema_version"),
        F.expr("array_join(transform(nutriments, x -> x.name), '|')").alias("nutrients"),
        F.array_join("_errors", ",").alias("errors"),
    )


_PART_NUTRIENTS = (
    "concat('{\"sugars_unit\":\"g\",\"sugars_100g\":', p_size, ',\"fat_serving\":', p_size, '.5,\"fat_unit\":\"mg\",\"iron_100g\":1}')"
)


def _part_nutrients(spark, sf):
    docs = table(spark, sf, "part").selectExpr("p_partkey", f"{_PART_NUTRIENTS} AS t")
    return nutriments.pivoted(docs, "t", "n").select("p_partkey", "n")


@catalog.query("""
    SELECT p_partkey, 'fat|iron|sugars' AS names, p_size::DOUBLE AS sugars, 'mg' AS fat_unit FROM part
""")
def nutrient_index(spark, sf):
    indexed = _part_nutrients(spark, sf).select(
        "p_partkey", F.array_join(F.expr(nutriments.nutrient_names("n")), "|").alias("names"),
        F.expr(nutriments.nutrient_index("n")).alias("m"),
    )
    return indexed.selectExpr(
        "p_partkey", "names", "CAST(m['sugars'].`100g` AS DOUBLE) AS sugars", "m['fat'].unit AS fat_unit"
    )


@catalog.query("""
    SELECT p_partkey, 'sugars' AS name, p_size::DOUBLE AS per_100g, 'g' AS unit, NULL::DOUBLE AS serving FROM part
    UNION ALL SELECT p_partkey, 'fat', NULL, 'mg', p_size + 0.5 FROM part
""")
def nutrient_filter(spark, sf):
    rows = nutrient_rows(_part_nutrients(spark, sf), "p_partkey", "n", ["fat", "sugars", "salt"])
    return rows.select(
        "p_partkey", "name", F.col("100g").cast("double").alias("per_100g"), "unit",
        F.col("serving").cast("double").alias("serving"),
    )


# --- ingredients ---------------------------------------------------------------------------------

_NESTED_TEXT = """concat('[{"text":"', r_name, '","unknown":1,"id":"r', r_regionkey, '","ingredients":[{"id":"n', n_nationkey,
    '","percent":"', s_nationkey, '","ingredients":[{"percent_max":', s_acctbal, ',"is_in_taxonomy":', s_suppkey, ',"text":"', s_name,
    '"}]}]},{"id":"end","ingredients":[]}]')"""


def _nested(spark, sf):
    """Supplier inside nation inside region, as an ingredient list."""
    joined = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return _docs(joined, "s_suppkey", _NESTED_TEXT)


def _finished(drafts, helper):
    """Drafts settled in the JVM; only rows that nest deeper pass through the helper."""
    deep = F.expr(f"coalesce({ingredients.too_deep('t')}, false)")
    shallow = drafts.filter(~deep).select("s_suppkey", F.expr(ingredients.settle("t")).alias("ingredients"))
    rest = drafts.filter(deep).select("s_suppkey", helper(F.to_json("d")).alias("ingredients"))
    return shallow.unionByName(rest)


def _ingredient_sql(**given: str) -> str:
    """SQL text of one written-out ingredient."""
    parts = ["'\"" + name + "\":' || " + given.get(name, "'null'") for name, _ in ingredient_fields()]
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


_GEO_SQL = "FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_LEAF = _ingredient_sql(percent_max="CAST(s_acctbal AS VARCHAR)", is_in_taxonomy="CAST(s_suppkey AS VARCHAR)", text="'\"' || s_name || '\"'")
_MIDDLE = _ingredient_sql(id="'\"n' || n_nationkey || '\"'", percent="s_nationkey || '.0'", ingredients=f"'[' || {_LEAF} || ']'")
_TOP = _ingredient_sql(id="'\"r' || r_regionkey || '\"'", text="'\"' || r_name || '\"'", ingredients=f"'[' || {_MIDDLE} || ']'")
_END = _ingredient_sql(id="'\"end\"'", ingredients="'[]'")


@catalog.query(f"SELECT s_suppkey, '[' || {_TOP} || ',' || {_END} || ']' AS ingredients {_GEO_SQL}")
def ingredients_json(spark, sf):
    drafts = _nested(spark, sf).select("s_suppkey", "d", F.expr(ingredients.ingredients_draft("d")).alias("t"))
    return _finished(drafts, ingredients.deep_ingredients)


def _deep_sql() -> str:
    """``nest``: the text of supplier ingredients inside 1 + s_suppkey % 11 more levels."""
    level = _ingredient_sql(id="'\"k' || k || '\"'", ingredients="'[' || inner_text || ']'")
    leaf = _ingredient_sql(text="'\"' || s_name || '\"'", is_in_taxonomy="CAST(s_suppkey AS VARCHAR)")
    return f"""
        WITH RECURSIVE nest AS (
            SELECT s_suppkey, 0 AS k, s_suppkey % 11 + 1 AS top, {leaf} AS inner_text FROM supplier
            UNION ALL
            SELECT s_suppkey, k + 1, top, {level.replace("|| k ||", "|| (k + 1) ||")} FROM nest WHERE k < top)
        SELECT s_suppkey, CASE WHEN s_suppkey % 5 <> 0 THEN '[' || inner_text || ']' END AS ingredients FROM nest WHERE k = top"""


@catalog.query(_deep_sql())
def ingredients_deep(spark, sf):
    """Two to twelve levels; every fifth list holds a number too large at its deepest level and is refused."""
    suppliers = spread_table(spark, sf, "supplier")
    leaf = "concat('{\"text\":\"', s_name, '\",\"is_in_taxonomy\":', CASE WHEN s_suppkey % 5 = 0 THEN '99999999999999999999' ELSE CAST(s_suppkey AS STRING) END, '}')"
    nested = f"aggregate(sequence(1, CAST(s_suppkey % 11 + 1 AS INT)), {leaf}, (t, k) -> concat('{{\"id\":\"k', k, '\",\"ingredients\":[', t, ']}}'))"
    docs = suppliers.select("s_suppkey", F.expr(f"parse_json(concat('[', {nested}, ']'))").alias("d"))
    return _finished(docs.select("s_suppkey", "d", F.expr(ingredients.ingredients_draft("d")).alias("t")), ingredients.deep_ingredients)


@catalog.query(f"SELECT s_suppkey, 'r' || r_regionkey AS first_id, 'end' AS second_id, r_name AS first_text {_GEO_SQL}")
def ingredient_nth(spark, sf):
    texts = _nested(spark, sf).select("s_suppkey", F.to_json("d").alias("t"))
    nth = texts.select("s_suppkey", F.expr(nth_ingredient("t", 0)).alias("a"), F.expr(nth_ingredient("t", 1)).alias("b"))
    return nth.selectExpr(
        "s_suppkey", "variant_get(a, '$.id', 'string') AS first_id", "variant_get(b, '$.id', 'string') AS second_id",
        "variant_get(a, '$.text', 'string') AS first_text",
    )


@catalog.query(f"""
    SELECT s_suppkey, '[{{"id":"r' || r_regionkey || '","text":"' || r_name || '","ingredients":[{{"id":"n' || n_nationkey
           || '","ingredients":[{{"text":"' || s_name || '"}}]}}]}},{{"id":"end","ingredients":null}}]' AS ingredients {_GEO_SQL}
""")
def ingredient_prune(spark, sf):
    drafts = _nested(spark, sf).select("s_suppkey", "d", F.expr(ingredients.pruned_draft("d")).alias("t"))
    return _finished(drafts, ingredients.deep_pruned)


# --- dumps ----------------------------------------------------------------------------------------


@catalog.query("""
    SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS product_name, p_type || chr(9) || 'x' AS quantity, p_brand AS brands,
           'say "' || p_type || '"' AS nutrition_grade_fr, p_size AS nova_group,
           CASE WHEN p_size > 10 THEN 'a' END AS environmental_score_grade
    FROM part
""")
def mobile_dump(spark, sf):
    """The seven-column dump, written as gzipped TSV and read back."""
    products = table(spark, sf, "part").selectExpr(
        "CAST(p_partkey AS STRING) AS code",
        "array(named_struct('lang', 'fr', 'text', 'autre'), named_struct('lang', 'main', 'text', p_name)) AS product_name",
        "concat(p_type, char(9), 'x') AS quantity", "p_brand AS brands",
        "concat('say \"', p_type, '\"') AS nutriscore_grade", "p_size AS nova_group",
        "CASE WHEN p_size > 10 THEN 'a' END AS environmental_score_grade", "p_retailprice AS unused",
    )
    target = scratch_path(spark, "mobile")
    dump = mobile_columns(products)
    write_tsv(dump, target)
    return read_tsv(spark, target, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dump.schema))
