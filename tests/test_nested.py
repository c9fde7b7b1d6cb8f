"""Nested reshaping: languages, images, nutrients, ingredients, small members."""

import json
import random

import pytest
from pyspark.sql import functions as F

from larder.functions.variants import last_wins, let
from larder.operators import images, ingredients, language, members, nutriments

FIELDS = ("ingredients_text", "product_name", "packaging_text", "generic_name")


def value(spark, sql, text):
    """One expression over one JSON text, bound as ``t`` (text) and ``v`` (VARIANT)."""
    df = spark.createDataFrame([(text,)], "t string").withColumn("v", F.expr("try_parse_json(t)"))
    x = df.select(F.expr(sql).alias("x")).head().x
    return json.loads(json.dumps(_plain(x)))


def _plain(x):
    if hasattr(x, "asDict"):
        return {k: _plain(y) for k, y in x.asDict().items()}
    if isinstance(x, list):
        return [_plain(y) for y in x]
    return x


def languages(spark, doc, field="product_name"):
    df = spark.createDataFrame([(json.dumps(doc),)], "t string").withColumn("m", F.expr("from_json(t, 'map<string,variant>')"))
    entries = let(language.language_members("m", FIELDS), "q", last_wins("q"))
    df = df.select(F.expr(f"element_at(m, '{field}')").alias("main"), F.expr(entries).alias("e"))
    rows = df.select(F.expr(language.language_list("main", "e", field)).alias("x")).head().x
    return [(r.lang, r.text) for r in rows]


def test_language_main_first_then_document_order(spark):
    doc = {"product_name_fr": "b", "product_name": "a", "product_name_de": "c", "generic_name_fr": "z"}
    assert languages(spark, doc) == [("main", "a"), ("fr", "b"), ("de", "c")]


def test_language_suffix_rules(spark):
    doc = {"product_name_debug": "x", "product_name_with_notes_fr": "y", "product_name_fr": "", "product_name_es": None,
           "product_name_": "q", "product_name_it": []}
    assert languages(spark, doc) == [("fr", "y")]


def test_language_misfits(spark):
    assert languages(spark, {"product_name_fr": 7}) == [("fr", None)]
    assert languages(spark, {"product_name": 1664}) == [("main", None)]
    assert languages(spark, {"product_name": 0}) == []
    assert languages(spark, {}) == []


def test_flat_images(spark):
    doc = {
        "12": {"uploader": "zoe", "uploaded_t": 1700000005, "sizes": {"full": {"h": 9, "w": 8}}},
        "other_ja": {"imgid": 12, "rev": "44", "angle": "90", "sizes": {"200": {"h": "20", "w": 11}, "300": {"h": 1, "w": 1}, "full": {"h": 9, "w": 8}}},
    }
    none = {"100": None, "200": None, "400": None}
    assert value(spark, images.images_array("t"), json.dumps(doc)) == [
        {"key": "12", "imgid": None, "rev": None, "sizes": {**none, "full": {"h": 9, "w": 8}}, "uploaded_t": 1700000005, "uploader": "zoe"},
        {"key": "other_ja", "imgid": 12, "rev": 44, "sizes": {**none, "200": {"h": 20, "w": 11}, "full": {"h": 9, "w": 8}}, "uploaded_t": None, "uploader": None},
    ]


def test_grouped_images(spark):
    """Uploads keep their id, selections are named by kind and language."""
    doc = {
        "uploaded": {"7": {"uploaded_t": "1700000009", "sizes": {"400": {"h": 3, "w": 4, "url": "u"}}}},
        "selected": {"packaging": {"pt": {"imgid": "7", "rev": 5}, "sv": {"imgid": "7", "rev": 6, "generation": {"coordinates_image_size": "full"}}}},
    }
    rows = value(spark, images.images_array("t"), json.dumps(doc))
    assert [(r["key"], r["imgid"], r["rev"], r["uploaded_t"]) for r in rows] == [
        ("7", None, None, 1700000009), ("packaging_pt", 7, 5, None), ("packaging_sv", 7, 6, None)
    ]
    assert rows[0]["sizes"] == {"100": None, "200": None, "400": {"h": 3, "w": 4}, "full": None}


@pytest.mark.parametrize(
    "sizes, expected",
    [
        ({}, None), (None, None), ({"100": None}, None), ([], None),
        ({"50": {"h": 1, "w": 1}}, {"100": None, "200": None, "400": None, "full": None}),
        ({"100": {"h": "7"}, "200": {}}, {"100": {"h": 7, "w": None}, "200": None, "400": None, "full": None}),
    ],
)
def test_image_sizes(spark, sizes, expected):
    assert value(spark, images.images_array("t"), json.dumps({"1": {"sizes": sizes}}))[0]["sizes"] == expected


@pytest.mark.parametrize("image", [5, {"imgid": "x"}, {"sizes": "x"}, {"sizes": {"50": {"h": "x"}}}, {"sizes": {"100": 3}}, {"rev": 99999999999}])
def test_image_misfits(spark, image):
    assert value(spark, images.images_array("t"), json.dumps({"1": image})) == [None]


@pytest.mark.parametrize("text", ["{}", "[]", "null", "", "false", None])
def test_no_images(spark, text):
    assert value(spark, images.images_array("t"), text) == []


def named(rows):
    if not rows or rows == [None]:
        return rows
    return {r["name"]: {k: x for k, x in r.items() if x is not None and k != "name"} for r in rows}


def pivot(spark, doc):
    return named(value(spark, nutriments.pivot_suffixes("t"), json.dumps(doc) if doc is not None else None))


def test_pivot_simple(spark):
    doc = {"salt_100g": 0.5, "salt_unit": "g", "salt": 1, "fat_prepared_value": "2", "salt_serving": None}
    assert pivot(spark, doc) == {"salt": {"100g": 0.5, "unit": "g"}, "fat": {"prepared_value": 2.0}}


def test_pivot_edges(spark):
    assert pivot(spark, {}) is None
    assert pivot(spark, None) is None
    assert pivot(spark, {"salt": 1}) == []
    assert pivot(spark, {"x_100g_value": 3}) == {"x_100g": {"value": 3.0}, "x": {"100g": 3.0}}
    assert pivot(spark, {"salt_100g": "much"}) == [None]
    assert pivot(spark, {"salt_unit": 5}) == [None]
    assert pivot(spark, [1]) == [None]


def test_pivot_in_batches(spark):
    """Plain documents are pivoted outside the expression, the others by it; nothing differs."""
    values = ["1", "-0", "-2.5e-3", "1e400", "12345678901234567890", "16777217", '"1.50"', '" 5 "', '"much"', "null", "true", "[1]", "01"]
    keys = ["salt_100g", "x_100g_value", "x_prepared_prepared_100g", "_serving", "salt_unit", "salt"]
    texts = [f'{{"salt_value":2,"{k}":{v},"salt_prepared_unit":"g"}}' for k in keys for v in values]
    texts += [None, "", "{}", "{ }", "null", "[1]", '{"a_100g":1} x', '{"a_100g":1,"a_100g":2}', '{"a_unit":"\\ud800"}', '{"a_unit":"\u00e9"}']
    docs = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING")
    rows = nutriments.pivoted(docs, "t", "n").withColumn("e", F.expr(nutriments.pivot_suffixes("t"))).collect()
    assert {r.t: repr(r.n) for r in rows} == {r.t: repr(r.e) for r in rows}
    assert len(rows) == len(texts)
    plain = docs.filter(nutriments._pivot_plain("t")["plain"]).count()
    assert 20 < plain < len(texts)


# Key, then the (nutrient, slot) pairs it fills, written out by hand.
PIVOT_KEYS = {
    "zinc_value": [("zinc", "value")],
    "zinc_100g": [("zinc", "100g")],
    "zinc_serving": [("zinc", "serving")],
    "zinc_unit": [("zinc", "unit")],
    "zinc_prepared_value": [("zinc", "prepared_value")],
    "zinc_prepared_100g": [("zinc", "prepared_100g")],
    "zinc_prepared_serving": [("zinc", "prepared_serving")],
    "zinc_prepared_unit": [("zinc", "prepared_unit")],
    "omega-3-fat_100g": [("omega-3-fat", "100g")],
    "zinc": [],
    "zinc_100G": [],
    "100g": [],
    "zinc_label": [],
}


@pytest.mark.parametrize("key", PIVOT_KEYS)
def test_pivot_of_one_key(spark, key):
    text = key.endswith("unit")
    rows = value(spark, nutriments.pivot_suffixes("t"), json.dumps({key: "mg" if text else 4.25}))
    got = [(r["name"], slot) for r in rows for slot, x in r.items() if slot != "name" and x is not None]
    assert got == PIVOT_KEYS[key]


def test_pivot_of_many_keys(spark):
    """Slots of one nutrient meet, however they are mixed; 600 keys of 150 nutrients."""
    keys = [(f"n{k}", slot) for k in range(150) for slot in ("value", "100g", "unit", "prepared_serving")]
    random.Random(3).shuffle(keys)
    doc = {f"{name}_{slot}": "g" if slot == "unit" else float(len(name)) for name, slot in keys}
    rows = value(spark, nutriments.pivot_suffixes("t"), json.dumps(doc))
    assert sorted(r["name"] for r in rows) == sorted({n for n, _ in keys})
    for r in rows:
        filled = {slot: x for slot, x in r.items() if x is not None and slot != "name"}
        assert filled == {"value": len(r["name"]), "100g": len(r["name"]), "prepared_serving": len(r["name"]), "unit": "g"}


@pytest.mark.parametrize(
    "per, preparation, slot, unit",
    [("100g", "as_sold", "100g", "unit"), ("100ml", "as_sold", "100g", "unit"), ("serving", "as_sold", "serving", "unit"),
     ("100g", "prepared", "prepared_100g", "prepared_unit"), ("serving", "prepared", "prepared_serving", "prepared_unit")],
)
def test_aggregated_set(spark, per, preparation, slot, unit):
    doc = {"aggregated_set": {"nutrients": {"salt": {"unit": "g", "value": 0.5, "modifier": "<"}, "energy-kj": {"unit": "kJ", "value": 0}},
                              "per": per, "preparation": preparation}, "input_sets": [{}]}
    rows = value(spark, nutriments.aggregated_nutrients("t"), json.dumps(doc))
    assert [r["name"] for r in rows] == ["salt", "energy-kj"]
    filled = [{k: x for k, x in r.items() if x is not None and k != "name"} for r in rows]
    assert filled == [{slot: 0.5, unit: "g"}, {slot: 0.0, unit: "kJ"}]


@pytest.mark.parametrize("left_out, slot", [("per", "serving"), ("preparation", "prepared_100g")])
def test_aggregated_set_without_a_member(spark, left_out, slot):
    doc = {"nutrients": {"iron": {"unit": "mg", "value": 7}}, "per": "100g", "preparation": "as_sold"}
    del doc[left_out]
    rows = value(spark, nutriments.aggregated_nutrients("t"), json.dumps({"aggregated_set": doc}))
    assert [(r["name"], r[slot]) for r in rows] == [("iron", 7.0)]


@pytest.mark.parametrize("bad", [5, "set", [1], {}, {"nutrients": {}, "per": 5}, {"nutrients": {}, "preparation": True}, {"nutrients": [1]}])
def test_aggregated_set_misfits(spark, bad):
    assert value(spark, nutriments.aggregated_nutrients("t"), json.dumps({"aggregated_set": bad})) == [None]


def test_no_aggregated_set(spark):
    assert value(spark, nutriments.aggregated_nutrients("t"), '{"input_sets": []}') is None
    assert value(spark, nutriments.aggregated_nutrients("t"), None) is None


def test_nutrient_index_last_wins(spark):
    df = spark.sql("SELECT array(named_struct('name','b','v',1), named_struct('name','a','v',2), named_struct('name','b','v',3)) AS n")
    row = df.selectExpr(f"{nutriments.nutrient_index('n')} AS m", f"{nutriments.nutrient_names('n')} AS k").head()
    assert row.m["b"].v == 3 and row.k == ["a", "b"]


def nest(depth, leaf):
    for i in range(depth - 1):
        leaf = {"text": f"level {i}", "percent": i / 3, "ingredients": [leaf, {"id": "en:x"}]}
    return [leaf]


@pytest.mark.parametrize("depth", [1, 3, ingredients.DEPTH, ingredients.DEPTH + 1, ingredients.DEPTH + 5])
def test_ingredients_any_depth(spark, depth):
    doc = nest(depth, {"text": 'say "é"\n', "percent_min": 1e-7, "percent_max": "50", "is_in_taxonomy": 1.0, "unknown": 1})
    df = spark.createDataFrame([(json.dumps(doc),)], "t string").withColumn("v", F.expr("parse_json(t)"))
    df = df.select("v", F.expr(ingredients.ingredients_draft("v")).alias("d"))
    jvm = F.expr(ingredients.settle("d"))
    deep = F.expr(f"CASE WHEN {ingredients.too_deep('d')} THEN to_json(v) END")
    row = df.select(F.coalesce(jvm, ingredients.deep_ingredients(deep)).alias("x"), jvm.isNull().alias("deep")).head()
    assert row.x == ingredients._deep_text(json.dumps(doc))
    assert row.deep == (depth > ingredients.DEPTH)
    leaf = json.loads(row.x)[0]
    for _ in range(depth - 1):
        leaf = leaf["ingredients"][0]
    assert leaf["text"] == 'say "é"\n' and leaf["percent_max"] == 50.0 and leaf["is_in_taxonomy"] == 1
    assert list(leaf) == list(ingredients.FIELD_NAMES)


@pytest.mark.parametrize("bad", [["x"], [{"percent": "x"}], [{"text": 5}], [{"ingredients": {"a": 1}}], [{"ingredients": [{"quantity": 5}]}], {"a": 1}, [None]])
def test_ingredient_misfits(spark, bad):
    df = spark.createDataFrame([(json.dumps(bad),)], "t string").withColumn("v", F.expr("parse_json(t)"))
    df = df.select(F.expr(ingredients.ingredients_draft("v")).alias("d"))
    assert df.select(F.expr(ingredients.settle("d")).alias("x")).head().x is None
    assert not df.select(F.expr(f"coalesce({ingredients.too_deep('d')}, false)").alias("x")).head().x


@pytest.mark.parametrize("depth", [2, ingredients.DEPTH + 2])
@pytest.mark.parametrize(
    "bad", [{"is_in_taxonomy": 99999999999999999999}, {"is_in_taxonomy": "9223372036854775808"}, {"percent": "\u0661"}, {"text": 5}, {"ingredients": 3}]
)
def test_refused_alike_at_any_depth(spark, depth, bad):
    doc = nest(depth, bad)
    df = spark.createDataFrame([(json.dumps(doc),)], "t string").withColumn("v", F.expr("parse_json(t)"))
    df = df.select("v", F.expr(ingredients.ingredients_draft("v")).alias("d"))
    deep = F.expr(f"CASE WHEN {ingredients.too_deep('d')} THEN to_json(v) END")
    assert df.select(F.coalesce(F.expr(ingredients.settle("d")), ingredients.deep_ingredients(deep)).alias("x")).head().x is None


def test_empty_ingredient_lists(spark):
    assert value(spark, ingredients.ingredients_draft("v"), "[]") == "[]"
    text = value(spark, ingredients.ingredients_draft("v"), '[{"ingredients":[]}]')
    assert json.loads(text)[0]["ingredients"] == []


def pruned(spark, doc):
    df = spark.createDataFrame([(json.dumps(doc),)], "t string").withColumn("v", F.expr("parse_json(t)"))
    df = df.select("v", F.expr(ingredients.pruned_draft("v")).alias("d"))
    deep = F.expr(f"CASE WHEN {ingredients.too_deep('d')} THEN to_json(v) END")
    return json.loads(df.select(F.coalesce(F.expr(ingredients.settle("d")), ingredients.deep_pruned(deep)).alias("x")).head().x)


def test_pruned_ingredients(spark):
    doc = [{"id": "en:oat", "vegan": "yes", "percent": 60}, {"text": "icing", "ingredients": [{"id": "en:rye", "rank": 1, "ingredients": []}]}]
    assert pruned(spark, doc) == [{"id": "en:oat"}, {"text": "icing", "ingredients": [{"id": "en:rye", "ingredients": None}]}]


def test_pruned_ingredients_below_the_unrolled_levels(spark):
    doc = [{"id": "l7", "x": 7}]
    for level in range(6, 0, -1):
        doc = [{"id": f"l{level}", "x": level, "ingredients": doc}]
    found, seen = pruned(spark, doc), []
    while found:
        assert set(found[0]) <= {"id", "ingredients"} and len(found) == 1
        seen.append(found[0]["id"])
        found = found[0].get("ingredients")
    assert seen == [f"l{level}" for level in range(1, 8)]


def test_owner_fields(spark):
    assert value(spark, members.owner_fields("t"), '{"a":12,"b":"13"}') == [{"field_name": "a", "timestamp": 12}, {"field_name": "b", "timestamp": 13}]
    assert value(spark, members.owner_fields("t"), "{}") is None
    assert value(spark, members.owner_fields("t"), '{"a":null}') == [None]


def test_packagings(spark):
    rows = value(spark, members.packagings("v"), '[{"number_of_units":"2","weight_measured":1.5,"quantity_per_unit_value":25.0,"x":1}]')
    assert rows[0]["number_of_units"] == 2 and rows[0]["quantity_per_unit_value"] == "25.0" and rows[0]["weight_measured"] == 1.5
    assert value(spark, members.packagings("v"), '[{"shape":5}]') == [None]
    assert value(spark, members.packagings("v"), '["x"]') == [None]
    assert value(spark, members.packagings("v"), '{"shape":"x"}') is None
    assert value(spark, members.packagings("v"), "[]") == []


@pytest.mark.parametrize(
    "doc, expected",
    [
        ({"ciqual_food_code:en": "12"}, 12), ({"ciqual_food_cod": 7}, 7), ({"ciqual_food_code": 5.0}, 5), ({"ciqual_food_code:en": None}, "null"),
        ({"ciqual_food_code": 1, "ciqual_food_code:en": 2}, 2), ({"ciqual_food_name:en": "x"}, None), ({"ciqual_food_code:fr": 1}, None),
        ({"ciqual_food_code": "x"}, None), ([1], None),
    ],
)
def test_category_codes(spark, doc, expected):
    codes = value(spark, members.category_codes("t"), json.dumps(doc))
    if expected is None:
        assert codes is None
    else:
        assert codes["ciqual_food_code"] == (None if expected == "null" else expected)


@pytest.mark.parametrize("depth, fits", [(200, True), (5000, False)])
def test_deeper_than_python_nests(depth, fits):
    """A list nested beyond the interpreter's stack refuses its row instead of ending the job."""
    from larder.operators.ingredients import _deep_text

    text = '[{"text":"a","ingredients":' * depth + "[]" + "}]" * depth
    assert (_deep_text(text) is not None) == fits
