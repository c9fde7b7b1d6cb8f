"""The product export end to end."""

import gzip
import json
import random
from pathlib import Path

import pytest

from larder.plans import products as plan
from larder.schemas import product_schema

DEEP = {"text": "leaf"}
for _ in range(8):
    DEEP = {"text": "wrap", "ingredients": [DEEP]}

REFUSED = [
    ({"brands": "no code"}, ["code"]),
    ({"code": 5}, ["code"]),
    ({"code": "a", "brands_tags": ["x", None]}, ["brands_tags"]),
    ({"code": "b", "max_imgid": 99999999999}, ["overflow:max_imgid"]),
    ({"code": "c", "schema_version": None}, ["nutriments", "schema_version"]),
    ({"code": "d", "schema_version": "999"}, ["nutriments"]),
    ({"code": "e", "schema_version": 1003, "nutriments": {"salt_100g": 1}}, ["nutriments"]),
    ({"code": "f", "schema_version": 1003, "nutrition": None}, ["nutriments"]),
    ({"code": "g", "product_name_fr": 5}, ["product_name"]),
    ({"code": "h", "images": "x"}, ["images"]),
    ({"code": "i", "images": {"1": {"rev": "x"}}}, ["images"]),
    ({"code": "j", "nutriments": {"salt_100g": "x"}}, ["nutriments"]),
    ({"code": "k", "nutriments": [1]}, ["nutriments"]),
    ({"code": "l", "categories_properties": {"other": 1}}, ["categories_properties"]),
    ({"code": "m", "environmental_score_data": [1]}, ["environmental_score_data"]),
    ({"code": "n", "owner_fields": {"a": None}}, ["owner_fields"]),
    ({"code": "o", "packagings": [{"shape": 1}]}, ["packagings"]),
    ({"code": "p", "packagings": {"shape": "x"}}, ["packagings"]),
    ({"code": "q", "ingredients": [{"text": 1}]}, ["ingredients"]),
    ({"code": "r", "ingredients": {"text": "x"}}, ["ingredients"]),
    ({"code": "s", "environmental_score_score": "5.5"}, ["environmental_score_score"]),
    ({"code": "t", "nova_groups": 0}, ["nova_groups"]),
    ('{"code": "u"', ["json"]),
    ('["code"]', ["json"]),
    ('{"code": "v"} tail', ["json"]),
    ("", ["json"]),
]
ACCEPTED = [
    {"code": "1"},
    {"code": "2", "images": [], "nutriments": [], "owner_fields": "", "nutrition": 5},
    {"code": "3", "schema_version": 1003, "nutriments": None},
    {"code": "4", "schema_version": 1003, "nutriments": []},
    {"code": "5", "schema_version": 1004.0, "nutrition": {"aggregated_set": {"nutrients": {"salt": {"value": 1, "unit": "g"}}, "per": "100g", "preparation": "as_sold"}}, "nutriments": {"x_100g": 1}},
    {"code": "6", "ingredients": [DEEP]},
    {"code": "7", "brands": None, "unknown": {"a": [1]}, "obsolete": True, "no_nutrition_data": None},
    {"code": "8", "environmental_score_score": 7.9, "nova_groups": 4, "rev": "12", "completeness": "0.5", "packagings_complete": 1},
    '{"code": "9", "rev": 1, "rev": 2}',
]


@pytest.fixture(scope="module")
def parsed(spark):
    texts = [d if isinstance(d, str) else json.dumps(d) for d in [r for r, _ in REFUSED] + ACCEPTED]
    df = spark.createDataFrame([(t,) for t in texts], "line string")
    return {r.line: r for r in plan.parse_products(df, "food").collect()}


def of(parsed, doc):
    return parsed[doc if isinstance(doc, str) else json.dumps(doc)]


@pytest.mark.parametrize("doc, errors", REFUSED)
def test_refused(parsed, doc, errors):
    assert of(parsed, doc)._errors == errors


@pytest.mark.parametrize("doc", ACCEPTED)
def test_accepted(parsed, doc):
    assert of(parsed, doc)._errors == []


def test_values(parsed):
    rows = [of(parsed, d) for d in ACCEPTED]
    assert (rows[0].schema_version, rows[0].obsolete, rows[0].no_nutrition_data) == (999, False, None)
    assert (rows[0].images, rows[0].product_name, rows[0].nutriments, rows[0].owner_fields) == ([], [], None, None)
    assert (rows[1].images, rows[1].nutriments, rows[1].owner_fields) == ([], None, None)
    assert rows[2].nutriments is None and [n.name for n in rows[4].nutriments] == ["salt"]
    assert rows[5].ingredients is None and json.loads(rows[5]._deep) == [DEEP]
    assert rows[6].obsolete is False and rows[6].no_nutrition_data is False and rows[6].brands is None
    assert (rows[7].environmental_score_score, rows[7].nova_groups, rows[7].rev, rows[7].completeness, rows[7].packagings_complete) == (7, "4", 12, 0.5, True)
    assert rows[8].rev == 2


def test_beauty_takes_text_versions(lines):
    rows = plan.parse_products(lines({"code": "1", "schema_version": "999", "nutriments": "kept out"}), "beauty")
    row = rows.select("schema_version", "_errors").head()
    assert (row.schema_version, row._errors) == (999, [])


@pytest.mark.parametrize("flavor, columns", [("food", 111), ("beauty", 91)])
def test_export(spark, tmp_path, flavor, columns):
    source = tmp_path / "in.jsonl.gz"
    docs = [{"code": "1", "product_name": "a", "ingredients": [DEEP]}, {"code": "2", "brands_tags": "x"}, {"code": "3"}]
    with gzip.open(source, "wt") as fp:
        fp.write("\n".join(map(json.dumps, docs)) + "\n")
    target, refused = str(tmp_path / "out.parquet"), str(tmp_path / "refused")
    for _ in range(2):  # a second run replaces the first
        report = plan.export_products(spark, str(source), target, flavor, refused)
        assert (report.read, report.kept, report.refused, report.reasons) == (3, 2, 1, {"brands_tags": 1})
    out = spark.read.parquet(target)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in product_schema(flavor)]
    assert len(out.columns) == columns
    rows = {r.code: r for r in out.collect()}
    assert set(rows) == {"1", "3"}
    leaf = json.loads(rows["1"].ingredients)
    while leaf[0]["ingredients"]:
        leaf = leaf[0]["ingredients"]
    assert leaf[0]["text"] == "leaf"
    bad = spark.read.parquet(refused).collect()
    assert [(r.code, r.errors, json.loads(r.line)) for r in bad] == [("2", ["brands_tags"], docs[1])]


def test_good_rows_are_written_once(spark, tmp_path, monkeypatch):
    """Bytes written by all jobs of an export, next to those of its output."""
    source = tmp_path / "in.jsonl"
    rng = random.Random(2)
    docs = [{"code": str(n), "brands": rng.randbytes(500).hex(), "ingredients": [DEEP] if n % 200 == 0 else []} for n in range(2000)]
    docs[1::100] = [{"code": f"bad {n}", "rev": "x"} for n in range(20)]
    source.write_text("".join(json.dumps(d) + "\n" for d in docs))
    written = []
    delete = plan.delete_path
    monkeypatch.setattr(plan, "delete_path", lambda s, path: (written.append(sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))), delete(s, path)))
    report = plan.export_products(spark, str(source), str(tmp_path / "out"), "beauty", str(tmp_path / "refused"))
    assert (report.read, report.kept, report.reasons) == (2000, 1980, {"rev": 20})
    kept = sum(f.stat().st_size for f in (tmp_path / "out").rglob("*.parquet"))
    # What is left in the staging folder when all is in place was written besides the output.
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1980 and written[0] < 0.1 * kept


def test_refused_deep_lists(spark, tmp_path):
    """A list that only the last step can refuse, alone and beside another fault."""
    bad = json.loads(json.dumps(DEEP).replace('"leaf"', "5"))
    docs = [{"code": "1", "ingredients": [bad]}, {"code": "2", "ingredients": [bad], "rev": "x"}, {"code": "3", "ingredients": [DEEP], "rev": "x"}, {"code": "4", "ingredients": [DEEP]}]
    (tmp_path / "in.jsonl").write_text("".join(json.dumps(d) + "\n" for d in docs))
    report = plan.export_products(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "out"), "food", str(tmp_path / "refused"))
    assert (report.read, report.kept, report.refused, report.reasons) == (4, 1, 3, {"rev": 2, "ingredients": 2})
    rows = {r.code: r for r in spark.read.parquet(str(tmp_path / "refused")).collect()}
    assert {c: r.errors for c, r in rows.items()} == {"1": ["ingredients"], "2": ["rev", "ingredients"], "3": ["rev"]}
    assert json.loads(rows["3"].line) == docs[2] and [r.code for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["4"]


def test_overflow_can_stop_the_export(spark, tmp_path):
    source = tmp_path / "in.jsonl"
    source.write_text('{"code": "1", "rev": 99999999999}\n')
    with pytest.raises(OverflowError):
        plan.export_products(spark, str(source), str(tmp_path / "out"), "beauty", on_overflow="fail")
    assert not (tmp_path / "out").exists()


def test_bad_calls(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        plan.export_products(spark, str(tmp_path / "none.jsonl"), str(tmp_path / "out"), "food")
    with pytest.raises(ValueError):
        plan.export_products(spark, str(tmp_path / "none.jsonl"), str(tmp_path / "out"), "petfood")


def test_each_line_is_parsed_twice_at_most(lines):
    """A filter on the checked rows must not repeat the parse below."""
    good = plan.good_rows(plan.parse_products(lines({"code": "1"}), "beauty"), "beauty").select("code")
    text = good._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json(StructField(additives_n") == 1
    assert "Exchange" not in text
