"""The price export."""

import datetime
import hashlib
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from larder.operators.joins import last_wins_rows, lookup_join
from larder.plans.prices import export_prices, parse_prices, parse_proofs, strict
from larder.schemas import price_schema

PRICES = [
    {"id": 1, "type": "PRODUCT", "price": "1.25", "proof_id": 10, "location_id": 20, "owner": "ann", "date": "2024-02-01",
     "created": "2024-02-01T10:00:00Z", "updated": "2024-02-01T12:00:00+02:00", "labels_tags": ["a"], "price_is_discounted": False},
    {"id": 2, "type": "CATEGORY", "price": 3, "proof_id": None, "location_id": 20, "location_osm_id": 7},
    {"id": 3, "type": "PRODUCT", "price": None, "location_id": None},
]
PROOFS = [
    {"id": 10, "type": "RECEIPT", "file_path": "old", "owner": "bob"},
    {"id": 10, "type": "RECEIPT", "file_path": "new", "owner": "bob", "receipt_price_total": 9.5},
    {"id": 11, "type": "RECEIPT"},
]
LOCATIONS = [{"id": 20, "type": "OSM", "osm_id": 5, "osm_lat": 48.5, "osm_address_city": "Paris"}]


def write(tmp_path, prices=PRICES, proofs=PROOFS, locations=LOCATIONS):
    paths = {}
    for name, rows in (("price", prices), ("proof", proofs), ("location", locations)):
        path = tmp_path / f"{name}.jsonl"
        path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))
        paths[name] = str(path)
    return paths


def test_export(spark, tmp_path):
    target = str(tmp_path / "out")
    export_prices(spark, write(tmp_path), target)
    out = spark.read.parquet(target)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in price_schema()]
    rows = {r.id: r for r in out.collect()}
    one = rows[1]
    assert one.price == Decimal("1.250") and one.date == datetime.date(2024, 2, 1)
    assert one.created == one.updated == datetime.datetime(2024, 2, 1, 10)
    assert (one.proof_file_path, one.proof_receipt_price_total) == ("new", Decimal("9.500"))
    assert (one.owner, one.proof_owner) == tuple(hashlib.sha256(n).hexdigest()[:8] for n in (b"ann", b"bob"))
    assert (one.location_osm_lat, one.location_osm_address_city, one.location_osm_id) == (48.5, "Paris", None)
    assert rows[2].proof_type is None and rows[2].location_type == "OSM" and rows[2].location_osm_id == 7
    assert rows[3].location_type is None and rows[3].price is None


BAD = [
    (dict(prices=PRICES + [{"id": 4, "price": 1}]), "type"),
    (dict(prices=PRICES + [{"id": 4, "type": "P", "price": "1.2345"}]), "price"),
    (dict(prices=PRICES + ['{"id": 4']), "json"),
    (dict(proofs=PROOFS + [{"id": 12, "type": None}]), "type"),
    (dict(locations=LOCATIONS + [{"id": 21, "type": "OSM", "osm_lat": "north"}]), "osm_lat"),
    (dict(proofs=PROOFS + [{"type": "RECEIPT"}]), "id"),
    (dict(locations=LOCATIONS + [{"id": None, "type": "OSM"}]), "id"),
    (dict(prices=PRICES + [{"id": 4, "type": "P", "proof_id": 99}]), "unknown proof_id: 99"),
    (dict(prices=PRICES + [{"id": 4, "type": "P", "location_id": 99}]), "unknown location_id: 99"),
]


@pytest.mark.parametrize("change, message", BAD)
def test_one_bad_record_stops_the_export(spark, tmp_path, change, message):
    with pytest.raises(Exception, match=message):
        export_prices(spark, write(tmp_path, **change), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_quarantine(spark, tmp_path):
    sources = write(
        tmp_path,
        prices=PRICES + [{"id": 4, "type": "P", "proof_id": 99}, {"id": 5}, {"id": 6, "type": "P", "location_id": 21},
                         {"id": 7, "price": "x", "proof_id": 98, "location_id": 97}],
        locations=LOCATIONS + [{"id": 21}],
    )
    export_prices(spark, sources, str(tmp_path / "out"), "quarantine", str(tmp_path / "bad"))
    assert {r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {1, 2, 3}
    bad = {(r.record, tuple(r.errors)) for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert bad == {("price", ("unknown proof_id",)), ("price", ("type",)), ("location", ("type",)), ("price", ("unknown location_id",)),
                   ("price", ("price", "type", "unknown proof_id", "unknown location_id"))}
    assert spark.read.parquet(str(tmp_path / "bad")).count() == len(bad)


def test_null_keys_are_spread(spark):
    """The second join key keeps rows without a key from meeting in one task."""
    facts = spark.range(1000).selectExpr("id", "CASE WHEN id < 10 THEN CAST(id AS INT) END AS k")
    lookup = spark.range(10).selectExpr("id", "id * 2 AS x")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(facts, lookup, "k", "id", ["x"], "l_", F.xxhash64("id"))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "_spread" in [l for l in plan.split("\n") if "SortMergeJoin" in l][0]
        rows = joined.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(rows) == 1000 and all(r.l_x == (r.k * 2 if r.k is not None else None) for r in rows)


def test_last_wins_rows(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "d", 1)], "id int, x string, pos int")
    assert {(r.id, r.x) for r in last_wins_rows(df, "id", "pos").collect()} == {(1, "b"), (2, "d")}
    assert {(r.id, r.x) for r in last_wins_rows(df, "id", "pos", unique=True).collect()} == {(1, "b"), (2, "d")}


def test_last_wins_rows_ties_and_nulls(spark):
    """The rest of the order ranks ties; a null order is least, a null key is a key."""
    rows = [(1, 5, "a", "x"), (1, 5, "b", "y"), (1, None, "z", "z"), (2, None, "c", "x"), (2, None, "d", "y"), (None, 1, "e", "x"), (None, 2, "f", "y")]
    df = spark.createDataFrame(rows, "id int, n int, s string, x string")
    expected = {(1, "y"), (2, "y"), (None, "y")}
    for frame in (last_wins_rows(df, "id", ["n", "s"]), last_wins_rows(df.withColumn("pos", F.struct("n", "s")), "id", "pos")):
        assert {(r.id, r.x) for r in frame.collect()} == expected
        assert "SortAggregate" not in frame._jdf.queryExecution().executedPlan().toString()


def test_input_only_fields_are_checked(lines):
    from larder.plans.prices import parse_locations

    row = parse_locations(lines({"id": 1, "type": "OSM", "osm_name": 5})).select("_errors").head()
    assert row._errors == ["osm_name"]


def test_price_types(lines):
    row = parse_prices(lines({"id": "7", "type": "P", "receipt_quantity": "2.5", "price_is_discounted": "yes", "location_id": 3.0})).head()
    assert (row.id, row.receipt_quantity, row.price_is_discounted, row.location_id, row._errors) == (7, 2.5, True, 3, [])


def test_hot_key_is_split(spark):
    """A key held by half the rows is spread over tasks when the join runs."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    facts = spark.range(0, 40000, 1, 16).selectExpr(
        "id", "CASE WHEN id % 2 = 0 THEN 7 ELSE CAST(id % 1000 AS INT) END AS k", "sha2(CAST(id AS STRING), 256) AS payload"
    )
    lookup = spark.range(1000).selectExpr("id", "id * 2 AS x")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = lookup_join(facts, lookup, "k", "id", ["x"], "l_", F.xxhash64("id"))
        execution = joined._jdf.queryExecution()
        assert execution.toRdd().count() == 40000
        assert "skew=true" in execution.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_strict_holds_for_every_selection(spark):
    lines = spark.createDataFrame([('{"type": "RECEIPT", "owner": "x"}',)], "line string")
    for read in (lambda df: df.select("owner").collect(), lambda df: df.count()):
        with pytest.raises(Exception, match="bad proof: id"):
            read(strict(parse_proofs(lines), "proof"))


def test_large_lookups_are_hashed_by_partition(spark):
    """Neither side is sorted; rows without a key and with an unknown one stay."""
    facts = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id INT, k INT")
    lookup = spark.createDataFrame([(10, "x"), (11, "y")], "id INT, x STRING")
    joined = lookup_join(facts, lookup, "k", "id", ["x"], "l_", F.xxhash64("id"), unknown="bad", hashed=True)
    assert {tuple(r) for r in joined.select("id", "l_x", "bad").collect()} == {(1, "x", False), (2, None, False), (3, None, True)}
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort " not in plan
