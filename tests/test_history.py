"""Revision history."""

import gzip
import json
import re

import pytest
from pyspark.sql import functions as F

from larder.operators import history
from larder.plans.history import export_events

SCHEMA = "code string, rev_id long, timestamp long, product_type string, comment string, diffs string, product string"


def revisions(spark, *rows):
    def text(x):
        return x if x is None or isinstance(x, str) else json.dumps(x)

    return spark.createDataFrame([(c, r, 5, "food", "note", text(d), text(p)) for c, r, d, p in rows], SCHEMA)


@pytest.mark.parametrize(
    "diffs, expected",
    [
        (None, []),
        ({"harvest": {}}, []),
        ({"harvest": {"delete": ["moon", "tide"]}}, [("moon", "delete"), ("tide", "delete")]),
        ({"z": {"delete": ["k"]}, "a": {"delete": ["k"], "add": ["k"]}}, [("k", "delete"), ("k", "add")]),
        ({"harvest": {"rename": ["moon"], "add": []}, "x": {"Change": ["tide"]}}, []),
        ({"harvest": "none", "x": [1], "y": None, "z": {"add": ["tide"]}}, [("tide", "add")]),
        ({"harvest": {"delete": {"moon": 1}, "add": "tide", "change": ["dune.x.y", "dune.x.y", "reef"]}}, [("dune.x.y", "change"), ("reef", "change")]),
        ('{"harvest": {"add": ["moon"', []),
    ],
)
def test_flatten_diffs(spark, diffs, expected):
    df = revisions(spark, ("a", 1, diffs, None))
    assert [tuple(x) for x in df.select(F.expr(history.flatten_diffs("diffs")).alias("x")).head().x] == expected


@pytest.mark.parametrize(
    "doc, path, expected",
    [
        ({"moon": [True]}, "moon", "[true]"), ({"reef": {"x": {"y": {"z": 2.5}}}}, "reef.x.y.z", "2.5"), ({"reef": {"x": 1}}, "reef.y", None),
        ({"reef": {}}, "reef.x.y", None), (None, "moon", None), ({"moon": 3}, "moon.x", None), ({"rows": [{"x": 1}]}, "rows.0.x", None),
        ({"gone": None}, "gone", None), ({"tide-2": {"7th": {}}}, "tide-2.7th", "{}"), ({"ship's": {"x": "y"}}, "ship's.x", '"y"'),
        ({"moon": {"": 9}}, "moon.", "9"), ({"": 8}, "", "8"), ({"two words": 0}, "two words", "0"), ({'in"ch': 6}, 'in"ch', "6"),
    ],
)
def test_resolve_path(spark, doc, path, expected):
    df = spark.createDataFrame([(None if doc is None else json.dumps(doc), path)], "d string, p string").withColumn("v", F.expr("try_parse_json(d)"))
    assert df.select(F.to_json(F.expr(history.resolve_path("v", "p"))).alias("x")).head().x == expected


def test_events(spark):
    df = revisions(
        spark,
        ("p", 10, None, {"moon": [1], "tide": {"low": 2}, "reef": False}),
        ("p", 11, {"a": {"delete": ["reef"]}, "b": {"change": ["tide.low"], "add": ["dune"]}}, {"moon": [1], "tide": {"low": 3}, "dune": "d"}),
        ("p", 12, {"a": {"change": ["moon", "dune"]}}, {"moon": [], "tide": {"low": 3}}),
        ("p", 20, {"a": {"delete": ["moon"], "change": ["tide"]}}, {"tide": {"low": 9}}),
        ("q", 19, {"a": {"add": ["moon"]}}, {"moon": "other"}),
    )
    rows = history.revision_events(df).withColumn("previous", F.to_json("previous")).withColumn("current", F.to_json("current")).collect()
    got = {(r.id, r.field, r.action, r.previous, r.current) for r in rows}
    assert got == {
        ("p_11", "reef", "delete", "false", None), ("p_11", "tide.low", "change", "2", "3"), ("p_11", "dune", "add", None, '"d"'),
        ("p_12", "moon", "change", "[1]", "[]"), ("p_12", "dune", "change", '"d"', None),
        ("p_20", "moon", "delete", None, None), ("p_20", "tide", "change", None, '{"low":9}'),
        ("q_19", "moon", "add", None, '"other"'),
    }
    assert {(r.code, r.timestamp, r.product_type, r.comment) for r in rows} == {(c, 5, "food", "note") for c in "pq"}


def test_repeated_revision_last_written_wins(spark):
    """By time, not by text."""
    rows = [("p", 1, 30, "zz"), ("p", 1, 40, "aa"), ("p", 1, 20, "mm"), ("p", 2, 50, "next")]
    df = spark.createDataFrame([(c, r, t, "food", "note", None, json.dumps({"v": v})) for c, r, t, v in rows], SCHEMA)
    pairs = history.revision_pairs(df).collect()
    assert [(r.rev_id, r.previous_product) for r in sorted(pairs)] == [(1, None), (2, '{"v": "aa"}')]


@pytest.mark.parametrize("block", [1, 2, 3, 1024])
def test_pairs_across_blocks(spark, block):
    kept = [i for i in range(40) if i % 7 != 3]
    df = revisions(spark, *[(c, i, None, {"v": f"{c}{i}"}) for c in "ab" for i in kept])
    rows = history.revision_pairs(df, block=block).collect()
    assert len(rows) == 2 * len(kept)
    for r in rows:
        expected = json.dumps({"v": f"{r.code}{r.rev_id - 1}"}) if r.rev_id - 1 in kept else None
        assert r.previous_product == expected


def test_hot_product_is_spread(spark):
    """Revisions of one product go to many window partitions, in one shuffle."""
    df = revisions(spark, ("a", 1, None, {}))
    plan = history.revision_pairs(df)._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"hashpartitioning\((.*), 4\)", plan)[0].count("#") == 2
    assert plan.count("Exchange") == 1


def test_export_round_trip(spark, tmp_path):
    df = revisions(spark, ("7", 1, None, {"a": 1}), ("7", 2, {"f": {"add": ["a"]}}, {"a": {"b": [1, None]}}))
    export_events(df, str(tmp_path / "out"))
    found = []
    for path in (tmp_path / "out").glob("*.gz"):
        with gzip.open(path, "rt") as fp:
            found += [json.loads(line) for line in fp]
    assert found == [
        {"id": "7_2", "code": "7", "rev_id": 2, "timestamp": 5, "product_type": "food", "comment": "note", "field": "a",
         "previous": None, "current": {"b": [1, None]}, "action": "add"}
    ]
