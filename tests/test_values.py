"""Scalar coercion, one row per cell of the acceptance matrix."""

import pytest
from pyspark.sql import functions as F

from larder.functions import variants as v
from larder.plans.products import flag, group_text, score_text

CASES = {
    v.to_bigint: {
        "5": 5, '"5"': 5, '" 5 "': 5, '"5.0"': 5, '"5."': 5, '"5.5"': None, '"1_000"': 1000, '"+7"': 7, '"x"': None,
        "5.0": 5, "5.5": None, "1e3": 1000, "true": 1, "false": 0, "[]": None, "{}": None, "null": None, '""': None,
        "9000000000": 9000000000,
    },
    v.to_int: {"2147483647": 2147483647, "2147483648": None},
    v.to_double: {
        "5": 5.0, "5.5": 5.5, '"5.5"': 5.5, '"1e2"': 100.0, '"1.5d"': None, '" .5"': 0.5, "true": 1.0, '"inf"': float("inf"),
        "[1]": None, '{"a":1}': None, "null": None, '"x"': None,
    },
    v.to_str: {'"a"': "a", '""': "", "1": None, "true": None, "[]": None, "null": None, '"1"': "1"},
    v.to_text: {
        '"a"': "a", "500": "500", "500.0": "500.0", "5.10": "5.1", "1e-5": "1e-05", "1e16": "1e+16", "0.0001": "0.0001",
        "12345678.5": "12345678.5", "1.5e20": "1.5e+20", "true": None, "[]": None, "null": None,
        "12345678901234567890": "12345678901234567890",
    },
    v.to_bool: {
        "true": True, "0": False, "1.0": True, "2": None, '"YES"': True, '"off"': False, '"t"': True, '"2"': None,
        "[]": None, "null": None,
    },
    v.to_strings: {
        '["a","b"]': ["a", "b"], "[]": [], '["a",null]': None, "[null]": None, "[1]": None, '"a"': None, "{}": None, '["a",1]': None,
    },
    v.to_date: {'"2024-02-29"': "2024-02-29", '"2023-02-29"': None, '"2024-01-02T00:00:00"': "2024-01-02",
                '"2024-01-02T01:00:00"': None, "86400": "1970-01-02", "86401": None},
    v.to_timestamp: {
        '"2024-01-01T00:00:00Z"': "2024-01-01 00:00:00", '"2024-01-01T02:00:00.5+02:00"': "2024-01-01 00:00:00.5",
        '"2024-01-01T02:00:00+0200"': "2024-01-01 00:00:00", '"2024-01-01 10:30:00"': "2024-01-01 10:30:00",
        '"2024-01-01"': "2024-01-01 00:00:00", '"soon"': None, "60": "1970-01-01 00:01:00",
    },
    v.to_decimal: {'"1.25"': "1.250", "1.234": "1.234", "1.2345": None, "12345678": None, "7": "7.000", '"x"': None, "1e2": "100.000", "true": None},
    score_text: {"5.9": 5, "-5.9": -5, "0.0": 0, "7": 7, '"7"': 7, '"7.5"': None, "null": None},
    group_text: {"4": "4", "0": None, "true": "True", "false": None, '"3"': "3", "4.5": None},
    flag: {'"on"': True, '"true"': True, "1": True, "true": True, "1.0": True, '"1"': False, "null": False, '"off"': False, "[1]": False},
}


@pytest.mark.parametrize("convert", CASES, ids=lambda f: f.__name__)
def test_coercion(spark, convert):
    cases = CASES[convert]
    df = spark.createDataFrame([(text,) for text in cases], "t string").withColumn("v", F.expr("parse_json(t)"))
    sql = convert("v")
    if convert in (v.to_date, v.to_timestamp, v.to_decimal):
        sql = f"CAST({sql} AS STRING)"
    assert {r.t: r.x for r in df.select("t", F.expr(sql).alias("x")).collect()} == cases


def test_misfit_tells_null_from_unreadable(spark):
    df = spark.createDataFrame([("null",), ('"x"',), ("1",)], "t string").withColumn("v", F.expr("parse_json(t)"))
    assert [r.m for r in df.select(F.expr(v.misfit("v", v.to_bigint("v"))).alias("m")).collect()] == [False, True, False]


@pytest.mark.parametrize("json, expected", [(False, ["1e-05", "0.0001", "1e+16", "1e-07"]), (True, ["0.00001", "0.0001", "1e16", "1e-7"])])
def test_float_text(spark, json, expected):
    df = spark.createDataFrame([(1e-5,), (1e-4,), (1e16,), (1e-7,)], "d double")
    assert [r.x for r in df.select(F.expr(v.float_text("d", json)).alias("x")).collect()] == expected


def test_last_wins_keeps_first_position(spark):
    df = spark.sql("SELECT map_entries(from_json('{\"a\":1,\"b\":2,\"a\":3}', 'map<string,string>')) AS e")
    assert [tuple(x) for x in df.select(F.expr(v.last_wins("e")).alias("x")).head().x] == [("a", "3"), ("b", "2")]
