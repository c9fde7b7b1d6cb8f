"""Scans, sinks, the mobile dump, analysis steps and taxonomy."""

import gzip

import pytest
from pyspark.sql import functions as F

from larder.operators import analysis
from larder.operators.taxonomy import ancestors, deepest_tags, lookup_tags
from larder.plans.mobile import export_mobile
from larder.session import scratch_path
from larder.sources import files


def test_missing_input(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_lines(spark, str(tmp_path / "none.jsonl"))
    with pytest.raises(FileNotFoundError):
        export_mobile(spark, str(tmp_path / "none.parquet"), str(tmp_path / "out"))


def test_line_positions(spark, tmp_path):
    for name, start in (("a", 0), ("b", 500)):
        (tmp_path / f"{name}.jsonl").write_text("".join(f"{i}\n" for i in range(start, start + 500)))
    rows = files.read_lines(spark, str(tmp_path), position=True).orderBy("pos").collect()
    assert [int(r.line) for r in rows] == list(range(1000))


def test_gzip_input_is_spread(spark, tmp_path):
    with gzip.open(tmp_path / "a.jsonl.gz", "wt") as fp:
        fp.write("{}\n" * 50)
    lines = files.read_lines(spark, str(tmp_path / "a.jsonl.gz"))
    assert lines.count() == 50 and lines.rdd.getNumPartitions() > 1


def test_scratch_is_shared(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_mobile_dump(spark, tmp_path):
    rows = [("1", "Oats", "750 g", "A,B", "a", 4, "a"), ("2", 'Rice "x"', None, "C\tD", "b", None, "c")]
    names = "code string, product_name string, quantity string, brands string, nutriscore_grade string, nova_group int, environmental_score_grade string"
    spark.createDataFrame(rows, names).coalesce(1).write.parquet(str(tmp_path / "in.parquet"))
    export_mobile(spark, str(tmp_path / "in.parquet"), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("*.gz")
    with gzip.open(part, "rt") as fp:
        text = fp.read().split("\n")
    assert text[0] == "code\tproduct_name\tquantity\tbrands\tnutrition_grade_fr\tnova_group\tenvironmental_score_grade"
    assert sorted(text[1:3]) == ["1\tOats\t750 g\tA,B\ta\t4\ta", '2\t"Rice ""x"""\t\t"C\tD"\tb\t\tc']
    back = files.read_tsv(spark, str(tmp_path / "out"), names)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == rows


def test_language_list_names(spark, tmp_path):
    df = spark.sql("SELECT array(named_struct('lang','fr','text','b'), named_struct('lang','main','text','a')) AS product_name")
    from larder.plans.mobile import mobile_columns

    for name in ("code", "quantity", "brands", "nutriscore_grade", "nova_group", "environmental_score_grade"):
        df = df.withColumn(name, F.lit("x"))
    assert mobile_columns(df).head().product_name == "a"
    assert mobile_columns(df, names_as_json=True).head().product_name == '[{"lang":"fr","text":"b"},{"lang":"main","text":"a"}]'


def test_json_lines_keep_nulls(spark):
    assert files.json_lines(spark.sql("SELECT 1 AS a, NULL AS b")).head().value == '{"a":1,"b":null}'


def test_facet_ties(spark):
    df = spark.createDataFrame([(["b", "a"],), (["b"],), ([],), (None,), (["c"],)], "t array<string>")
    assert [tuple(r) for r in analysis.tag_facet(df, "t", 2).collect()] == [("b", 2), ("a", 1)]


def test_mostly_known(spark):
    df = spark.createDataFrame([(0, 0), (3, 1), (4, 1), (2, 0), (None, 1), (5, None)], "k int, u int")
    assert [tuple(r) for r in df.filter(analysis.mostly_known("k", "u")).collect()] == [(4, 1), (2, 0)]


def test_taxonomy(spark):
    """A diamond, a chain, two roots, a cycle and an unknown tag."""
    edges = spark.createDataFrame(
        [("d", "b"), ("d", "c"), ("b", "a"), ("c", "a"), ("e", "d"), ("y", "x"), ("p", "q"), ("q", "p")], "child string, parent string"
    )
    pairs = ancestors(edges)
    got = {(r.node, r.ancestor) for r in pairs.collect()}
    assert {a for n, a in got if n == "e"} == {"a", "b", "c", "d"} and pairs.count() == len(got)
    nodes = spark.createDataFrame([(i, "en", i.upper(), [i], {"k": i}) for i in "abcdexypq"], "id string, lang string, name string, synonyms array<string>, properties map<string,string>")
    tagged = spark.createDataFrame([(1, "a"), (1, "e"), (1, "x"), (1, "zz"), (2, "b"), (2, "c"), (3, "a"), (3, "a"), (4, "zz")], "k int, tag string")
    leaves = {(r.k, r.tag) for r in deepest_tags(tagged, nodes, pairs, "k").collect()}
    assert leaves == {(1, "e"), (1, "x"), (2, "b"), (2, "c"), (3, "a")}
    found = {(r.k, r.tag): (r.name, r.in_taxonomy) for r in lookup_tags(tagged, nodes, "en").collect()}
    assert found[(1, "zz")] == (None, False) and found[(2, "b")] == ("B", True)


def test_folders_and_globs_of_compressed_files(spark, tmp_path):
    import gzip

    for n in range(2):
        with gzip.open(tmp_path / f"part-{n}.jsonl.gz", "wt") as out:
            out.write("".join(f'{{"n": {n}, "k": {k}}}\n' for k in range(50)))
    for path in (str(tmp_path), f"{tmp_path}/part-*.jsonl.gz"):
        lines = files.read_lines(spark, path)
        assert lines.count() == 100 and lines.rdd.getNumPartitions() > 2
    with pytest.raises(FileNotFoundError):
        files.read_lines(spark, f"{tmp_path}/none-*.gz")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tags_are_looked_up_in_hash_tables_by_partition(spark):
    nodes = spark.createDataFrame([("a", "en", "A", ["A"], {"k": "v"}), ("a", "fr", "B", ["B"], {})], "id STRING, lang STRING, name STRING, synonyms ARRAY<STRING>, properties MAP<STRING,STRING>")
    found = lookup_tags(spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "k INT, tag STRING"), nodes, "en")
    assert {(r.k, r.name, r.in_taxonomy) for r in found.collect()} == {(1, "A", True), (2, None, False), (3, None, False)}
    assert "ShuffledHashJoin" in _plan(found) and "SortMergeJoin" not in _plan(found) and "BroadcastHashJoin" not in _plan(found)


def test_deepest_tags_of_odd_rows(spark):
    """Rows repeat, keys are null, a cycle and a node outside the taxonomy cover nothing; no join sorts or broadcasts."""
    nodes = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "id STRING")
    pairs = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "b"), ("out", "c"), ("a", None)], "node STRING, ancestor STRING")
    rows = [(1, "a"), (1, "a"), (1, "b"), (1, "out"), (1, "c"), (None, "a"), (None, "b"), (None, "b"), (2, "b"), (2, None), (3, "out")]
    leaves = deepest_tags(spark.createDataFrame(rows, "k INT, tag STRING"), nodes, pairs, "k")
    assert sorted(map(tuple, leaves.collect()), key=str) == sorted([(1, "a"), (1, "c"), (None, "a"), (None, "b"), (2, "b")], key=str)
    assert "SortMergeJoin" not in _plan(leaves) and "BroadcastHashJoin" not in _plan(leaves)
