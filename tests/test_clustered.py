"""The clustered layout: what it holds, and how little a look-up opens."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from larder.sources.clustered import files_with, look_up, write_clustered


@pytest.fixture(scope="module")
def dataset(spark, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("clustered") / "products")
    rows = spark.range(20_000).selectExpr("lpad(CAST(id * 7919 % 20000 AS STRING), 13, '0') AS code", "id", "sha2(CAST(id AS STRING), 256) AS name")
    rows = rows.unionByName(rows.filter("id < 10").withColumn("code", F.lit(None).cast("string")))
    write_clustered(rows, target, "code", files=16, rows_per_group=500)
    return target


def test_all_rows_are_there(spark, dataset):
    rows = spark.read.parquet(dataset)
    assert rows.columns == ["code", "id", "name"] and rows.count() == 20_010
    assert rows.agg(F.count_distinct("code")).head()[0] == 20_000


def test_row_groups(spark, dataset):
    for name in spark.read.parquet(dataset).inputFiles():
        meta = pq.ParquetFile(name.removeprefix("file://")).metadata
        assert meta.num_row_groups > 1
        assert all(meta.row_group(k).num_rows <= 500 for k in range(meta.num_row_groups))


def metric(frame, name):
    """A metric of the scan, after the query has run."""
    plan = frame._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply(name).value()


def test_look_up_opens_one_file(spark, dataset):
    code = "0000000004711"
    assert len(files_with(spark, dataset, [code])) == 1 and len(spark.read.parquet(dataset).inputFiles()) == 16
    found = look_up(spark, dataset, "code", [code])
    row = found.collect()
    assert [r.code for r in row] == [code] and row[0].id * 7919 % 20000 == 4711
    assert metric(found, "numFiles") == 1 and metric(found, "numOutputRows") <= 500


def test_look_up_of_several_and_none(spark, dataset):
    codes = ["0000000000001", "0000000019999", "no such code", "0000000010000"]
    assert sorted(r.code for r in look_up(spark, dataset, "code", codes).collect()) == sorted(c for c in codes if c.startswith("0"))
    assert len(files_with(spark, dataset, codes)) <= 3
    assert look_up(spark, dataset, "code", ["zzz"]).collect() == []


def test_replaced_as_a_whole(spark, tmp_path):
    target = str(tmp_path / "t")
    for n in (100, 7):
        write_clustered(spark.range(n), target, "id", files=3)
    assert spark.read.parquet(target).count() == 7
    assert [r.id for r in look_up(spark, target, "id", [3, 50]).collect()] == [3]
    write_clustered(spark.range(0), target, "id")
    assert look_up(spark, target, "id", [3]).collect() == []
