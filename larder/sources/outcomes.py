"""One write, several outputs: rows go to a folder per outcome, and good ones are never written again.

A Parquet write has one schema, and the files of good rows must have just the
columns their readers expect.  So what the other rows need besides (why they were
refused, the line they came from) travels inside one text column of theirs, the
carrier, as JSON, and is taken out again when their part is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.sources.files import child_names, in_schema, move_files, move_into_place

GOOD = "good"


@dataclass
class ExportReport:
    """Rows read, kept and refused, and how many were refused for each reason (a row may have several)."""

    read: int
    kept: int
    refused: int
    reasons: dict[str, int]

    @classmethod
    def of(cls, counts: dict[str, int]) -> ExportReport:
        reasons = {name: n for name, n in counts.items() if n and name not in ("read", "refused")}
        return cls(counts["read"], counts["read"] - counts["refused"], counts["refused"], reasons)


def counted(rows: DataFrame, names: list[str], refused: Column | None = None) -> tuple[DataFrame, Observation]:
    """``rows`` that count themselves while they are written: all, refused ones, and each of ``names`` in ``_errors``."""
    seen = Observation()
    refused = F.size("_errors") > 0 if refused is None else refused
    bad = F.col("_bad")  # most rows have no errors; they are not searched for each name
    counts = [F.count(F.lit(1)).alias("read"), F.count_if(refused).alias("refused")]
    counts += [F.count_if(bad & F.array_contains("_errors", name)).alias(name) for name in names]
    return rows.withColumn("_bad", F.size("_errors") > 0).observe(seen, *counts).drop("_bad"), seen


class Outcomes:
    """A folder of rows by outcome; ``schema`` is that of the good ones, ``carrier`` a text column in it."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, carrier: str):
        self.spark, self.path, self.schema, self.carrier = spark, path, schema, carrier

    def write(self, rows: DataFrame, **options: str) -> None:
        """``rows`` hold the schema's columns, ``outcome`` and ``note`` (a struct, of rows that are not good)."""
        note = F.to_json(F.struct(F.col(self.carrier).alias("value"), F.col("note")), {"ignoreNullFields": "true"})
        carried = F.when(F.col("outcome") == GOOD, F.col(self.carrier)).otherwise(note)
        columns = [(carried if f.name == self.carrier else F.col(f.name)).cast(f.dataType).alias(f.name) for f in self.schema]
        rows.select(*columns, "outcome").write.options(**options).partitionBy("outcome").parquet(self.path)

    def has(self, outcome: str) -> bool:
        return f"outcome={outcome}" in child_names(self.spark, self.path)

    def read(self, outcome: str, note: str) -> DataFrame:
        """Rows of an outcome other than good, with ``note`` (a struct of the given fields) and the carrier as it was."""
        if not self.has(outcome):
            rows = self.spark.createDataFrame([], self.schema)
        else:
            rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/outcome={outcome}")
        held = rows.withColumn("_held", F.from_json(self.carrier, f"value STRING, note STRUCT<{note}>"))
        return held.withColumn(self.carrier, F.col("_held.value")).withColumn("note", F.col("_held.note")).drop("_held")

    def commit(self, target: str, *more: Outcomes) -> None:
        """Move the good rows, and those of ``more``, to ``target``; no file is written again."""
        good = f"{self.path}/outcome={GOOD}"
        if not self.has(GOOD):  # readers need a schema
            in_schema(self.spark.createDataFrame([], self.schema), self.schema).write.parquet(good)
        for other in more:
            if other.has(GOOD):
                move_files(self.spark, f"{other.path}/outcome={GOOD}", good)
        move_into_place(self.spark, good, target)
