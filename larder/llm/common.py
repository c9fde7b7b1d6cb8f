"""Shared pieces of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from larder.session import configure

# Batches handed to Python stay small however long the texts are.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


class Memo(dict):
    """A dict that fills itself by ``make`` and forgets what was not asked for lately.

    Holds two generations of at most ``half`` entries; the older one goes when
    the younger is full, and an entry asked for again moves to the younger.
    """

    def __init__(self, half: int):
        super().__init__()
        self.half, self.older = half, {}

    def make(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.older.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened where ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def tune(spark: SparkSession) -> SparkSession:
    configure(spark)
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def map_columns(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``fn`` turns every batch into columns of ``schema``, by name; any number of rows."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = fn(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], type=f.type, from_pandas=True) for f in target], schema=target
            )

    return df.mapInArrow(run, schema)
