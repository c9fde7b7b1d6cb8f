"""Storage under the change feed: a log of what each batch brought, and a merged view of the newest row per key.

    batches/batch=N/kind=K      what micro-batch N brought
    spans/span=ID/kind=K        batches folded together, so that folders stay few
    runs/run=ID/bucket=B        newest rows by key, in fixed buckets by hash of the key
    versions/N.json             the live spans, runs and buckets after batch N

A version is one small file, written last; it is what makes new files count.  A
reader holds the files its version names, and the files of the last ``keep``
versions stay.

A snapshot writes the newest rows of the batches since the last one as a new run.
A bucket's earlier runs are merged into it while they are at most twice as large
(or small anyway), so runs grow geometrically: every row is rewritten a logarithmic
number of times, and a snapshot of few changes leaves large runs alone.  Spans
follow the same rule.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources.files import bytes_by_folder, child_names, delete_path, read_text, write_text

GROWTH = 2  # a run up to so many times as large as what comes is merged with it
SMALL_BYTES = 1 << 20  # what comes counts as so many bytes at least: smaller files are not worth keeping apart


@dataclass
class Version:
    """What is live after batch ``upto``: bytes of every span, and of every run by bucket, oldest first."""

    upto: int = -1
    buckets: int = 0
    spans: dict[str, int] = field(default_factory=dict)
    runs: dict[str, dict[str, int]] = field(default_factory=dict)


def to_merge(sizes: list[tuple[str, int]], added: int) -> list[str]:
    """The names at the end of ``sizes`` (oldest first) that ``added`` bytes are merged with."""
    names = []
    for name, size in reversed(sizes):
        if size > GROWTH * added:
            break
        names.append(name)
        added += size
    return names


class MergedStore:
    """``newest(rows)`` keeps the newest row per ``key`` of rows of kind ``merged`` and schema ``view_schema``."""

    def __init__(
        self, root: str, log_schema: str, view_schema: str, key: str, merged: str,
        newest: Callable[[DataFrame], DataFrame], buckets: int = 64, keep: int = 2, small_bytes: int = SMALL_BYTES,
    ):
        self.root, self.log_schema, self.view_schema = root.rstrip("/"), log_schema, view_schema
        self.key, self.merged, self.newest, self.buckets = key, merged, newest, buckets
        self.keep, self.small_bytes = keep, small_bytes
        self.columns = [part.split()[0] for part in view_schema.split(", ")]

    # --- versions -------------------------------------------------------------

    def _numbers(self, spark: SparkSession) -> list[int]:
        names = child_names(spark, f"{self.root}/versions")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _load(self, spark: SparkSession, number: int) -> Version:
        return Version(**json.loads(read_text(spark, f"{self.root}/versions/{number}.json")))

    def version(self, spark: SparkSession) -> Version:
        numbers = self._numbers(spark)
        return self._load(spark, numbers[-1]) if numbers else Version(buckets=self.buckets)

    # --- writing --------------------------------------------------------------

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """What a batch brought (a column ``kind`` says what); a batch that is repeated replaces itself."""
        rows.write.mode("overwrite").partitionBy("kind").parquet(f"{self.root}/batches/batch={batch_id}")

    def snapshot(self, spark: SparkSession, upto: int) -> None:
        """Fold the batches up to ``upto`` into a new version."""
        old = self.version(spark)
        if upto <= old.upto:
            return
        batches = [b for b in self._batches(spark, old.upto) if b <= upto]
        sizes = [bytes_by_folder(spark, f"{self.root}/batches/batch={b}") for b in batches]
        spans = self._fold_log(spark, old, batches, sum(sum(s.values()) for s in sizes))
        runs = self._fold_view(spark, old, batches, sum(s.get(f"kind={self.merged}", 0) for s in sizes))
        new = Version(upto, old.buckets, spans, runs)
        write_text(spark, f"{self.root}/versions/{upto}.json", json.dumps(new.__dict__))
        self._clean(spark)

    def _fold_log(self, spark: SparkSession, old: Version, batches: list[int], added: int) -> dict[str, int]:
        merged = to_merge(list(old.spans.items()), max(added, self.small_bytes))
        name = uuid.uuid4().hex
        rows = self._log_rows(spark, merged, batches)
        rows.hint("rebalance", "kind").write.partitionBy("kind").parquet(f"{self.root}/spans/span={name}")
        size = sum(bytes_by_folder(spark, f"{self.root}/spans/span={name}").values())
        return {k: v for k, v in old.spans.items() if k not in merged} | {name: size}

    def _fold_view(self, spark: SparkSession, old: Version, batches: list[int], added: int) -> dict[str, dict[str, int]]:
        merged: dict[str, list[str]] = {}
        added = max(added // old.buckets, self.small_bytes)
        for bucket in {b for run in old.runs.values() for b in run}:
            for run in to_merge([(n, r[bucket]) for n, r in old.runs.items() if bucket in r], added):
                merged.setdefault(run, []).append(bucket)
        changes = self._in_buckets(self._log_rows(spark, [], batches).filter(F.col("kind") == self.merged), old.buckets)
        rows = reduce(DataFrame.unionByName, [changes, *([self._run_rows(spark, merged)] if merged else [])])
        name = uuid.uuid4().hex
        folder = f"{self.root}/runs/run={name}"
        view = self.newest(rows.drop("bucket")).transform(self._in_buckets, old.buckets)
        view.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(folder)
        live = {n: {b: s for b, s in r.items() if b not in merged.get(n, ())} for n, r in old.runs.items()}
        written = {k.removeprefix("bucket="): v for k, v in bytes_by_folder(spark, folder).items() if k.startswith("bucket=")}
        return {n: r for n, r in (live | {name: written}).items() if r}

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int").alias("bucket")

    def _in_buckets(self, rows: DataFrame, buckets: int) -> DataFrame:
        return rows.select(*self.columns, self._bucket(buckets))

    def _clean(self, spark: SparkSession) -> None:
        """Drop what none of the last ``keep`` versions names."""
        numbers = self._numbers(spark)
        kept = [self._load(spark, n) for n in numbers[-self.keep :]]
        gone = [f"versions/{n}.json" for n in numbers[: -self.keep]]
        gone += [f"batches/batch={b}" for b in self._batches(spark, -1) if b <= kept[0].upto]
        for folder, live in (("spans/span", [v.spans for v in kept]), ("runs/run", [v.runs for v in kept])):
            parent, prefix = folder.split("/")
            names = [n.removeprefix(f"{prefix}=") for n in child_names(spark, f"{self.root}/{parent}")]
            gone += [f"{folder}={n}" for n in names if not any(n in v for v in live)]
        for path in gone:
            delete_path(spark, f"{self.root}/{path}")

    # --- reading --------------------------------------------------------------

    def _batches(self, spark: SparkSession, after: int) -> list[int]:
        """Finished batches after one."""
        folder = f"{self.root}/batches"
        numbers = [int(n.split("=")[1]) for n in child_names(spark, folder) if n.startswith("batch=")]
        return sorted(n for n in numbers if n > after and "_SUCCESS" in child_names(spark, f"{folder}/batch={n}"))

    def _log_rows(self, spark: SparkSession, spans, batches) -> DataFrame:
        """Rows of the log from spans and batches, with their kind."""
        schema = f"{self.log_schema}, kind STRING"
        columns = [part.split()[0] for part in schema.split(", ")]
        parts = []
        for folder, name, values in (("spans", "span", spans), ("batches", "batch", batches)):
            if values:
                reader = spark.read.schema(schema).option("basePath", f"{self.root}/{folder}")
                parts.append(reader.parquet(*[f"{self.root}/{folder}/{name}={v}" for v in values]).select(*columns))
        return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)

    def _run_rows(self, spark: SparkSession, runs: dict) -> DataFrame:
        """Rows of the named buckets of runs."""
        paths = [f"{self.root}/runs/run={run}/bucket={b}" for run, buckets in runs.items() for b in buckets]
        reader = spark.read.schema(f"{self.view_schema}, run STRING, bucket INT").option("basePath", f"{self.root}/runs")
        return reader.parquet(*paths).select(*self.columns, "bucket")

    def log(self, spark: SparkSession, kind: str) -> DataFrame:
        """All rows of a kind ever appended."""
        now = self.version(spark)
        return self._log_rows(spark, now.spans, self._batches(spark, now.upto)).filter(F.col("kind") == kind).drop("kind")

    def view(self, spark: SparkSession, keys: list | None = None) -> DataFrame:
        """Newest row per key: the live runs and the batches after them.

        With ``keys``, only those; of the runs only their buckets are opened.
        """
        now = self.version(spark)
        recent = self._log_rows(spark, [], self._batches(spark, now.upto)).filter(F.col("kind") == self.merged).select(*self.columns)
        runs = now.runs
        if keys is not None:
            asked = spark.createDataFrame([(k,) for k in keys], f"{self.key} STRING").select(self._bucket(now.buckets))
            wanted = {str(r.bucket) for r in asked.collect()}
            runs = {n: [b for b in r if b in wanted] for n, r in runs.items()}
        if any(runs.values()):
            recent = recent.unionByName(self._run_rows(spark, runs).drop("bucket"))
        return self.newest(recent if keys is None else recent.filter(F.col(self.key).isin(*keys)))
