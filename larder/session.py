"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Run-time settings every job here relies on.  They can be changed on a live
# session, so a session made elsewhere only needs ``configure``.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # JSON objects with a repeated key keep the last value, as JSON readers do.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    # Splits the partitions of hot join keys at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows of a few outcomes go straight to their files instead of being sorted by outcome.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


_SHIPPED: set[str] = set()  # applications that already have the package


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, which need no copy of their own."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="larder-"), "larder.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    ship(spark)
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Create (or get) a configured session."""
    builder = SparkSession.builder.appName("larder").config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return configure(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors can see, taken from ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own; on a cluster
    every executor would write to its own disk, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="larder-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder; nothing is created."""
    return f"{scratch_root(spark)}/larder-{name}-{uuid.uuid4().hex}"
