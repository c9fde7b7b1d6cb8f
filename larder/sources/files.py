"""JSON-lines, Parquet and TSV in and out, and moving finished output into place."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _hadoop_path(spark, path)
    return bool(fs.exists(jvm_path))


def require_path(spark: SparkSession, path: str) -> None:
    """``path`` names a file or folder, or is a glob that matches something."""
    jvm_path, fs = _hadoop_path(spark, path)
    if not fs.globStatus(jvm_path):
        raise FileNotFoundError(path)


def _all_compressed(lines: DataFrame) -> bool:
    """Whether every input file is one that cannot be split."""
    files = lines.inputFiles()
    return bool(files) and all(f.endswith((".gz", ".gzip")) for f in files)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm_path, fs = _hadoop_path(spark, path)
    fs.delete(jvm_path, True)


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move the data files of one folder into another that exists; their names differ."""
    folder, fs = _hadoop_path(spark, source)
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")) and not fs.rename(status.getPath(), _hadoop_path(spark, f"{target}/{name}")[0]):
            raise OSError(f"could not move {status.getPath()} to {target}")


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    jvm_path, fs = _hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(jvm_path)] if fs.exists(jvm_path) else []


def bytes_by_folder(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of the files below ``path``, by the name of the folder each lies in."""
    jvm_path, fs = _hadoop_path(spark, path)
    sizes: dict[str, int] = {}
    if fs.exists(jvm_path):
        files = fs.listFiles(jvm_path, True)
        while files.hasNext():
            status = files.next()
            name = status.getPath().getParent().getName()
            sizes[name] = sizes.get(name, 0) + status.getLen()
    return sizes


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that readers see whole or not at all; one that is there is replaced."""
    staged, fs = _hadoop_path(spark, staging_path(path))
    out = fs.create(staged, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    move_into_place(spark, staged.toString(), path)


def read_text(spark: SparkSession, path: str) -> str:
    jvm_path, fs = _hadoop_path(spark, path)
    stream = fs.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def staging_path(target: str) -> str:
    """A fresh sibling of ``target``, so that the final move stays on one file system."""
    return f"{target.rstrip('/')}.staging-{uuid.uuid4().hex}"


def move_into_place(spark: SparkSession, staged: str, target: str) -> None:
    """Replace ``target`` by finished output.

    Readers of ``target`` never see a half-written dataset: the old one is moved
    aside, deleted once the new one is in place, and put back if that fails.  On
    object stores the move is a copy.
    """
    staged_path, fs = _hadoop_path(spark, staged)
    target_path, _ = _hadoop_path(spark, target)
    aside_path, _ = _hadoop_path(spark, f"{target.rstrip('/')}.replaced-{uuid.uuid4().hex}")
    replaced = fs.exists(target_path)
    if replaced and not fs.rename(target_path, aside_path):
        raise OSError(f"could not move {target} aside")
    if not fs.rename(staged_path, target_path):
        if replaced:
            fs.rename(aside_path, target_path)
        raise OSError(f"could not move {staged} to {target}")
    if replaced:
        fs.delete(aside_path, True)


def read_lines(spark: SparkSession, path: str, position: bool = False) -> DataFrame:
    """One row per input line, column ``line``.

    ``position`` adds ``pos``, which orders the lines of a file as written, and
    files by name.  Compressed files cannot be split, so too few of them are
    spread over the cores right after the scan.
    """
    require_path(spark, path)
    lines = spark.read.text(path)
    columns = [F.col("value").alias("line")]
    if position:
        columns.append(
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                # Grows with the line number inside one block of a file.
                F.monotonically_increasing_id().alias("row"),
            ).alias("pos")
        )
    lines = lines.select(*columns)
    return spread(lines) if _all_compressed(lines) else lines


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share when the input has fewer splits than cores.

    Worth its shuffle only before work that is heavy per row; large inputs have
    enough splits and pass through untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def in_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in schema order and of the schema's types."""
    return df.to(schema)


def write_parquet(df: DataFrame, target: str, schema: T.StructType | None = None, **options: str) -> None:
    """Write to a staging folder, then move over the target."""
    spark = df.sparkSession
    staged = staging_path(target)
    (in_schema(df, schema) if schema else df).write.options(**options).parquet(staged)
    move_into_place(spark, staged, target)


def write_tsv(df: DataFrame, target: str) -> None:
    """A folder of gzipped tab-separated files, each with a header line."""
    spark = df.sparkSession
    staged = staging_path(target)
    df.write.csv(
        staged, sep="\t", header=True, compression="gzip", quote='"', escape='"', emptyValue='""'
    )
    move_into_place(spark, staged, target)


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(
        path, sep="\t", header=True, schema=schema, quote='"', escape='"', multiLine=True, emptyValue=""
    )


def json_lines(df: DataFrame) -> DataFrame:
    """One JSON object per row, column ``value``; nulls are kept."""
    return df.select(
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("value")
    )


def write_json_lines(df: DataFrame, target: str) -> None:
    """Gzipped JSON lines."""
    staged = staging_path(target)
    json_lines(df).write.text(staged, compression="gzip")
    move_into_place(df.sparkSession, staged, target)
