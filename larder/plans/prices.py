"""Price export: prices joined with their proofs and locations into one flat table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.variants import (
    JSON_OPTIONS,
    misfit,
    nothing,
    pinned,
    to_bigint,
    to_bool,
    to_date,
    to_decimal,
    to_double,
    to_float,
    to_int,
    to_str,
    to_strings,
    to_timestamp,
)
from larder.operators.joins import last_wins_rows, lookup_join, owner_hash
from larder.schemas import (
    LOCATION_COLUMNS,
    LOCATION_INPUT_ONLY,
    PRICE_COLUMNS,
    PROOF_COLUMNS,
    PROOF_INPUT_ONLY,
    ddl,
    price_schema,
)
from larder.sources.clustered import row_groups
from larder.sources.files import delete_path, read_lines, staging_path, write_parquet
from larder.sources.outcomes import GOOD, ExportReport, Outcomes, counted

# Lines that are no JSON object end up in the member _bad.
_OPTIONS = JSON_OPTIONS[:-1] + ", 'columnNameOfCorruptRecord', '_bad')"

_CONVERT = {
    "int": to_int,
    "bigint": to_bigint,
    "float": to_float,
    "double": to_double,
    "string": to_str,
    "boolean": to_bool,
    "array<string>": to_strings,
    "decimal(10,3)": to_decimal,
    "date": to_date,
    "timestamp": to_timestamp,
}


def parse_records(lines: DataFrame, schema: T.StructType, required: tuple[str, ...]) -> DataFrame:
    """Typed columns plus ``_errors``; other columns of ``lines`` are carried along."""
    carried = [c for c in lines.columns if c != "line"]
    shape = ", ".join(f"`{f.name}` variant" for f in schema)
    parsed = lines.select(
        *carried,
        "line",
        F.expr(f"from_json(line, '{shape}, _bad string', {_OPTIONS})").alias("doc"),
    )
    valued = parsed.select(
        *carried,
        "line",
        "doc",
        *[F.expr(_CONVERT[f.dataType.simpleString()](f"doc.`{f.name}`")).alias(f.name) for f in schema],
    )
    errors = ["CASE WHEN doc._bad IS NOT NULL THEN 'json' END"]
    errors += [f"CASE WHEN {misfit(f'doc.`{f.name}`', f.name)} THEN '{f.name}' END" for f in schema]
    errors += [
        f"CASE WHEN doc._bad IS NULL AND {nothing(f'doc.{n}')} THEN '{n}' END" for n in required
    ]
    return valued.select(
        *carried,
        "line",
        *[f.name for f in schema],
        pinned(f"array_compact(array({', '.join(errors)}))").alias("_errors"),
    )


def strict(rows: DataFrame, what: str) -> DataFrame:
    """Fail the job at the first row with errors.

    The check is a filter in the same pass, so it holds whichever columns are
    read afterwards.
    """
    message = F.concat(F.lit(f"bad {what}: "), F.array_join("_errors", ", "), F.lit(" in "), F.col("line"))
    fine = F.when(F.size("_errors") > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return rows.filter(fine).drop("_errors", "line")


def _input(columns: str, extra: str = "") -> T.StructType:
    return T.StructType(ddl("id BIGINT").fields + ddl(columns).fields + (ddl(extra).fields if extra else []))


def parse_prices(lines: DataFrame) -> DataFrame:
    return _hashed(parse_records(lines, ddl(PRICE_COLUMNS), ("type",)))


def parse_proofs(lines: DataFrame) -> DataFrame:
    return _hashed(parse_records(lines, _input(PROOF_COLUMNS, PROOF_INPUT_ONLY), ("id", "type")))


def parse_locations(lines: DataFrame) -> DataFrame:
    return parse_records(lines, _input(LOCATION_COLUMNS, LOCATION_INPUT_ONLY), ("id", "type"))


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("owner", F.expr(owner_hash("owner")))


def join_prices(
    prices: DataFrame, proofs: DataFrame, locations: DataFrame, must_exist: bool = True
) -> DataFrame:
    """Flat price table in output column order.

    ``proofs`` and ``locations`` carry ``pos`` (input order): of several records
    with one id the last wins.
    """
    return _flat(_with_lookups(prices, proofs, locations, must_exist))


def _with_lookups(prices: DataFrame, proofs: DataFrame, locations: DataFrame, must_exist: bool) -> DataFrame:
    """Prices with the columns of both lookups; ``_no_proof`` and ``_no_location`` flag unknown keys."""
    proof_names = [f.name for f in ddl(PROOF_COLUMNS)]
    location_names = [f.name for f in ddl(LOCATION_COLUMNS)]
    proofs = last_wins_rows(proofs.select("id", "pos", *proof_names), "id", "pos")
    locations = last_wins_rows(locations.select("id", "pos", *location_names), "id", "pos")
    spread = F.xxhash64("id", "product_code")
    wide = lookup_join(prices, proofs, "proof_id", "id", proof_names, "proof_", spread, must_exist, "_no_proof", hashed=True)
    return lookup_join(wide, locations, "location_id", "id", location_names, "location_", spread, must_exist, "_no_location")


def _flat(wide: DataFrame) -> DataFrame:
    return wide.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in price_schema()])


def export_prices(
    spark: SparkSession,
    sources: dict[str, str],
    target: str,
    on_error: str = "fail",
    quarantine_target: str | None = None,
) -> ExportReport:
    """Prices, proofs and locations (JSON lines) to one Parquet dataset.

    By default one bad record, or a key without a record, stops the export.
    With ``on_error="quarantine"`` such rows are left out and stored, with the
    reasons (one row each, however many there are), at ``quarantine_target``.
    Prices are counted in the pass that writes them.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"unknown on_error: {on_error}")
    prices = parse_prices(read_lines(spark, sources["price"]))
    proofs = parse_proofs(read_lines(spark, sources["proof"], position=True))
    locations = parse_locations(read_lines(spark, sources["location"], position=True))
    schema = price_schema()
    if on_error == "fail":
        flat = join_prices(
            strict(prices, "price"), strict(proofs, "proof"), strict(locations, "location")
        )
        rows, seen = counted(flat.withColumn("_errors", F.expr("CAST(array() AS ARRAY<STRING>)")), [])
        write_parquet(rows.drop("_errors"), target, schema, **row_groups())
        return ExportReport.of(seen.get)
    fine = F.size("_errors") == 0
    keys = {"_no_proof": "unknown proof_id", "_no_location": "unknown location_id"}
    wide = _with_lookups(prices, proofs.filter(fine), locations.filter(fine), must_exist=False)
    unknown = F.array(*[F.when(F.col(flag), F.lit(reason)) for flag, reason in keys.items()])
    wide = wide.withColumn("_errors", F.array_compact(F.concat("_errors", unknown)))
    wide, seen = counted(wide, ["json", *[f.name for f in ddl(PRICE_COLUMNS)], *keys.values()])
    note = F.when(~fine, F.struct(F.col("_errors").alias("errors"), "line"))
    staged = staging_path(target)
    try:
        # One write of all prices; the good ones are not touched again.
        out = Outcomes(spark, staged, schema, "product_code")
        out.write(wide.withColumns({"outcome": F.when(fine, GOOD).otherwise("refused"), "note": note}), **row_groups())
        counts = seen.get
        refused = out.read("refused", "errors ARRAY<STRING>, line STRING").select(
            F.lit("price").alias("record"), F.col("note.errors").alias("errors"), F.col("note.line").alias("line")
        )
        out.commit(target)
        if quarantine_target:
            for what, records in (("proof", proofs), ("location", locations)):
                refused = refused.unionByName(records.filter(~fine).select(F.lit(what).alias("record"), F.col("_errors").alias("errors"), "line"))
            write_parquet(refused, quarantine_target)
    finally:
        delete_path(spark, staged)
    return ExportReport.of(counts)
