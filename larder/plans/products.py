"""Product export: JSON lines -> checked, typed rows -> Parquet, plus a quarantine.

The plan is three narrow projections and no shuffle:

1. parse each line once into a struct of the declared members (VARIANT, or raw
   text where member order matters) and once into an open map, for the
   language-suffixed keys nobody can declare;
2. coerce and reshape into the output columns;
3. compare values with the raw members and list the fields that do not fit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.variants import (
    JSON_OPTIONS,
    as_object,
    last_wins,
    let,
    misfit,
    nothing,
    pinned,
    to_bigint,
    to_bool,
    to_double,
    to_float,
    to_str,
    to_strings,
    to_text,
)
from larder.operators.images import array_misfit, images_array
from larder.operators.ingredients import (
    deep_ingredients,
    ingredients_draft,
    ingredients_misfit,
    settle,
    too_deep,
)
from larder.operators.language import language_list, language_members, language_misfit
from larder.operators.members import category_codes, owner_fields, packagings
from larder.operators.nutriments import nutrients, nutrients_misfit
from larder.schemas import LANGUAGE_FIELDS, product_schema
from larder.sources.clustered import row_groups
from larder.sources.files import (
    delete_path,
    in_schema,
    read_lines,
    staging_path,
    write_parquet,
)
from larder.sources.outcomes import GOOD, ExportReport, Outcomes, counted

# Members whose own key order is kept, so they travel as raw text.
RAW_TEXT = (
    "images",
    "nutriments",
    "nutrition",
    "owner_fields",
    "categories_properties",
    "environmental_score_data",
)
# Numbers are accepted as text here.
NUMBER_AS_TEXT = ("product_quantity", "serving_quantity")

DEFAULT_VERSION = 999


def score_text(v: str) -> str:
    """Whole number; a fraction is cut off toward zero, other rules as for ints."""
    number = f"try_variant_get({v}, '$', 'double')"
    return (
        f"CASE WHEN schema_of_variant({v}) = 'DOUBLE' OR schema_of_variant({v}) LIKE 'DECIMAL%' "
        f"THEN try_cast(CASE WHEN {number} < 0 THEN ceil({number}) ELSE floor({number}) END AS BIGINT) "
        f"ELSE {to_bigint(v)} END"
    )


def group_text(v: str) -> str:
    """Text; a non-zero whole number is written out, true becomes 'True'."""
    return (
        f"CASE WHEN schema_of_variant({v}) = 'BIGINT' AND try_variant_get({v}, '$', 'bigint') <> 0 "
        f"THEN try_variant_get({v}, '$', 'string') "
        f"WHEN schema_of_variant({v}) = 'BOOLEAN' AND try_variant_get({v}, '$', 'boolean') THEN 'True' "
        f"ELSE {to_str(v)} END"
    )


def flag(v: str) -> str:
    """NULL when absent, else whether the value is one of on, true, 1."""
    # What counts as set.
    return (
        f"CASE WHEN {v} IS NULL THEN NULL "
        f"ELSE coalesce(to_json({v}) IN ('\"on\"', '\"true\"', '1', '1.0', 'true'), false) END"
    )


def version(v: str) -> str:
    """Document version: 999 when absent, NULL when it is null or does not fit."""
    return f"CASE WHEN {v} IS NULL THEN {DEFAULT_VERSION} ELSE {to_bigint(v)} END"


def _comparable_version(v: str) -> str:
    """Version as a number for the nutrient switch; text cannot be compared."""
    return f"CASE WHEN {v} IS NULL THEN {DEFAULT_VERSION}D WHEN schema_of_variant({v}) <> 'STRING' THEN {to_double(v)} END"


def _parse_schema(flavor: str) -> str:
    names = [f.name for f in product_schema(flavor)]
    if flavor == "food":
        names.append("nutrition")
    kinds = [f"`{n}` {'string' if n in RAW_TEXT else 'variant'}" for n in names]
    return ", ".join(kinds)


def parse_products(lines: DataFrame, flavor: str) -> DataFrame:
    """All output columns plus ``line``, ``_errors`` and ``_deep``.

    ``_errors`` names the fields that do not fit ("overflow:x" for whole numbers
    too large for the column); it is empty for good rows.  ``_deep`` holds the
    ingredient list of documents nested beyond the unrolled levels: their
    ``ingredients`` is still to be filled, see ``with_deep_ingredients``.
    """
    schema = product_schema(flavor)
    names = [f.name for f in schema]
    raw_names = [n for n in RAW_TEXT if n in names or (flavor == "food" and n == "nutrition")]

    parsed = lines.select(
        "line",
        F.expr(f"from_json(line, '{_parse_schema(flavor)}', {JSON_OPTIONS})").alias("doc"),
        F.expr(f"from_json(line, 'map<string,variant>', {JSON_OPTIONS})").alias("members"),
    )
    # Trailing text after the object is not JSON either.
    split = parsed.select(
        "line",
        "doc",
        F.expr(f"struct({', '.join(f'element_at(members, {chr(39)}{n}{chr(39)}) AS {n}' for n in raw_names)})").alias("raw"),
        F.expr(let(f"coalesce({language_members('members', LANGUAGE_FIELDS)}, array())", "m", last_wins("m"))).alias("languages"),
        F.expr("members IS NULL OR NOT endswith(rtrim(line), '}')").alias("broken"),
    )

    values, checks = {}, {}
    for field in schema:
        name, kind = field.name, field.dataType.simpleString()
        v = f"doc.`{name}`"
        if name in LANGUAGE_FIELDS:
            values[name] = language_list(v, "languages", name)
            checks[name] = language_misfit(name)
        elif name == "images":
            values[name] = images_array(v)
            checks[name] = array_misfit(name)
        elif name == "nutriments":
            values[name] = nutrients("_version", "doc.nutriments", "doc.nutrition")
            checks[name] = nutrients_misfit("_version", name, "raw.nutriments", "raw.nutrition", name)
        elif name == "ingredients":
            values[name] = ingredients_draft(v)
            checks[name] = f"({ingredients_misfit(v, settle(name))} AND NOT coalesce({too_deep(name)}, false))"
        elif name == "owner_fields":
            values[name] = owner_fields(v)
            checks[name] = f"({v} IS NOT NULL AND coalesce(exists({name}, x -> x IS NULL), false))"
        elif name == "packagings":
            values[name] = packagings(v)
            checks[name] = f"({misfit(v, name)} OR coalesce(exists({name}, x -> x IS NULL), false))"
        elif name == "categories_properties":
            values[name] = category_codes(v)
            checks[name] = f"({v} IS NOT NULL AND {name} IS NULL)"
        elif name == "environmental_score_data":
            values[name] = v
            checks[name] = f"({v} IS NOT NULL AND {as_object('raw.' + name)} IS NULL)"
        elif name == "obsolete":
            values[name] = "false"
        elif name == "no_nutrition_data":
            values[name] = flag(v)
        elif name == "schema_version":
            values[name] = version(v)
            checks[name] = f"{name} IS NULL"
        elif name == "environmental_score_score":
            values[name] = score_text(v)
        elif name == "nova_groups":
            values[name] = group_text(v)
        elif name in NUMBER_AS_TEXT:
            values[name] = to_text(v)
        else:
            # 32-bit columns are narrowed later, so that overflow can be told apart.
            convert = {
                "int": to_bigint,
                "bigint": to_bigint,
                "float": to_float,
                "boolean": to_bool,
                "array<string>": to_strings,
                "string": to_str,
            }[kind]
            values[name] = convert(v)
        if name == "code":
            checks[name] = f"{name} IS NULL"
        if name not in checks and name not in ("obsolete", "no_nutrition_data"):
            checks[name] = misfit(v, name)
    if flavor == "food":
        split = split.withColumn("_version", F.expr(_comparable_version("doc.schema_version")))
    # A member that must be an object (or falsy), judged by its JSON type.
    for name in ("images", "owner_fields", "nutriments", "categories_properties"):
        if name in raw_names:
            wrong = f"{as_object('raw.' + name)} IS NULL"
            unless = f"doc.{name} IN ('false', '0', '0.0', '', '[]')" if name != "categories_properties" else "false"
            older = " AND _version < 1003" if name == "nutriments" else ""
            checks[name] = f"({checks[name]} OR (NOT {nothing('raw.' + name)} AND {wrong} AND NOT {unless}{older}))"

    valued = split.select(
        "line", "doc", "raw", "broken", *(["_version"] if flavor == "food" else []),
        *[F.expr(sql).alias(name) for name, sql in values.items()],
    )
    errors = ["CASE WHEN broken THEN 'json' END"]
    errors += [f"CASE WHEN NOT broken AND coalesce({sql}, false) THEN '{name}' END" for name, sql in checks.items()]
    errors += [
        f"CASE WHEN {f.name} IS NOT NULL AND try_cast({f.name} AS INT) IS NULL THEN 'overflow:{f.name}' END"
        for f in schema
        if f.dataType.simpleString() == "int"
    ]
    outputs = []
    for field in schema:
        if field.name == "ingredients":
            outputs.append(F.expr(settle("ingredients")).alias("ingredients"))
        elif field.dataType.simpleString() == "int":
            outputs.append(F.expr(f"try_cast({field.name} AS INT)").alias(field.name))
        else:
            outputs.append(F.col(field.name))
    return valued.select(
        *outputs,
        "line",
        F.expr(f"CASE WHEN {too_deep('ingredients')} THEN to_json(doc.ingredients) END").alias("_deep"),
        pinned(f"array_compact(array({', '.join(errors)}))").alias("_errors"),
    )


def with_deep_ingredients(rows: DataFrame, text: str) -> DataFrame:
    """``ingredients`` filled from the nested list in column ``text``; NULL where the rules refuse it."""
    return rows.withColumn("ingredients", deep_ingredients(text))


def good_rows(rows: DataFrame, flavor: str) -> DataFrame:
    """Rows without errors, in the output schema."""
    return in_schema(rows.filter(F.size("_errors") == 0), product_schema(flavor))


def quarantine(rows: DataFrame) -> DataFrame:
    """Refused rows: code, the fields at fault, and the line as read."""
    return rows.filter(F.size("_errors") > 0).select(
        "code", F.col("_errors").alias("errors"), "line"
    )


NOTE = "errors ARRAY<STRING>, line STRING, deep STRING"


def by_outcome(rows: DataFrame) -> DataFrame:
    """Parsed rows with ``outcome`` (good, refused, or deep: list still to be filled) and a note on those not good."""
    outcome = F.when(F.col("_deep").isNotNull(), "deep").when(F.size("_errors") > 0, "refused").otherwise(GOOD)
    note = F.when(outcome != GOOD, F.struct(F.col("_errors").alias("errors"), "line", F.col("_deep").alias("deep")))
    return rows.withColumns({"outcome": outcome, "note": note}).drop("line", "_errors", "_deep")


def export_products(
    spark: SparkSession,
    source: str | DataFrame,
    target: str,
    flavor: str,
    quarantine_target: str | None = None,
    on_overflow: str = "quarantine",
) -> ExportReport:
    """JSON lines at ``source`` (or of its column ``line``) to Parquet at ``target``.

    Refused rows go to ``quarantine_target`` when given.  Whole numbers too large
    for their column refuse the row, or stop the export with
    ``on_overflow="fail"``.  Rows are counted in the pass that writes them.
    Row groups are bounded and hold a Bloom filter on ``code``.
    Every row is written once, except those refused or with a deeply nested
    ingredient list.
    """
    schema = product_schema(flavor)  # an unknown flavor fails before any work
    if on_overflow not in ("quarantine", "fail"):
        raise ValueError(f"unknown on_overflow: {on_overflow}")
    lines = read_lines(spark, source) if isinstance(source, str) else source
    whole = [f"overflow:{f.name}" for f in schema if f.dataType.simpleString() == "int"]
    rows, seen = counted(parse_products(lines, flavor), ["json", *schema.names, *whole])
    stage = staging_path(target)
    try:
        first, second = (Outcomes(spark, f"{stage}/{part}", schema, "code") for part in ("first", "second"))
        first.write(by_outcome(rows), **row_groups(bloom="code"))
        counts = seen.get
        if on_overflow == "fail" and any(counts[name] for name in whole):
            bad = first.read("refused", NOTE).unionByName(first.read("deep", NOTE))
            row = bad.filter(F.expr("exists(note.errors, e -> startswith(e, 'overflow:'))")).head()
            raise OverflowError(f"product {row.code}: {row.note.errors}")
        refused = [first.read("refused", NOTE)]
        if first.has("deep"):
            deep = with_deep_ingredients(first.read("deep", NOTE), "note.deep")
            late = F.when(F.col("ingredients").isNull(), F.array(F.lit("ingredients"))).otherwise(F.expr("CAST(array() AS ARRAY<STRING>)"))
            deep = deep.withColumns({"_errors": F.concat("note.errors", late), "line": F.col("note.line"), "_deep": F.lit(None).cast("string")})
            deep, seen = counted(deep, ["ingredients"], F.col("ingredients").isNull() & (F.size("note.errors") == 0))
            second.write(by_outcome(deep), **row_groups(bloom="code"))
            counts = {name: n + seen.get.get(name, 0) * (name != "read") for name, n in counts.items()}
            refused.append(second.read("refused", NOTE))
        first.commit(target, second)
        if quarantine_target:
            out = reduce(DataFrame.unionByName, refused).select("code", "note.errors", "note.line")
            write_parquet(out, quarantine_target)
    finally:
        delete_path(spark, stage)
    return ExportReport.of(counts)
