"""Reading typed values out of VARIANT columns.

Each ``to_*`` helper returns SQL text that is NULL when the JSON value does not
fit the target.  Absent values and JSON ``null`` also give NULL; ``misfit``
tells the two apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

JSON_OPTIONS = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"


def member(v: str, name: str) -> str:
    """Object member as VARIANT; NULL when absent or when ``v`` is no object."""
    return f"try_variant_get({v}, '$[\\'{name}\\']', 'variant')"


def nothing(v: str) -> str:
    """True for an absent value or JSON null."""
    return f"({v} IS NULL OR is_variant_null({v}))"


def misfit(v: str, value: str) -> str:
    """True when ``v`` holds something but its coerced ``value`` is NULL."""
    return f"({v} IS NOT NULL AND NOT is_variant_null({v}) AND {value} IS NULL)"


def falsy(v: str) -> str:
    """True for absent, null, false, 0, and empty text, list or object."""
    return (
        f"({v} IS NULL OR is_variant_null({v}) OR "
        f"to_json({v}) IN ('false', '0', '0.0', '-0.0', '\"\"', '[]', '{{}}'))"
    )


def falsy_text(text: str) -> str:
    """``falsy`` for a member held as raw JSON text."""
    return f"({text} IS NULL OR {text} IN ('null', 'false', '0', '0.0', '-0.0', '', '[]', '{{}}'))"


def as_object(v: str) -> str:
    return f"try_variant_get({v}, '$', 'map<string,variant>')"


def as_list(v: str) -> str:
    return f"try_variant_get({v}, '$', 'array<variant>')"


def as_record(v: str, names, many: bool = False) -> str:
    """Object as a struct of its named members (VARIANT each); NULL when it is none.

    One cast instead of a lookup per member.  ``many`` reads a list of objects.
    """
    record = f"struct<{', '.join(f'`{n}`: variant' for n in names)}>"
    return f"try_variant_get({v}, '$', '{f'array<{record}>' if many else record}')"


def object_entries(text: str) -> str:
    """Members of a JSON object text, in document order."""
    return f"map_entries(from_json({text}, 'map<string,variant>', {JSON_OPTIONS}))"


def last_wins(entries: str) -> str:
    """Entries with each key once: first position, last value.

    ``entries`` should be a plain column or lambda variable, as it is used
    several times.
    """
    keys = f"transform({entries}, lw -> lw.key)"
    return (
        f"CASE WHEN size(array_distinct({keys})) = size({entries}) THEN {entries} "
        f"ELSE transform(array_distinct({keys}), "
        f"lk -> element_at(filter({entries}, lw -> lw.key = lk), -1)) END"
    )


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def pinned(sql: str) -> Column:
    """Column that filters are not pushed through.

    A filter on a checked column would otherwise move below the projection that
    computes it and parse every document a second time.  Row ids are never
    negative, so the value is always ``sql``.
    """
    return F.when(F.monotonically_increasing_id() >= 0, F.expr(sql))


def text_of(v: str) -> str:
    return f"try_variant_get({v}, '$', 'string')"


def int_from_text(s: str) -> str:
    """Whole number written as text: sign, underscores and a zero fraction pass."""
    digits = f"regexp_extract({s}, r'^\\s*([+-]?[0-9]+(?:_[0-9]+)*)(?:\\.0*)?\\s*$', 1)"
    return f"try_cast(replace({digits}, '_', '') AS BIGINT)"


def float_from_text(s: str) -> str:
    pattern = (
        r"^\s*[+-]?((([0-9]+(_[0-9]+)*)\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"
        r"|(?i:inf|infinity|nan))\s*$"
    )
    return (
        f"CASE WHEN {s} RLIKE r'{pattern}' "
        f"THEN try_cast(replace(trim({s}), '_', '') AS DOUBLE) END"
    )


def to_bigint(v: str) -> str:
    number = f"try_variant_get({v}, '$', 'double')"
    return (
        f"CASE WHEN schema_of_variant({v}) = 'STRING' THEN {int_from_text(text_of(v))} "
        f"WHEN {number} = rint({number}) THEN try_variant_get({v}, '$', 'bigint') END"
    )


def to_int(v: str) -> str:
    return f"try_cast({to_bigint(v)} AS INT)"


def to_double(v: str) -> str:
    return (
        f"CASE WHEN schema_of_variant({v}) = 'STRING' THEN {float_from_text(text_of(v))} "
        f"ELSE try_variant_get({v}, '$', 'double') END"
    )


def to_float(v: str) -> str:
    """Single precision; rounds without complaint."""
    return f"CAST({to_double(v)} AS FLOAT)"


def to_str(v: str) -> str:
    return f"CASE WHEN schema_of_variant({v}) = 'STRING' THEN {text_of(v)} END"


def to_text(v: str) -> str:
    """Text, or a number written out (500 -> '500', 500.0 -> '500.0')."""
    number = f"try_variant_get({v}, '$', 'double')"
    return (
        f"CASE WHEN schema_of_variant({v}) IN ('STRING', 'BIGINT') THEN {text_of(v)} "
        f"WHEN schema_of_variant({v}) RLIKE r'^DECIMAL\\((19|[23][0-9]),0\\)$' THEN {text_of(v)} "
        f"WHEN schema_of_variant({v}) = 'BOOLEAN' THEN NULL "
        f"ELSE {float_text(number)} END"
    )


def to_bool(v: str) -> str:
    # The words read as true and false.
    words = (
        f"CASE WHEN lower({text_of(v)}) IN ('true', 'on', 'yes', 'y', 't', '1') THEN true "
        f"WHEN lower({text_of(v)}) IN ('false', 'off', 'no', 'n', 'f', '0') THEN false END"
    )
    return (
        f"CASE schema_of_variant({v}) "
        f"WHEN 'BOOLEAN' THEN try_variant_get({v}, '$', 'boolean') "
        f"WHEN 'STRING' THEN {words} "
        f"ELSE CASE try_variant_get({v}, '$', 'double') WHEN 1D THEN true WHEN 0D THEN false END END"
    )


def to_strings(v: str) -> str:
    """List of texts; one element of another type spoils the whole list."""
    elements = f"try_variant_get({v}, '$', 'array<string>')"
    # Two joins that differ only in how they show a NULL element.
    no_null = f"array_join({elements}, '', '0') = array_join({elements}, '', '1')"
    return (
        f"CASE WHEN schema_of_variant({v}) IN ('ARRAY<STRING>', 'ARRAY<VOID>') AND {no_null} "
        f"THEN {elements} END"
    )


def to_decimal(v: str, precision: int = 10, scale: int = 3) -> str:
    """Exact decimal; NULL when digits would be lost."""
    exact = (
        f"CASE schema_of_variant({v}) "
        f"WHEN 'STRING' THEN CASE WHEN {text_of(v)} RLIKE "
        f"r'^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$' "
        f"THEN try_cast(trim({text_of(v)}) AS DECIMAL(38,18)) END "
        f"WHEN 'DOUBLE' THEN try_cast({text_of(v)} AS DECIMAL(38,18)) "
        f"WHEN 'BOOLEAN' THEN NULL "
        f"ELSE try_variant_get({v}, '$', 'decimal(38,18)') END"
    )
    # Most members are absent; for them the lambda, which is interpreted, is left out.
    return f"CASE WHEN {v} IS NOT NULL THEN {let(exact, 'd', exact_decimal('d', precision, scale))} END"


def exact_decimal(d: str, precision: int = 10, scale: int = 3) -> str:
    """Narrow a wide decimal, giving NULL instead of rounding or overflow."""
    narrow = f"try_cast({d} AS DECIMAL({precision},{scale}))"
    return f"CASE WHEN {narrow} = {d} THEN {narrow} END"


def to_date(v: str) -> str:
    return (
        f"CASE WHEN schema_of_variant({v}) = 'STRING' AND {text_of(v)} RLIKE "
        f"r'^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([T ]00:00(:00(\\.0+)?)?Z?)?$' "
        f"THEN try_cast(left({text_of(v)}, 10) AS DATE) "
        f"WHEN schema_of_variant({v}) = 'BIGINT' "
        f"AND pmod(try_variant_get({v}, '$', 'bigint'), 86400L) = 0 "
        f"THEN date_from_unix_date(CAST(try_variant_get({v}, '$', 'bigint') DIV 86400 AS INT)) END"
    )


def to_timestamp(v: str) -> str:
    """ISO date-time, or seconds since the epoch; a missing zone means UTC."""
    s = text_of(v)
    zoned = f"CASE WHEN {s} RLIKE r'(Z|z|[+-][0-9]{{2}}:?[0-9]{{2}})$' THEN upper({s}) ELSE concat(upper({s}), 'Z') END"
    # A colon in the offset is what the cast understands.
    canonical = f"regexp_replace({zoned}, r'([+-][0-9]{{2}})([0-9]{{2}})$', '$1:$2')"
    return (
        f"CASE WHEN schema_of_variant({v}) = 'STRING' AND {s} RLIKE "
        f"r'^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[Tt _][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}([.,][0-9]{{1,6}})?)?"
        f"(Z|z|[+-][0-9]{{2}}:?[0-9]{{2}})?$' THEN try_cast({canonical} AS TIMESTAMP) "
        f"WHEN schema_of_variant({v}) = 'STRING' AND {s} RLIKE r'^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$' "
        f"THEN try_cast(concat({s}, 'T00:00:00Z') AS TIMESTAMP) "
        f"WHEN schema_of_variant({v}) = 'BIGINT' THEN timestamp_seconds(try_variant_get({v}, '$', 'bigint')) "
        f"END"
    )


def float_text(d: str, json: bool = False) -> str:
    """Shortest decimal text of a double.

    Plain notation from 1e-4 (1e-5 with ``json``) up to 1e16, exponent form
    outside; the exponent is signed and two digits wide unless ``json``.
    """
    java = f"CAST({d} AS STRING)"
    power = "CAST(split_part(ft, 'E', 2) AS INT)"
    plain = (
        "regexp_replace(regexp_replace("
        "CAST(CAST(ft AS DECIMAL(38,21)) AS STRING), '0+$', ''), r'\\.$', '.0')"
    )
    mantissa = "regexp_replace(split_part(ft, 'E', 1), r'\\.0$', '')"
    if json:
        exponent = "split_part(ft, 'E', 2)"
    else:
        exponent = f"concat(CASE WHEN {power} < 0 THEN '-' ELSE '+' END, CASE WHEN abs({power}) < 10 THEN '0' ELSE '' END, CAST(abs({power}) AS STRING))"
    lowest = -5 if json else -4
    scientific = let(
        java,
        "ft",
        f"CASE WHEN {power} >= {lowest} AND {power} < 16 THEN {plain} "
        f"ELSE concat({mantissa}, 'e', {exponent}) END",
    )
    return f"CASE WHEN {java} LIKE '%E%' THEN {scientific} ELSE {java} END"
