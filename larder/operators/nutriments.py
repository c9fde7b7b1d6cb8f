"""Nutrients: suffix pivot, aggregated sets, and the version switch between them."""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.variants import (
    JSON_OPTIONS,
    as_list,
    as_object,
    as_record,
    falsy_text,
    last_wins,
    let,
    misfit,
    nothing,
    object_entries,
    pinned,
    to_float,
    to_str,
)

# Key suffixes in the order they are tried, with the slot each fills.
SUFFIXES = (
    ("_prepared_100g", "prepared_100g"),
    ("_prepared_serving", "prepared_serving"),
    ("_prepared_unit", "prepared_unit"),
    ("_prepared_value", "prepared_value"),
    ("_unit", "unit"),
    ("_value", "value"),
    ("_100g", "100g"),
    ("_serving", "serving"),
)
# Slots in output order.
SLOTS = (
    "value",
    "100g",
    "serving",
    "unit",
    "prepared_value",
    "prepared_100g",
    "prepared_serving",
    "prepared_unit",
)
# From this document version on, nutrients come from the aggregated set.
FIRST_AGGREGATED_VERSION = 1003

def _single_assignment(e: str) -> str:
    """One (name, slot, value) for a key whose name part holds no further suffix."""
    prepared = f"endswith({e}.stem, '_prepared')"
    name = f"CASE WHEN {prepared} THEN left({e}.stem, length({e}.stem) - 9) ELSE {e}.stem END"
    slot = f"CASE WHEN {prepared} THEN concat('prepared_', {e}.last) ELSE {e}.last END"
    return f"array(named_struct('name', {name}, 'slot', {slot}, 'value', {e}.value))"


def _all_assignments(e: str) -> str:
    """Assignments of a key carrying several suffixes.

    The suffixes are tried one after the other; a hit removes every occurrence
    from the key and the rest are tried on what is left.
    """
    start = (
        f"named_struct('key', {e}.key, 'found', CAST(array() AS ARRAY<STRUCT<name STRING, slot STRING>>))"
    )
    suffixes = ", ".join(f"struct('{suffix}' AS suffix, '{slot}' AS slot)" for suffix, slot in SUFFIXES)
    rest = "replace(s.key, x.suffix, '')"
    hit = (
        f"named_struct('key', {rest}, 'found', "
        f"concat(s.found, array(named_struct('name', {rest}, 'slot', x.slot))))"
    )
    found = (
        f"aggregate(array({suffixes}), {start}, "
        f"(s, x) -> CASE WHEN endswith(s.key, x.suffix) THEN {hit} ELSE s END, s -> s.found)"
    )
    return f"transform({found}, h -> named_struct('name', h.name, 'slot', h.slot, 'value', {e}.value))"


def assignments(entries: str) -> str:
    """(name, slot, value) per suffix hit, in document order.  Keys without a suffix give none."""
    endings = ("100g", "serving", "unit", "value")
    words = ", ".join(f"'{x}'" for x in endings)
    ended = (
        f"transform({entries}, e -> named_struct('key', e.key, 'value', e.value, "
        f"'last', substring_index(e.key, '_', -1)))"
    )
    relevant = f"filter({ended}, e -> e.last IN ({words}) AND e.last <> e.key)"
    stemmed = (
        f"transform({relevant}, e -> named_struct('key', e.key, 'value', e.value, 'last', e.last, "
        f"'stem', left(e.key, length(e.key) - length(e.last) - 1)))"
    )
    crowded = " OR ".join(f"contains(e.stem, '_{x}')" for x in endings)
    return (
        f"flatten(transform({stemmed}, e -> CASE WHEN {crowded} "
        f"THEN {_all_assignments('e')} ELSE {_single_assignment('e')} END))"
    )


def _nutrient(name: str, slots: dict[str, str]) -> str:
    """Nutrient struct from SQL text per slot; slots not given are NULL."""
    parts = [f"'name', {name}"]
    for slot in SLOTS:
        kind = "STRING" if slot.endswith("unit") else "FLOAT"
        parts.append(f"'{slot}', {slots.get(slot, f'CAST(NULL AS {kind})')}")
    return f"named_struct({', '.join(parts)})"


def pivot_suffixes(text: str) -> str:
    """Flat ``{salt_100g: .., salt_unit: ..}`` text to nutrient structs.

    Absent or empty text gives NULL; no suffix at all gives an empty array.  A
    value that does not fit, or text that is no object, gives an array holding
    one NULL.
    """
    keyed = "transform(a, x -> named_struct('key', concat(x.name, '\\u0001', x.slot), 'value', x.value))"
    is_unit = "endswith(x.key, 'unit')"
    # Each value is converted once, before it is placed in its slot.
    converted = (
        f"transform({let(keyed, 'k', last_wins('k'))}, x -> named_struct('key', x.key, 'value', named_struct("
        f"'number', CASE WHEN NOT {is_unit} THEN {to_float('x.value')} END, "
        f"'text', CASE WHEN {is_unit} THEN {to_str('x.value')} END, 'raw', x.value)))"
    )
    odd = (
        f"exists(c, x -> NOT {nothing('x.value.raw')} AND x.value.number IS NULL AND x.value.text IS NULL)"
    )

    def placed(slot: str) -> str:
        kind = "text" if slot.endswith("unit") else "number"
        return f"element_at(v, concat(n, '\\u0001{slot}')).{kind}"

    nutrient = _nutrient("n", {slot: placed(slot) for slot in SLOTS})
    structs = f"transform(array_distinct(transform(a, x -> x.name)), n -> {nutrient})"
    filled = let("map_from_entries(c)", "v", structs)
    checked = let(converted, "c", f"CASE WHEN {odd} THEN array(NULL) ELSE {filled} END")
    pivoted = let(assignments(last_wins("m")), "a", checked)
    return (
        f"CASE WHEN {falsy_text(text)} THEN NULL "
        f"ELSE {let(object_entries(text), 'm', f'CASE WHEN m IS NULL THEN array(NULL) ELSE {pivoted} END')} END"
    )


# --- the same pivot, batch by batch --------------------------------------------------

_SLOT_TYPES = [(slot, pa.string() if slot.endswith("unit") else pa.float32()) for slot in SLOTS]
_NUTRIENT = pa.struct([pa.field("name", pa.string()), *[pa.field(slot, kind) for slot, kind in _SLOT_TYPES]])
_NUMBER_TEXT = re.compile(r"[+-]?[0-9]{1,15}(\.[0-9]{1,15})?", re.ASCII)
_LONG_NUMBER = re.compile(r"[0-9.]{300}", re.ASCII)
_MOST_TEXT, _MOST_KEYS = 1 << 20, 1 << 17  # longer documents go to the expression; keys remembered in plans


class _Odd(Exception):
    """The document is left to the expression."""


def _odd(value):
    raise _Odd


_SCAN = json.JSONDecoder(parse_constant=_odd).scan_once
_PLANS: dict[tuple[str, ...], tuple[list[str], list[tuple[int, ...]]]] = {}
_planned = 0


def _hits(key: str) -> list[tuple[str, int, bool]]:
    """(name, slot number, whether it is a unit) per suffix hit of a key."""
    found = []
    for suffix, slot in SUFFIXES:
        if key.endswith(suffix):
            key = key.replace(suffix, "")
            key.encode()  # half a surrogate pair is no text
            found.append((key, SLOTS.index(slot), slot.endswith("unit")))
    return found


def _plan(keys: tuple[str, ...]) -> tuple[list[str], list[tuple[int, ...]]]:
    """Names of a document with these keys, and the cells each key fills (~cell for a unit)."""
    global _planned
    if _planned > _MOST_KEYS:
        _PLANS.clear()
        _planned = 0
    names: dict[str, int] = {}
    cells = []
    for key in keys:
        spots = [(names.setdefault(name, len(names)) * len(SLOTS) + slot, unit) for name, slot, unit in _hits(key)]
        cells.append(tuple(~at if unit else at for at, unit in spots))
    _planned += len(keys)
    _PLANS[keys] = list(names), cells
    return _PLANS[keys]


def _plain_cells(text: str) -> tuple[list[str], list]:
    """Names, and the slots of each in a row, of a document whose values leave no question; any other raises."""
    # Lists, inner objects and -0 are rare here.
    if len(text) > _MOST_TEXT or "[" in text or "-0" in text or text.find("{", 1) > 0:
        raise _Odd
    if len(text) > 300 and _LONG_NUMBER.search(text):
        raise _Odd
    doc, end = _SCAN(text, 0)
    if end != len(text) or type(doc) is not dict or not doc:
        raise _Odd
    keys = tuple(doc)
    names, places = _PLANS.get(keys) or _plan(keys)
    cells = [None] * (len(names) * len(SLOTS))
    for value, spots in zip(doc.values(), places):
        kind = type(value)
        if kind is int:
            if not -(10**18) < value < 10**18:
                raise _Odd
            number = float(value)
        elif kind is float:
            if not -1e300 < value < 1e300:
                raise _Odd
            number = value
        elif kind is not str and value is not None:
            raise _Odd
        for at in spots:
            if at < 0:
                if kind is str:
                    value.isascii() or value.encode()
                elif value is not None:
                    raise _Odd
                cells[~at] = value
            elif kind is str:
                if not _NUMBER_TEXT.fullmatch(value):
                    raise _Odd
                cells[at] = float(value)
            else:
                cells[at] = None if value is None else number
    return names, cells


_SPARK_NUTRIENT = T.StructType([
    T.StructField("name", T.StringType()),
    *[T.StructField(slot, T.StringType() if slot.endswith("unit") else T.FloatType()) for slot in SLOTS],
])


@F.arrow_udf(T.StructType([T.StructField("plain", T.BooleanType()), T.StructField("n", T.ArrayType(_SPARK_NUTRIENT))]))
def _pivot_plain(texts: pa.Array) -> pa.Array:
    plain, ends, names, cells = [], [0], [], []
    for text in texts.to_pylist():
        fits = text is not None
        if fits:
            try:
                some, filled = _plain_cells(text)
                names += some
                cells += filled
            except (_Odd, ValueError, StopIteration, RecursionError):
                fits = False
        plain.append(fits)
        ends.append(len(names))
    arrays = []
    for i, (_, kind) in enumerate(_SLOT_TYPES):
        column = cells[i :: len(SLOTS)]
        arrays.append(pa.array(column, kind) if kind == pa.string() else pa.array(column, pa.float64()).cast(kind, safe=False))
    structs = pa.StructArray.from_arrays([pa.array(names, pa.string()), *arrays], fields=list(_NUTRIENT))
    nutrients = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)
    return pa.StructArray.from_arrays([pa.array(plain, pa.bool_()), nutrients], ["plain", "n"])


def pivoted(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the column ``name``: what ``pivot_suffixes`` gives for the text column ``text``.

    A lambda of the expression is interpreted node by node, which costs most of
    its time.  Documents of plain numbers, texts and nulls, nearly all of them,
    are pivoted in Arrow batches instead; the others are left to the expression.
    """
    # Bytes that are no text would stop the batch.
    tried = df.withColumn("_plain", _pivot_plain(F.expr(f"CASE WHEN is_valid_utf8(`{text}`) THEN `{text}` END")))
    return tried.withColumn(
        name, pinned(f"CASE WHEN _plain.plain THEN _plain.n ELSE {pivot_suffixes(f'`{text}`')} END")
    ).drop("_plain")


def aggregated_nutrients(text: str) -> str:
    """``nutrition`` text to nutrient structs, or NULL without an aggregated set.

    Sold-as-is sets fill the plain slots, any other preparation the prepared
    ones; per 100 g or 100 ml goes to the 100g slot, everything else to serving.
    ``value`` and ``prepared_value`` stay NULL.  A set that is no object, has no
    nutrients, or names its amount or preparation by anything but text gives an
    array holding one NULL.
    """
    raw = f"from_json({text}, 'aggregated_set variant', {JSON_OPTIONS}).aggregated_set"
    parsed = (
        f"from_json({text}, 'aggregated_set struct<nutrients map<string,variant>, "
        f"per variant, preparation variant>', {JSON_OPTIONS}).aggregated_set"
    )
    amount, unit = to_float("r.value"), to_str("r.unit")
    # Absent members count as any other amount and preparation.
    per_100 = f"coalesce({to_str('g.per')} IN ('100g', '100ml'), false)"
    sold = f"coalesce({to_str('g.preparation')} = 'as_sold', false)"
    odd = f"({misfit('g.per', to_str('g.per'))} OR {misfit('g.preparation', to_str('g.preparation'))})"
    none = "CAST(NULL AS FLOAT)"
    value = _nutrient(
        "e.key",
        {
            "100g": f"CASE WHEN {sold} AND {per_100} THEN {amount} ELSE {none} END",
            "serving": f"CASE WHEN {sold} AND NOT {per_100} THEN {amount} ELSE {none} END",
            "unit": f"CASE WHEN {sold} THEN {unit} END",
            "prepared_100g": f"CASE WHEN NOT {sold} AND {per_100} THEN {amount} ELSE {none} END",
            "prepared_serving": f"CASE WHEN NOT {sold} AND NOT {per_100} THEN {amount} ELSE {none} END",
            "prepared_unit": f"CASE WHEN NOT {sold} THEN {unit} END",
        },
    )
    fits = (
        f"r IS NOT NULL AND NOT {misfit('r.value', amount)} AND NOT {misfit('r.unit', unit)}"
    )
    record = as_record("e.value", ("value", "unit"))
    each = f"transform(d, e -> {let(record, 'r', f'CASE WHEN {fits} THEN {value} END')})"
    filled = let(
        parsed,
        "g",
        f"CASE WHEN g IS NULL OR g.nutrients IS NULL OR {odd} THEN array(NULL) "
        f"ELSE {let('map_entries(g.nutrients)', 'm', let(last_wins('m'), 'd', each))} END",
    )
    return let(
        raw, "w", f"CASE WHEN {nothing('w')} THEN NULL WHEN {as_object('w')} IS NULL THEN array(NULL) ELSE {filled} END"
    )


def nutrients(version: str, nutriments_text: str, nutrition_text: str) -> str:
    """Version switch: suffix pivot before the first aggregated version, else the set."""
    return (
        f"CASE WHEN {version} < {FIRST_AGGREGATED_VERSION} THEN {pivot_suffixes(nutriments_text)} "
        f"ELSE {aggregated_nutrients(nutrition_text)} END"
    )


def nutrients_misfit(
    version: str, nutriments: str, nutriments_raw: str, nutrition_raw: str, column: str
) -> str:
    """True when the switch refuses the document.

    ``*_raw`` are the two members as VARIANT.  From the aggregated version on, a
    flat object left in the document is refused unless a set replaces it, and
    ``nutrition`` must be an object where it is given.
    """
    stray = (
        f"({nutriments_raw} IS NOT NULL AND NOT is_variant_null({nutriments_raw}) "
        f"AND coalesce(size({as_list(nutriments_raw)}), -1) <> 0 AND {column} IS NULL)"
    )
    wrong_nutrition = f"({nutrition_raw} IS NOT NULL AND {as_object(nutrition_raw)} IS NULL)"
    newer = f"{version} >= {FIRST_AGGREGATED_VERSION}"
    return (
        f"({version} IS NULL OR coalesce(exists({column}, x -> x IS NULL), false) "
        f"OR ({newer} AND ({stray} OR {wrong_nutrition})))"
    )


def nutrient_index(column: str) -> str:
    """Map from nutrient name to its struct; of repeated names the last wins."""
    keyed = f"transform({column}, x -> named_struct('key', x.name, 'value', x))"
    return f"map_from_entries({let(keyed, 'k', last_wins('k'))})"


def nutrient_names(column: str) -> str:
    """Distinct nutrient names, sorted."""
    return f"sort_array(array_distinct(transform({column}, x -> x.name)))"
