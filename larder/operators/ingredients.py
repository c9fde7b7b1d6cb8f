"""Nested ingredient lists as canonical JSON text, at any depth.

Spark has no recursive column type, so the JVM expression is unrolled to
``DEPTH`` levels.  Documents nested deeper (rare) are finished by a small
Arrow-batched helper that applies the same rules, so none is cut or lost.
"""

from __future__ import annotations

import json
import math
import re
from decimal import Decimal

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from larder.functions.variants import (
    as_list,
    as_record,
    float_text,
    let,
    nothing,
    to_bigint,
    to_double,
    to_str,
)
from larder.schemas import ingredient_fields

DEPTH = 4
FIELD_NAMES = tuple(name for name, _ in ingredient_fields())
PRUNED_NAMES = ("id", "text", "ingredients")
# Marks inside the text under construction; JSON text never holds raw controls.
INVALID, DEEPER = "\\u0001", "\\u0002"


def _list_text(v: str, names, render, level: int) -> str:
    i = f"i{level}"
    records = as_record(v, names, many=True)
    return (
        f"concat('[', array_join(transform({records}, {i} -> {render(i, level)}), ',', "
        f"'{INVALID}'), ']')"
    )


def _ingredient_text(v: str, level: int, depth: int) -> str:
    """JSON text of one ingredient: every declared field, NULL when one does not fit."""
    parts = []
    for name, kind in ingredient_fields():
        m = f"{v}.{name}"
        if kind == "LIST":
            if level < depth:
                text = _list_text(m, FIELD_NAMES, lambda i, n: _ingredient_text(i, n, depth), level + 1)
            else:
                text = f"CASE WHEN {as_list(m)} IS NOT NULL THEN '{DEEPER}' END"
        elif kind == "FLOAT":
            text = let(to_double(m), "d", f"CASE WHEN isnan(d) OR abs(d) = double('infinity') THEN 'null' ELSE {float_text('d', json=True)} END")
        elif kind == "INT":
            text = f"CAST({to_bigint(m)} AS STRING)"
        else:
            text = f"CASE WHEN {to_str(m)} IS NOT NULL THEN to_json({m}) END"
        parts.append(f"'\"{name}\":', CASE WHEN {nothing(m)} THEN 'null' ELSE {text} END")
    body = ", ',', ".join(parts)
    return f"CASE WHEN {v} IS NOT NULL THEN concat('{{', {body}, '}}') END"


def ingredients_draft(v: str, depth: int = DEPTH) -> str:
    """JSON text of an ingredient list, possibly holding marks; NULL if it is no list."""
    return _list_text(v, FIELD_NAMES, lambda i, n: _ingredient_text(i, n, depth), 1)


def settle(draft: str) -> str:
    """Text without marks, else NULL.  ``draft`` should be a column."""
    return (
        f"CASE WHEN NOT contains({draft}, '{INVALID}') AND NOT contains({draft}, '{DEEPER}') "
        f"THEN {draft} END"
    )


def too_deep(draft: str) -> str:
    return f"(contains({draft}, '{DEEPER}') AND NOT contains({draft}, '{INVALID}'))"


def ingredients_misfit(v: str, column: str) -> str:
    return f"({v} IS NOT NULL AND NOT is_variant_null({v}) AND {column} IS NULL)"


# --- the same rules for deeper documents -----------------------------------------

_INT_TEXT = re.compile(r"\s*([+-]?[0-9]+(?:_[0-9]+)*)(?:\.0*)?\s*")
_INT_RANGE = range(-(2**63), 2**63)


def _as_float(value) -> float:
    if isinstance(value, str) and not value.isascii():
        raise ValueError("no number")
    if isinstance(value, (str, bool, int, float)):
        return float(value)
    raise ValueError("no number")


def _as_int(value) -> int:
    whole = None
    if isinstance(value, str):
        match = _INT_TEXT.fullmatch(value)
        whole = int(match.group(1)) if match else None
    elif isinstance(value, (bool, int)) or (isinstance(value, float) and value.is_integer()):
        whole = int(value)
    if whole is None or whole not in _INT_RANGE:
        raise ValueError("no whole number")
    return whole


def _float_json(value: float) -> str:
    if not math.isfinite(value):
        return "null"
    text = repr(value)
    if "e" not in text:
        return text
    power = int(text.split("e")[1])
    if -5 <= power < 16:
        return format(Decimal(text), "f")
    return text.split("e")[0] + "e" + str(power)


def _render(ingredient) -> str:
    if not isinstance(ingredient, dict):
        raise ValueError("no object")
    parts = []
    for name, kind in ingredient_fields():
        value = ingredient.get(name)
        if value is None:
            text = "null"
        elif kind == "LIST":
            if not isinstance(value, list):
                raise ValueError("no list")
            text = "[" + ",".join(map(_render, value)) + "]"
        elif kind == "FLOAT":
            text = _float_json(_as_float(value))
        elif kind == "INT":
            text = str(_as_int(value))
        elif isinstance(value, str):
            text = json.dumps(value, ensure_ascii=False)
        else:
            raise ValueError("no text")
        parts.append(f'"{name}":{text}')
    return "{" + ",".join(parts) + "}"


def _deep_text(text: str | None) -> str | None:
    if text is None:
        return None
    try:
        return "[" + ",".join(map(_render, json.loads(text))) + "]"
    except (ValueError, RecursionError):  # beyond what can be nested, as for what does not fit, the row is refused
        return None


@F.pandas_udf(StringType())
def deep_ingredients(texts: pd.Series) -> pd.Series:
    """Canonical text of the lists that nest deeper than the unrolled levels."""
    return texts.map(_deep_text)


# --- pruning to (id, text, ingredients) -------------------------------------------


def _pruned_text(v: str, level: int, depth: int) -> str:
    parts = []
    for name in ("id", "text"):
        m = f"{v}.{name}"
        parts.append(f"CASE WHEN {m} IS NOT NULL THEN concat('\"{name}\":', to_json({m})) END")
    m = f"{v}.ingredients"
    if level < depth:
        nested = _list_text(m, PRUNED_NAMES, lambda i, n: _pruned_text(i, n, depth), level + 1)
    else:
        nested = f"'{DEEPER}'"
    listed = f"CASE WHEN size({as_list(m)}) > 0 THEN {nested} ELSE 'null' END"
    parts.append(f"CASE WHEN {m} IS NOT NULL THEN concat('\"ingredients\":', {listed}) END")
    return f"concat('{{', concat_ws(',', {', '.join(parts)}), '}}')"


def pruned_draft(v: str, depth: int = DEPTH) -> str:
    """Ingredient list reduced to id, text and sub-ingredients, as JSON text."""
    return _list_text(v, PRUNED_NAMES, lambda i, n: _pruned_text(i, n, depth), 1)


def _prune(ingredient) -> dict:
    if not isinstance(ingredient, dict):
        raise ValueError("no object")
    kept = {k: ingredient[k] for k in ("id", "text") if k in ingredient}
    if "ingredients" in ingredient:
        kept["ingredients"] = [_prune(i) for i in ingredient["ingredients"] or []] or None
    return kept


@F.pandas_udf(StringType())
def deep_pruned(texts: pd.Series) -> pd.Series:
    """``pruned_draft`` for lists that nest deeper than the unrolled levels."""

    def one(text):
        if text is None:
            return None
        try:
            pruned = [_prune(i) for i in json.loads(text)]
        except (TypeError, ValueError):
            return None
        return json.dumps(pruned, ensure_ascii=False, separators=(",", ":"))

    return texts.map(one)
