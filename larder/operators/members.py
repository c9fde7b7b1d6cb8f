"""Smaller nested members: owner fields, packagings, category codes."""

from __future__ import annotations

from larder.functions.variants import (
    as_record,
    falsy_text,
    last_wins,
    let,
    misfit,
    object_entries,
    to_bigint,
    to_float,
    to_int,
    to_str,
    to_text,
)


def owner_fields(text: str) -> str:
    """``{field: epoch}`` text to (field_name, timestamp) structs; falsy text gives NULL.

    An element is NULL when its timestamp does not fit.
    """
    one = (
        f"CASE WHEN {to_bigint('e.value')} IS NOT NULL THEN "
        f"named_struct('field_name', e.key, 'timestamp', {to_bigint('e.value')}) END"
    )
    each = let(object_entries(text), "m", f"transform({last_wins('m')}, e -> {one})")
    return f"CASE WHEN {falsy_text(text)} THEN NULL ELSE {each} END"


def packagings(v: str) -> str:
    """List of packaging objects; an element is NULL when it does not fit."""
    fields = {
        "material": to_str,
        "number_of_units": to_bigint,
        "quantity_per_unit": to_str,
        "quantity_per_unit_unit": to_str,
        "quantity_per_unit_value": to_text,
        "recycling": to_str,
        "shape": to_str,
        "weight_measured": to_float,
    }
    value = ", ".join(f"'{n}', {convert(f'e.{n}')}" for n, convert in fields.items())
    checks = " AND ".join(f"NOT {misfit(f'e.{n}', f'p.{n}')}" for n in fields)
    one = let(
        f"named_struct({value})", "p", f"CASE WHEN e IS NOT NULL AND {checks} THEN p END"
    )
    return f"transform({as_record(v, fields, many=True)}, e -> {one})"


# The category codes a product may carry.
CATEGORY_CODES = ("ciqual_food_code", "agribalyse_food_code", "agribalyse_proxy_food_code")


def repaired_key(key: str) -> str:
    """Trim the characters ':', 'e', 'n' at both ends, then mend a cut-off '_code'."""
    trimmed = f"trim(BOTH ':en' FROM {key})"
    return f"CASE WHEN endswith({trimmed}, '_cod') THEN replace({trimmed}, '_cod', '_code') ELSE {trimmed} END"


def category_codes(text: str) -> str:
    """Category code struct; NULL when a repaired key or a value does not fit."""
    repaired = (
        f"transform({object_entries(text)}, "
        f"e -> named_struct('key', {repaired_key('e.key')}, 'value', e.value))"
    )

    def source(name: str) -> str:
        return f"try_element_at(filter(r, x -> x.key = '{name}'), -1).value"

    value = ", ".join(f"'{n}', {to_int(source(n))}" for n in CATEGORY_CODES)
    known = ", ".join(f"'{n}'" for n in CATEGORY_CODES)
    checks = " AND ".join(
        [f"forall(r, x -> x.key IN ({known}))"]
        + [f"NOT {misfit(source(n), f'c.{n}')}" for n in CATEGORY_CODES]
    )
    return let(repaired, "r", let(f"named_struct({value})", "c", f"CASE WHEN {checks} THEN c END"))
