"""Image maps to arrays, for both document layouts, with size pruning."""

from __future__ import annotations

from larder.functions.variants import (
    JSON_OPTIONS,
    as_object,
    as_record,
    falsy,
    falsy_text,
    let,
    member,
    misfit,
    object_entries,
    to_bigint,
    to_int,
    to_str,
)

# The sizes that are kept.
SIZES = ("100", "200", "400", "full")


def image_entries(text: str) -> str:
    """(key, value) per image, in document order.

    The grouped layout {"uploaded": {id: ..}, "selected": {type: {lang: ..}}}
    gives the keys ``id`` and ``type_lang``; the flat layout keeps its own.
    """
    grouped = (
        f"from_json({text}, 'uploaded map<string,variant>, "
        f"selected map<string,map<string,variant>>', {JSON_OPTIONS})"
    )
    uploaded = "coalesce(map_entries(g.uploaded), array())"
    selected = (
        "coalesce(flatten(transform(map_entries(g.selected), t -> "
        "transform(map_entries(t.value), l -> "
        "named_struct('key', concat(t.key, '_', l.key), 'value', l.value)))), array())"
    )
    regrouped = let(grouped, "g", f"concat({uploaded}, {selected})")
    flat = object_entries(text)
    return let(
        flat,
        "m",
        f"CASE WHEN exists(m, e -> e.key IN ('uploaded', 'selected')) THEN {regrouped} ELSE m END",
    )


def _named_sizes(sizes: str) -> str:
    """(key, size) per size that is not falsy; ``size`` is NULL when it is no object."""
    return (
        f"transform(filter(map_entries({as_object(sizes)}), s -> NOT {falsy('s.value')}), "
        f"s -> named_struct('key', s.key, 'size', {as_record('s.value', ('h', 'w'))}))"
    )


def _size_struct(named: str) -> str:
    fields = ", ".join(
        f"'{size}', get(transform(filter({named}, s -> s.key = '{size}'), s -> "
        f"named_struct('h', {to_int('s.size.h')}, 'w', {to_int('s.size.w')})), 0)"
        for size in SIZES
    )
    return f"CASE WHEN size({named}) > 0 THEN named_struct({fields}) END"


def image_sizes(image: str) -> str:
    """Struct of the kept sizes; NULL when the image names no size at all.

    Sizes under other names still count as sizes: they give a struct of NULLs.
    """
    return let(_named_sizes(member(image, "sizes")), "z", _size_struct("z"))


def _sizes_fit(sizes: str, named: str) -> str:
    """False when a named size, kept or not, is no (h, w) object."""
    one = (
        f"s.size IS NOT NULL AND NOT {misfit('s.size.h', to_int('s.size.h'))} "
        f"AND NOT {misfit('s.size.w', to_int('s.size.w'))}"
    )
    return f"({falsy(sizes)} OR coalesce(forall({named}, s -> {one}), false))"


IMAGE_MEMBERS = ("key", "sizes", "imgid", "rev", "uploaded_t", "uploader")


def images_array(text: str, entries: str | None = None) -> str:
    """Array of image structs; an element is NULL when the image does not fit.

    ``text`` is the raw JSON text of the map.  Absent and empty maps give an
    empty array; text that is no object gives NULL.
    """
    value = (
        f"named_struct('key', coalesce({to_str('r.key')}, e.key), "
        f"'imgid', {to_int('r.imgid')}, 'rev', {to_int('r.rev')}, "
        f"'sizes', {_size_struct('z')}, "
        f"'uploaded_t', {to_bigint('r.uploaded_t')}, 'uploader', {to_str('r.uploader')})"
    )
    checks = " AND ".join(
        ["r IS NOT NULL", _sizes_fit("r.sizes", "z"), f"NOT {misfit('r.key', to_str('r.key'))}"]
        + [f"NOT {misfit(f'r.{n}', f'i.{n}')}" for n in ("imgid", "rev", "uploaded_t", "uploader")]
    )
    checked = let(value, "i", f"CASE WHEN {checks} THEN i END")
    image = let(as_record("e.value", IMAGE_MEMBERS), "r", let(_named_sizes("r.sizes"), "z", checked))
    array = f"transform({entries or image_entries(text)}, e -> {image})"
    return f"CASE WHEN {falsy_text(text)} THEN array() ELSE {array} END"


def array_misfit(column: str) -> str:
    """True for NULL (no object) or an array with a NULL element."""
    return f"({column} IS NULL OR exists({column}, x -> x IS NULL))"
