"""Editing JSON object text without disturbing member order or number text."""

from __future__ import annotations

from larder.functions.variants import JSON_OPTIONS, let


def json_string(s: str) -> str:
    """JSON text of a string."""
    return let(f"to_json(array({s}))", "js", "substr(js, 2, length(js) - 2)")


def members(text: str) -> str:
    """(key, value as VARIANT, text) per member, in document order."""
    typed = f"map_entries(from_json({text}, 'map<string,variant>', {JSON_OPTIONS}))"
    raw = f"map_values(from_json({text}, 'map<string,string>', {JSON_OPTIONS}))"
    return f"zip_with({typed}, {raw}, (a, b) -> named_struct('key', a.key, 'value', a.value, 'text', b))"


def member_text(m: str) -> str:
    """JSON text of one member's value."""
    return (
        f"CASE WHEN {m}.text IS NULL THEN 'null' "
        f"WHEN schema_of_variant({m}.value) = 'STRING' THEN to_json({m}.value) ELSE {m}.text END"
    )


def rebuilt(text: str, var: str, value: str, keep: str = "true") -> str:
    """Object text with each member's value replaced by ``value``.

    ``value`` and ``keep`` are SQL text over the member ``var``; members whose
    ``keep`` is false are dropped.  Text that is no object gives NULL.
    """
    one = f"concat({json_string(f'{var}.key')}, ':', {value})"
    kept = f"filter({members(text)}, {var} -> {keep})"
    return f"concat('{{', array_join(transform({kept}, {var} -> {one}), ','), '}}')"


# Members that hold user names.
USER_MEMBERS = (
    "checkers_tags",
    "correctors_tags",
    "creator",
    "editors_tags",
    "informers_tags",
    "last_checker",
    "last_editor",
    "last_modified_by",
    "photographers_tags",
)


def strip_user_ids(text: str, extra: tuple[str, ...] = ()) -> str:
    """Product text without user names, including the uploaders of its images.

    ``editors`` and ``photographers`` stay unless named in ``extra``.
    """

    def without_uploader(images: str, var: str) -> str:
        stripped = rebuilt(f"{var}.text", "u", member_text("u"), "u.key <> 'uploader'")
        return rebuilt(images, var, f"coalesce(CASE WHEN {var}.text LIKE '{{%' THEN {stripped} END, {member_text(var)})")

    grouped = rebuilt(
        "p.text", "g",
        f"CASE WHEN g.key = 'uploaded' THEN coalesce({without_uploader('g.text', 'f')}, {member_text('g')}) ELSE {member_text('g')} END",
    )
    is_grouped = f"coalesce(exists({members('p.text')}, x -> x.key = 'uploaded'), false)"
    images = f"CASE WHEN {is_grouped} THEN {grouped} ELSE {without_uploader('p.text', 'f')} END"
    names = ", ".join(f"'{n}'" for n in USER_MEMBERS + tuple(extra))
    return rebuilt(
        text, "p",
        f"CASE WHEN p.key = 'images' THEN coalesce({images}, {member_text('p')}) ELSE {member_text('p')} END",
        f"p.key NOT IN ({names})",
    )
