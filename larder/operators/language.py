"""Language-suffix pivot: ``f``, ``f_fr``, ``f_de`` become a list of (lang, text)."""

from __future__ import annotations

from larder.functions.variants import falsy, nothing, to_str


def language_members(members: str, fields: tuple[str, ...]) -> str:
    """Entries of ``members`` whose key is a field plus a two-character suffix.

    Any text may stand between field and suffix: the language is what follows
    the last underscore.
    """
    pattern = f"^({'|'.join(fields)})_(.*_)?[^_]{{2}}$"
    return f"filter(map_entries({members}), e -> e.key RLIKE r'{pattern}')"


def language_list(main: str, entries: str, field: str) -> str:
    """Main text first, then the suffixed texts in document order.

    A suffixed value that is not text leaves a NULL ``text``, which
    ``language_misfit`` reports.
    """
    empty = f"({nothing('e.value')} OR to_json(e.value) IN ('\"\"', '[]', '{{}}'))"
    suffixed = (
        f"transform(filter({entries}, e -> startswith(e.key, '{field}_') AND NOT {empty}), "
        f"e -> named_struct('lang', substring_index(e.key, '_', -1), 'text', {to_str('e.value')}))"
    )
    first = (
        f"CASE WHEN {falsy(main)} THEN CAST(array() AS ARRAY<STRUCT<lang STRING, text STRING>>) "
        f"ELSE array(named_struct('lang', 'main', 'text', {to_str(main)})) END"
    )
    return f"concat({first}, {suffixed})"


def language_misfit(column: str) -> str:
    return f"exists({column}, x -> x.text IS NULL)"
