"""Small expressions for analysis queries, as SQL text."""

from __future__ import annotations


def main_text(column: str) -> str:
    """Text of the main-language entry of a language list."""
    return f"get(filter({column}, x -> x.lang = 'main'), 0).text"


def tag_language(tag: str) -> str:
    """Language part of ``lang:name``."""
    return f"split_part({tag}, ':', 1)"


def tag_name(tag: str) -> str:
    """Name part of ``lang:name``."""
    return f"split_part({tag}, ':', 2)"


def nth_ingredient(text: str, n: int) -> str:
    """The n-th (from 0) top-level ingredient of the JSON text, as VARIANT."""
    return f"try_variant_get(try_parse_json({text}), '$[{n}]', 'variant')"


def revision_id(code: str, revision: str) -> str:
    return f"concat_ws('_', {code}, {revision})"


# Fixed value: the API version revisions are filed under.
API_VERSION = "v2"


def revision_path(code: str, revision: str, api_version: str = API_VERSION) -> str:
    """``{api}/{barcode}/{revision}.json``; give ``'latest'`` for the newest."""
    return f"concat('{api_version}/', {code}, '/', {revision}, '.json')"


def barcode_folder(code: str) -> str:
    """``4012345678901`` -> ``401/234/567/8901``.

    Shorter codes are padded with zeros to 13 digits first.
    """
    padded = f"CASE WHEN length({code}) < 13 THEN lpad({code}, 13, '0') ELSE {code} END"
    return f"regexp_replace({padded}, r'^(.{{3}})(.{{3}})(.{{3}})(.+)$', '$1/$2/$3/$4')"


# The objects kept for one uploaded image.
IMAGE_SUFFIXES = (".jpg", ".400.jpg", ".json.gz")


def image_paths(code: str, image: str) -> str:
    """Object paths of one image, as an array."""
    paths = ", ".join(
        f"concat('data/', {barcode_folder(code)}, '/', {image}, '{suffix}')" for suffix in IMAGE_SUFFIXES
    )
    return f"array({paths})"
