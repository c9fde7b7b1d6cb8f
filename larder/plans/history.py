"""History export: change rows as gzipped JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from larder.operators.history import revision_events
from larder.sources.files import write_json_lines


def export_events(revisions: DataFrame, target: str) -> None:
    write_json_lines(revision_events(revisions), target)
