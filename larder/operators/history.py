"""Revisions to field-level change rows.

Revisions: code, rev_id, timestamp, product_type, comment, diffs (JSON text),
product (JSON text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.functions.facets import revision_id
from larder.functions.variants import JSON_OPTIONS, let, pinned

# Revisions of one product are paired in blocks of this many, so a product with
# very many revisions is spread over tasks.
BLOCK = 1024
# The operations a diff may name.
ACTIONS = ("add", "change", "delete")


def revision_pairs(revisions: DataFrame, carry: str = "product", block: int = BLOCK) -> DataFrame:
    """Add ``previous_<carry>``: the value at ``rev_id - 1`` of the same code, else NULL.

    A revision given several times counts once, as last written (greatest
    timestamp, then text).  One
    shuffle on (code, block).  The last revision of a block is copied into the
    next block, where it only serves as predecessor.
    """
    mine = F.expr(f"rev_id DIV {block}")
    last_of_block = F.expr(f"pmod(rev_id, {block}) = {block - 1}")
    own = F.struct(mine.alias("block"), F.lit(True).alias("own"))
    guest = F.struct((mine + 1).alias("block"), F.lit(False).alias("own"))
    placed = revisions.withColumn(
        "_place", F.explode(F.when(last_of_block, F.array(own, guest)).otherwise(F.array(own)))
    ).select("*", F.col("_place.block").alias("_block"), F.col("_place.own").alias("_own")).drop("_place")
    block_rows = Window.partitionBy("code", "_block")
    latest = [F.desc(c) for c in ("timestamp", carry) if c in revisions.columns]
    # Copies of a revision follow each other; the first of them is kept.
    before = F.lag("rev_id").over(block_rows.orderBy("rev_id", *latest))
    once = placed.withColumn("_first", before.isNull() | (before != F.col("rev_id"))).filter("_first").drop("_first")
    paired = once.withColumn(f"previous_{carry}", F.max(F.col(carry)).over(block_rows.orderBy("rev_id").rangeBetween(-1, -1)))
    return paired.filter("_own").drop("_block", "_own")


def flatten_diffs(diffs: str) -> str:
    """Ordered distinct (field, action) structs of a diff text; never NULL.

    Parsed level by level, so a category or a field list of another shape is
    skipped without touching its neighbours.
    """
    as_map = "map<string,string>"
    categories = f"map_values(from_json({diffs}, '{as_map}', {JSON_OPTIONS}))"
    known = ", ".join(f"'{a}'" for a in ACTIONS)
    per_action = (
        f"transform(filter(map_entries(from_json(c, '{as_map}', {JSON_OPTIONS})), a -> a.key IN ({known})), "
        f"a -> transform(coalesce(from_json(a.value, 'array<string>', {JSON_OPTIONS}), array()), "
        f"f -> named_struct('field', f, 'action', a.key)))"
    )
    changes = f"flatten(transform({categories}, c -> coalesce(flatten({per_action}), array())))"
    return f"array_distinct(coalesce({changes}, array()))"


def resolve_path(document: str, path: str) -> str:
    """Value at a dotted path of a VARIANT document, as VARIANT.

    Only object members are walked, never list positions.  Member names with
    quotes take a slower route over the parts.
    """
    quick = (
        f"try_variant_get({document}, concat('$[\\'', replace({path}, '.', '\\'][\\''), '\\']'), 'variant')"
    )
    walked = (
        f"aggregate(split({path}, '\\\\.'), {document}, "
        f"(v, part) -> element_at(try_variant_get(v, '$', 'map<string,variant>'), part))"
    )
    odd = f"({path} = '' OR contains({path}, '\\'') OR contains(concat('.', {path}, '.'), '..'))"
    value = f"CASE WHEN {odd} THEN {walked} ELSE {quick} END"
    return let(value, "found", "CASE WHEN NOT is_variant_null(found) THEN found END")


def revision_events(revisions: DataFrame) -> DataFrame:
    """One row per changed field of each revision, with the value before and after."""
    meta = ["code", "rev_id", "timestamp", "product_type", "comment"]
    # Only revisions that change something are worth parsing.
    busy = (
        revision_pairs(revisions)
        .select(*meta, "previous_product", "product", pinned(flatten_diffs("diffs")).alias("changes"))
        .filter(F.size("changes") > 0)
    )
    changed = busy.select(
        *meta,
        F.expr("try_parse_json(previous_product)").alias("before"),
        F.expr("try_parse_json(product)").alias("after"),
        F.explode("changes").alias("change"),
    )
    return changed.select(
        F.expr(revision_id("code", "rev_id")).alias("id"),
        "code", "rev_id", "timestamp", "product_type", "comment",
        F.col("change.field").alias("field"),
        F.expr(f"CASE WHEN change.action <> 'add' THEN {resolve_path('before', 'change.field')} END").alias("previous"),
        F.expr(f"CASE WHEN change.action <> 'delete' THEN {resolve_path('after', 'change.field')} END").alias("current"),
        F.col("change.action").alias("action"),
    )
