"""Change feed: product update events to stored revisions, a latest view and image manifests.

Events: code, flavor, action, timestamp, position (place in the stream), diffs
(JSON text) and product (JSON text, the document after the update).

Everything up to the writer is stateless, so it runs the same on a stream and on
a table.  Changes are ordered by their place in the stream alone (by time only
where none is given), so the cut into micro-batches decides nothing.  The writer
stores what a micro-batch brings in one write, of three kinds:

- ``change``: captured updates and deletions;
- ``refused``: events that cannot be applied, with the reason;
- ``asset``: image objects to store or remove.

The newest change per product is kept in a merged store (``streaming/store.py``).
A replayed micro-batch replaces its own folder, so nothing is stored twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larder.functions.facets import image_paths, revision_path
from larder.functions.json_text import strip_user_ids
from larder.operators.joins import last_wins_rows
from larder.operators.rows import exploded
from larder.streaming.store import SMALL_BYTES, MergedStore

EVENT_SCHEMA = (
    "code STRING, flavor STRING, action STRING, timestamp TIMESTAMP, position BIGINT, "
    "diffs STRING, product STRING"
)
CHANGE_SCHEMA = (
    "code STRING, flavor STRING, action STRING, timestamp TIMESTAMP, position BIGINT, "
    "rev BIGINT, path STRING, body STRING"
)


# The kinds of product an event may come from.
FLAVORS = ("off", "obf", "opff", "opf", "off_pro")
LOG_SCHEMA = CHANGE_SCHEMA + ", reason STRING, line STRING, op STRING, image_id STRING"
REFUSED = ["position", "code", "reason", "line"]
ASSET = ["code", "timestamp", "position", "op", "image_id", "path"]
# Later in the stream wins; at one place the revision decides, then the text.
ORDER = ["position", "timestamp", "rev", "body"]


# The revision number of a document that is an object.
_REV = "try_variant_get(try_parse_json(product), '$.rev', 'bigint')"


def _rev(events: DataFrame) -> str:
    """SQL of the revision number, which a stored batch already holds."""
    return "_rev" if "_rev" in events.columns else _REV


def parse_events(lines: DataFrame, *carried: str) -> DataFrame:
    """Events from the text column ``line``; a line that is no JSON object of that shape keeps only ``line``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = lines.withColumn("e", F.from_json("line", EVENT_SCHEMA + ", _bad STRING", options))
    event = [F.when(F.col("e._bad").isNull(), F.col(f"e.{part.split()[0]}")).alias(part.split()[0]) for part in EVENT_SCHEMA.split(", ")]
    return parsed.select(*carried, *event, "line", (F.col("e").isNull() | F.col("e._bad").isNotNull()).alias("malformed"))


def events_from_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of events from JSON-lines files dropped into a folder."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return parse_events(reader.text(path).withColumnRenamed("value", "line"))


def events_from_messages(messages: DataFrame) -> DataFrame:
    """Events from broker messages (``value`` bytes and ``offset``)."""
    events = parse_events(messages.select(F.col("value").cast("string").alias("line"), "offset"), "offset")
    return events.withColumn("position", F.coalesce("position", "offset")).drop("offset")


def refused_events(events: DataFrame, flavors: tuple[str, ...] | None = FLAVORS) -> DataFrame:
    """Events that cannot be applied: position, code, reason, line.

    ``json``: the line is no event; ``flavor``: an unknown one; ``document``: an
    update whose document is no JSON object with a whole ``rev``.  Events without
    a code are skipped, not refused, and so are updates without any document.
    """
    line = F.col("line") if "line" in events.columns else F.lit(None).cast("string")
    malformed = F.col("malformed") if "malformed" in events.columns else F.lit(False)
    reason = F.when(malformed, F.lit("json"))
    named = F.length("code") > 0
    if flavors is not None:
        reason = reason.when(named & ~F.coalesce(F.col("flavor").isin(*flavors), F.lit(False)), F.lit("flavor"))
    broken = (F.col("action") == "updated") & F.col("product").isNotNull() & F.expr(f"{_rev(events)} IS NULL")
    reason = reason.when(named & broken, F.lit("document"))
    return events.select("position", "code", reason.alias("reason"), line.alias("line")).filter("reason IS NOT NULL")


def route_events(events: DataFrame) -> DataFrame:
    """What each event asks for.

    Adds ``stores`` (a revision), ``removes`` (the latest view of the product)
    and at most one of ``uploaded_image`` and ``deleted_image``.  Events without
    a code are dropped; other actions ask for nothing.
    """
    updated = F.col("action") == "updated"
    uploads = F.expr("try_variant_get(try_parse_json(diffs), '$.uploaded_images.add', 'variant')")
    deletes = F.expr("try_variant_get(try_parse_json(diffs), '$.uploaded_images.delete', 'variant')")
    first = "try_variant_get({}, '$[0]', 'string')"
    return (
        events.filter(F.length("code") > 0)
        .withColumn("stores", F.coalesce(updated, F.lit(False)))
        .withColumn("removes", F.coalesce(F.col("action") == "deleted", F.lit(False)))
        .withColumn("_up", uploads)
        .withColumn("_down", deletes)
        .withColumn("uploaded_image", F.when(updated, F.expr(first.format("_up"))))
        .withColumn(
            "deleted_image", F.when(updated & F.col("_up").isNull(), F.expr(first.format("_down")))
        )
        .drop("_up", "_down")
    )


def capture_changes(routed: DataFrame) -> DataFrame:
    """Revisions to store (user names stripped) and deletions, one row each.

    An update without a document, or with one that is no object with a ``rev``,
    changes nothing.
    """
    rev = F.expr(_rev(routed))
    wanted = routed.filter((F.col("stores") & rev.isNotNull()) | F.col("removes"))
    return wanted.select(
        "code", "flavor", "action", "timestamp", "position",
        F.when(F.col("stores"), rev).alias("rev"),
        F.when(F.col("stores"), F.expr(strip_user_ids("product"))).alias("body"),
    ).withColumn("path", F.expr(revision_path("code", "CAST(rev AS STRING)"))).select(
        *[part.split()[0] for part in CHANGE_SCHEMA.split(", ")]
    )


def image_manifest(routed: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """Objects to put or remove: three per uploaded or deleted image.

    ``assets`` (path, status) says which uploads exist; without it all are listed.
    """
    paths = (
        f"coalesce(CASE WHEN uploaded_image IS NOT NULL THEN {image_paths('code', 'uploaded_image')} END, "
        f"CASE WHEN deleted_image IS NOT NULL THEN {image_paths('code', 'deleted_image')} END)"
    )
    keep = [
        "code", "timestamp", "position",
        F.when(F.col("uploaded_image").isNotNull(), "put").otherwise("remove").alias("op"),
        F.coalesce("uploaded_image", "deleted_image").alias("image_id"),
    ]
    asked = routed.filter(F.col("uploaded_image").isNotNull() | F.col("deleted_image").isNotNull())
    listed = exploded(asked, keep, paths, "path")
    if assets is None:
        return listed
    there = assets.filter(F.col("status") == 200).select(F.col("path").alias("_path")).distinct()
    return (
        listed.join(there, F.col("path") == F.col("_path"), "left")
        .filter((F.col("op") == "remove") | F.col("_path").isNotNull())
        .drop("_path")
    )


def newest_per_product(changes: DataFrame, order: list[str], deletions: bool = False) -> DataFrame:
    """The last change of each code by ``order``; left out if it is a deletion, unless asked for."""
    won = last_wins_rows(changes, "code", order)
    return won if deletions else won.filter(F.col("action") != "deleted")


class FeedWriter:
    """``foreachBatch`` writer and reader of the stored feed."""

    def __init__(
        self, root: str, snapshot_every: int = 50, assets: DataFrame | None = None, flavors: tuple[str, ...] | None = FLAVORS,
        buckets: int = 64, keep: int = 2, small_bytes: int = SMALL_BYTES,
    ):
        self.snapshot_every = snapshot_every
        self.assets = assets
        self.flavors = flavors
        # With deletions, so that an earlier change that arrives late stays deleted.
        self.store = MergedStore(
            root, LOG_SCHEMA, CHANGE_SCHEMA, "code", "change", lambda rows: newest_per_product(rows, ORDER, deletions=True), buckets, keep, small_bytes
        )

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        # Kept with the revision number, so that each document is parsed for it once.
        batch = batch.withColumn("_rev", F.expr(f"CASE WHEN action = 'updated' THEN {_REV} END")).persist()
        try:
            known = batch if self.flavors is None else batch.filter(F.col("flavor").isin(*self.flavors))
            routed = route_events(known)
            kinds = {
                "change": capture_changes(routed), "refused": refused_events(batch, self.flavors), "asset": image_manifest(routed, self.assets),
            }
            parts = [part.withColumn("kind", F.lit(kind)) for kind, part in kinds.items()]
            self.store.append(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), batch_id)
        finally:
            batch.unpersist()
        if (batch_id + 1) % self.snapshot_every == 0:
            self.snapshot(batch.sparkSession, batch_id)

    def start(self, events: DataFrame, checkpoint: str, once: bool = False) -> StreamingQuery:
        writer = events.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint)
        if once:
            writer = writer.trigger(availableNow=True)
        return writer.start()

    def snapshot(self, spark: SparkSession, batch_id: int) -> None:
        """Fold the changes up to ``batch_id`` into the latest view."""
        self.store.snapshot(spark, batch_id)

    def revisions(self, spark: SparkSession) -> DataFrame:
        """Stored revisions, each once: of several under one code and number the last counts."""
        stored = self.store.log(spark, "change").select(*self.store.columns).filter(F.col("action") == "updated")
        return last_wins_rows(stored, ["code", "rev"], ORDER)

    def refused(self, spark: SparkSession) -> DataFrame:
        return self.store.log(spark, "refused").select(*REFUSED)

    def manifest(self, spark: SparkSession) -> DataFrame:
        return self.store.log(spark, "asset").select(*ASSET)

    def latest(self, spark: SparkSession, codes: list[str] | None = None) -> DataFrame:
        """Newest revision per product; of ``codes`` only, without opening other buckets, if given."""
        return self.store.view(spark, codes).filter(F.col("action") != "deleted")
