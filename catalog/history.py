"""Revision history and change feed queries over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import Catalog, spread_table
from larder.functions.facets import barcode_folder, revision_path
from larder.functions.json_text import strip_user_ids as strip_user_ids_sql
from larder.operators import history
from larder.operators.rows import exploded
from larder.session import scratch_path
from larder.sources.files import read_lines, write_json_lines
from larder.streaming import feed

catalog = Catalog()

# One product holds a third of all revisions; the others have gaps in their numbers.
_CODE = "CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE concat('doc', CAST(floor(event_id / 30) AS {int})) END"
_REV = "CASE WHEN event_id % 3 = 0 THEN CAST(floor(event_id / 3) AS BIGINT) ELSE event_id % 30 END"

_DIFFS = """CASE event_type
    WHEN 'click' THEN '{"fields":{"change":["k"],"add":["n.cents"]}}'
    WHEN 'view' THEN '{"nutriments":{"change":["n.t-x"]},"fields":{"change":["n.t-x","k"]}}'
    WHEN 'purchase' THEN '{"fields":{"delete":["k"]},"junk":5}'
    WHEN 'error' THEN '{"fields":{"unknown":["k"],"change":[]}}' END"""


def _revisions(spark, sf):
    return spread_table(spark, sf, "events").selectExpr(
        _CODE.format(int="BIGINT") + " AS code",
        _REV + " AS rev_id",
        "unix_seconds(CAST(ts AS TIMESTAMP)) AS timestamp",
        "CAST('food' AS STRING) AS product_type",
        "event_type AS comment",
        _DIFFS + " AS diffs",
        "to_json(named_struct('k', CAST(get_json_object(props, '$.k') AS INT), 'n', "
        "named_struct('cents', CAST(round(value * 100) AS BIGINT), 't-x', event_type))) AS product",
    )


_REVISIONS_SQL = f"""
    WITH revisions AS (
        SELECT {_CODE.format(int="BIGINT")} AS code, {_REV} AS rev_id, event_type AS comment,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               CAST(round(value * 100) AS BIGINT) AS cents
        FROM events),
    paired AS (
        SELECT r.*, p.k AS p_k, p.cents AS p_cents, p.comment AS p_comment, p.code IS NOT NULL AS has_previous
        FROM revisions r LEFT JOIN revisions p ON p.code = r.code AND p.rev_id = r.rev_id - 1),
    changed AS (
        SELECT *, 'k' AS field, 'change' AS action FROM paired WHERE comment = 'click'
        UNION ALL SELECT *, 'n.cents', 'add' FROM paired WHERE comment = 'click'
        UNION ALL SELECT *, 'n.t-x', 'change' FROM paired WHERE comment = 'view'
        UNION ALL SELECT *, 'k', 'change' FROM paired WHERE comment = 'view'
        UNION ALL SELECT *, 'k', 'delete' FROM paired WHERE comment = 'purchase'),
    rows AS (
        SELECT code || '_' || rev_id AS id, field, action,
               CASE WHEN action <> 'add' THEN
                    CASE field WHEN 'k' THEN CAST(p_k AS VARCHAR) ELSE '"' || p_comment || '"' END END AS previous,
               CASE WHEN action <> 'delete' THEN
                    CASE field WHEN 'k' THEN CAST(k AS VARCHAR) WHEN 'n.cents' THEN CAST(cents AS VARCHAR)
                    ELSE '"' || comment || '"' END END AS current
        FROM changed)
"""


@catalog.query(_REVISIONS_SQL + "SELECT code, rev_id, p_k AS previous_k, has_previous FROM paired")
def revision_pairs(spark, sf):
    paired = history.revision_pairs(_revisions(spark, sf))
    return paired.select(
        "code", "rev_id",
        F.get_json_object("previous_product", "$.k").cast("int").alias("previous_k"),
        F.col("previous_product").isNotNull().alias("has_previous"),
    )


@catalog.query(_REVISIONS_SQL + "SELECT code, rev_id, field, action FROM changed")
def flatten_diffs(spark, sf):
    changes = exploded(_revisions(spark, sf), ["code", "rev_id"], history.flatten_diffs("diffs"), "change")
    return changes.select("code", "rev_id", "change.field", "change.action")


@catalog.query("""
    SELECT event_id, CASE event_type WHEN 'click' THEN json_extract_string(props, '$.k')
           WHEN 'view' THEN '"view"' END AS found FROM events
""")
def resolve_path(spark, sf):
    """A path per row: a member, a nested member, a list position, a missing one."""
    docs = spread_table(spark, sf, "events").selectExpr(
        "event_id",
        "parse_json(to_json(named_struct('k', CAST(get_json_object(props, '$.k') AS INT), "
        "'n', named_struct('a-b', event_type), 'l', array(1, 2)))) AS doc",
        "CASE event_type WHEN 'click' THEN 'k' WHEN 'view' THEN 'n.a-b' WHEN 'purchase' THEN 'l.0' "
        "WHEN 'signup' THEN 'k.z' ELSE 'none' END AS path",
    )
    return docs.select("event_id", F.expr(f"to_json({history.resolve_path('doc', 'path')})").alias("found"))


def _flat_events(spark, sf):
    events = history.revision_events(_revisions(spark, sf))
    return events.select(
        "id", "field", "action", F.to_json("previous").alias("previous"), F.to_json("current").alias("current")
    )


@catalog.query(_REVISIONS_SQL + "SELECT id, field, action, previous, current FROM rows")
def revision_events(spark, sf):
    return _flat_events(spark, sf)


@catalog.query(_REVISIONS_SQL + """
    SELECT id, field, action, coalesce(previous, 'null') AS previous, coalesce(current, 'null') AS current FROM rows
""")
def events_jsonl(spark, sf):
    """Change rows written as gzipped JSON lines and read back; nulls stay visible."""
    target = scratch_path(spark, "events")
    write_json_lines(history.revision_events(_revisions(spark, sf)), target)
    doc = read_lines(spark, target).select(F.expr("parse_json(line)").alias("d"))
    return doc.selectExpr(
        "variant_get(d, '$.id', 'string') AS id", "variant_get(d, '$.field', 'string') AS field",
        "variant_get(d, '$.action', 'string') AS action",
        "to_json(variant_get(d, '$.previous', 'variant')) AS previous",
        "to_json(variant_get(d, '$.current', 'variant')) AS current",
    )


# --- change feed ------------------------------------------------------------------


def _feed_events(spark, sf):
    return spread_table(spark, sf, "events").selectExpr(
        "CASE WHEN event_type <> 'error' THEN lpad(CAST(user_id AS STRING), 13, '0') ELSE '' END AS code",
        "CAST('off' AS STRING) AS flavor",
        "CASE event_type WHEN 'click' THEN 'updated' WHEN 'view' THEN 'updated' "
        "WHEN 'purchase' THEN 'deleted' ELSE 'created' END AS action",
        "CAST(ts AS TIMESTAMP) AS timestamp",
        "event_id AS position",
        "CASE event_type WHEN 'click' THEN concat('{\"uploaded_images\":{\"add\":[', get_json_object(props, '$.k'), ',7]}}') "
        "WHEN 'view' THEN concat('{\"uploaded_images\":{\"delete\":[\"', get_json_object(props, '$.k'), '\"]}}') END AS diffs",
        "concat('{\"rev\": ', event_id, ', \"creator\": \"u', user_id, '\", \"q\": 1.50, \"images\": {\"1\": "
        "{\"uploader\": \"u', user_id, '\", \"t\": \"9\"}}, \"note\": \"', event_type, '\"}') AS product",
    )


_FEED_SQL = """
    WITH feed AS (
        SELECT lpad(CAST(user_id AS VARCHAR), 13, '0') AS code, event_id, ts, event_type,
               CASE event_type WHEN 'click' THEN 'updated' WHEN 'view' THEN 'updated'
                    WHEN 'purchase' THEN 'deleted' ELSE 'created' END AS action,
               json_extract_string(props, '$.k') AS k,
               '{"rev":' || event_id || ',"q":1.5,"images":{"1":{"t":"9"}},"note":"' || event_type || '"}' AS body
        FROM events WHERE event_type <> 'error')
"""
_LATEST_SQL = _FEED_SQL + """
    SELECT code, event_id AS rev, 'v2/' || code || '/' || event_id || '.json' AS path, body FROM (
        SELECT * FROM feed WHERE action IN ('updated', 'deleted')
        QUALIFY row_number() OVER (PARTITION BY code ORDER BY event_id DESC) = 1)
    WHERE action = 'updated'
"""


@catalog.query(_FEED_SQL + """
    SELECT event_id AS position, code, action, action = 'updated' AS stores, action = 'deleted' AS removes,
           CASE WHEN event_type = 'click' THEN k END AS uploaded_image,
           CASE WHEN event_type = 'view' THEN k END AS deleted_image
    FROM feed
""")
def route_events(spark, sf):
    return feed.route_events(_feed_events(spark, sf)).select(
        "position", "code", "action", "stores", "removes", "uploaded_image", "deleted_image"
    )


@catalog.query(_FEED_SQL + "SELECT event_id AS position, body FROM feed")
def strip_user_ids(spark, sf):
    events = _feed_events(spark, sf).filter("code <> ''")
    return events.select("position", F.expr(strip_user_ids_sql("product")).alias("body"))


@catalog.query(_LATEST_SQL)
def latest_revision(spark, sf):
    changes = feed.capture_changes(feed.route_events(_feed_events(spark, sf)))
    return feed.newest_per_product(changes, feed.ORDER).select("code", "rev", "path", "body")


def _feed_lines(spark, sf):
    """The feed as text lines: plus a broken line, a broken document or an unknown flavor here and
    there, behind each good event of that number, and times out of stream order."""
    good = _feed_events(spark, sf).withColumn("timestamp", F.expr("timestamp - position * INTERVAL '7' MINUTE"))
    late = good.filter("code <> ''")
    broken = late.filter("position % 5 = 0").withColumn("action", F.lit("updated")).withColumn(
        "product", F.when(F.col("position") % 10 == 0, F.lit("{\"rev\": ")).otherwise(F.lit("{\"q\": 1}"))
    )
    unknown = late.filter("position % 7 = 0").withColumn("flavor", F.lit("other"))
    lines = good.unionByName(broken).unionByName(unknown).select(F.to_json(F.struct("*")).alias("value"))
    cut = late.filter("position % 11 = 0").selectExpr("concat('{\"code\": \"', code, '\", \"position\": ', position) AS value")
    return lines.unionByName(cut)


def _run_feed(spark, sf):
    root = scratch_path(spark, "feed")
    _feed_lines(spark, sf).repartition(6).write.text(f"{root}/in")
    writer = feed.FeedWriter(f"{root}/out", snapshot_every=2, buckets=8)
    stream = feed.events_from_files(spark, f"{root}/in", files_per_batch=1)
    writer.start(stream, f"{root}/checkpoint", once=True).awaitTermination()
    return writer


@catalog.query(_LATEST_SQL)
def latest_from_stream(spark, sf):
    """The same through the streaming job: files in, six micro-batches, snapshots out."""
    return _run_feed(spark, sf).latest(spark).select("code", "rev", "path", "body")


@catalog.query(_FEED_SQL + """
    SELECT event_id AS position, code, 'document' AS reason FROM feed WHERE event_id % 5 = 0
    UNION ALL SELECT event_id, code, 'flavor' FROM feed WHERE event_id % 7 = 0
    UNION ALL SELECT NULL, NULL, 'json' FROM feed WHERE event_id % 11 = 0
""")
def feed_refused(spark, sf):
    """What the streaming job could not apply, with the reason."""
    return _run_feed(spark, sf).refused(spark).select("position", "code", "reason")


@catalog.query(_FEED_SQL + """
    SELECT event_id AS position, 'v2/' || code || '/' || event_id || '.json' AS revision,
           'v2/' || code || '/latest.json' AS latest,
           substr(code, 1, 3) || '/' || substr(code, 4, 3) || '/' || substr(code, 7, 3) || '/' || substr(code, 10) AS folder
    FROM feed
""")
def object_paths(spark, sf):
    return _feed_events(spark, sf).filter("code <> ''").select(
        "position",
        F.expr(revision_path("code", "CAST(position AS STRING)")).alias("revision"),
        F.expr(revision_path("code", "'latest'")).alias("latest"),
        F.expr(barcode_folder("code")).alias("folder"),
    )


@catalog.query(_FEED_SQL + """
    SELECT event_id AS position, CASE event_type WHEN 'click' THEN 'put' ELSE 'remove' END AS op, k AS image_id,
           'data/' || substr(code, 1, 3) || '/' || substr(code, 4, 3) || '/' || substr(code, 7, 3) || '/'
           || substr(code, 10) || '/' || k || suffix AS path
    FROM feed, (SELECT unnest(['.jpg', '.400.jpg', '.json.gz']) AS suffix)
    WHERE event_type = 'view' OR (event_type = 'click' AND NOT (suffix = '.json.gz' AND CAST(k AS INTEGER) < 50))
""")
def image_manifest(spark, sf):
    """Uploads are listed for the assets that exist; text results of images below 50 do not."""
    routed = feed.route_events(_feed_events(spark, sf))
    every = feed.image_manifest(routed)
    assets = every.selectExpr(
        "path", "CASE WHEN path LIKE '%.json.gz' AND CAST(image_id AS INT) < 50 THEN 404 ELSE 200 END AS status"
    )
    return feed.image_manifest(routed, assets).select("position", "op", "image_id", "path")
