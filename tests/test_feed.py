"""The change feed, as a batch and as a stream."""

import json
import random

import pytest
from pyspark.sql import functions as F

from larder.functions.facets import barcode_folder
from larder.functions.json_text import USER_MEMBERS, strip_user_ids
from larder.streaming import feed

CODE = "4012345678901"


def event(position, action="updated", code=CODE, diffs=None, product=None, flavor="off"):
    return {
        "code": code, "flavor": flavor, "action": action, "timestamp": f"2024-01-01T00:00:{position:02d}Z", "position": position,
        "diffs": json.dumps(diffs) if diffs is not None else None,
        "product": json.dumps(product) if product is not None else None,
    }


def frame(spark, *events):
    lines = spark.createDataFrame([(json.dumps(e),) for e in events], "line string")
    return lines.select(F.from_json("line", feed.EVENT_SCHEMA).alias("e")).select("e.*")


def test_routing(spark):
    rows = feed.route_events(
        frame(
            spark, event(1, code=""), event(2, code=None), event(3), event(4, "deleted"), event(5, "archived"),
            event(6, diffs={"uploaded_images": {"add": ["4", "5"], "delete": ["1"]}}), event(7, diffs={"uploaded_images": {"delete": [9]}}),
            event(8, "deleted", diffs={"uploaded_images": {"add": ["4"]}}), event(9, diffs={"fields": {"add": ["x"]}}),
        )
    ).collect()
    got = {r.position: (r.stores, r.removes, r.uploaded_image, r.deleted_image) for r in rows}
    assert got == {
        3: (True, False, None, None), 4: (False, True, None, None), 5: (False, False, None, None), 6: (True, False, "4", None),
        7: (True, False, None, "9"), 8: (False, True, None, None), 9: (True, False, None, None),
    }


def strip(spark, product, *extra):
    df = spark.createDataFrame([(json.dumps(product),)], "p string")
    return df.select(F.expr(strip_user_ids("p", tuple(extra))).alias("x")).head().x


def test_strip_every_user_member(spark):
    """Removed members stand first, last and between kept ones; what is kept keeps its place and text."""
    product = {}
    for n, name in enumerate(USER_MEMBERS):
        product[name] = [f"person {n}", {"nested": n}] if n % 2 else n * 1000
        product[f"kept_{n}"] = [n, None, {"creator": "stays when nested"}]
    text = strip(spark, product)
    assert text == json.dumps({k: v for k, v in product.items() if k.startswith("kept_")}, separators=(",", ":"))


def test_strip_uploaders_of_both_layouts(spark):
    flat = {str(n): {"uploader": f"p{n}", "w": n * 100, "tags": ["uploader"]} for n in (3, 8, 21)}
    flat["ingredients_pt"] = {"imgid": "8", "uploader": None, "crop": {"uploader": "deeper stays"}}
    grouped = {
        "uploaded": {"3": {"w": 300, "uploader": "p3"}, "8": {"uploader": "p8"}},
        "selected": {"packaging": {"pt": {"imgid": "8"}, "ja": {"imgid": "3"}}, "front": {"sv": {"rev": "2"}}},
    }
    assert json.loads(strip(spark, {"images": flat})) == {
        "images": {
            "3": {"w": 300, "tags": ["uploader"]}, "8": {"w": 800, "tags": ["uploader"]}, "21": {"w": 2100, "tags": ["uploader"]},
            "ingredients_pt": {"imgid": "8", "crop": {"uploader": "deeper stays"}},
        }
    }
    assert json.loads(strip(spark, {"images": grouped})) == {
        "images": {"uploaded": {"3": {"w": 300}, "8": {}}, "selected": grouped["selected"]}
    }
    assert strip(spark, {"images": {}}) == '{"images":{}}'


def test_strip_more_names(spark):
    assert json.loads(strip(spark, {"editors": ["u"], "a": 1}, "editors")) == {"a": 1}


def test_capture(spark):
    routed = feed.route_events(frame(spark, event(1, product={"rev": 12, "creator": "u", "name": "x"}), event(2), event(3, "deleted")))
    rows = {r.position: r for r in feed.capture_changes(routed).collect()}
    assert set(rows) == {1, 3}
    assert (rows[1].rev, rows[1].path, rows[1].body) == (12, f"v2/{CODE}/12.json", '{"rev":12,"name":"x"}')
    assert rows[3].body is None


def test_image_manifest(spark):
    routed = feed.route_events(
        frame(spark, event(1, diffs={"uploaded_images": {"add": ["4"]}}), event(2, diffs={"uploaded_images": {"delete": ["3"]}}), event(3))
    )
    folder = "data/401/234/567/8901"
    put = {("put", f"{folder}/4{s}") for s in (".jpg", ".400.jpg", ".json.gz")}
    remove = {("remove", f"{folder}/3{s}") for s in (".jpg", ".400.jpg", ".json.gz")}
    assert {(r.op, r.path) for r in feed.image_manifest(routed).collect()} == put | remove
    assets = spark.createDataFrame([(f"{folder}/4.jpg", 200), (f"{folder}/4.400.jpg", 404)], "path string, status int")
    assert {(r.op, r.path) for r in feed.image_manifest(routed, assets).collect()} == {("put", f"{folder}/4.jpg")} | remove


def test_short_barcodes_are_padded(spark):
    df = spark.createDataFrame([("12345678",), (CODE,), ("12345678901234",)], "c string")
    assert [r.f for r in df.select(F.expr(barcode_folder("c")).alias("f")).collect()] == ["000/001/234/5678", "401/234/567/8901", "123/456/789/01234"]


def latest(writer, spark):
    return {(r.code, r.rev) for r in writer.latest(spark).collect()}


@pytest.mark.parametrize("snapshot_every", [1, 2, 100])
def test_stream(spark, tmp_path, snapshot_every):
    """Three micro-batches: update, delete then update, delete of another product."""
    folder = tmp_path / "in"
    folder.mkdir()
    writer = feed.FeedWriter(str(tmp_path / "out"), snapshot_every)
    batches = [
        [event(1, code="a", product={"rev": 5}), event(2, code="b", product={"rev": 1}), event(3, code="a", product={"rev": 6})],
        [event(4, "deleted", code="a"), event(5, code="a", product={"rev": 1}), event(6, code="c", product={"rev": 2})],
        [event(7, "deleted", code="b"), event(8, code="c"), event(9, code="", product={"rev": 9})],
    ]
    expected = [{("a", 6), ("b", 1)}, {("a", 1), ("b", 1), ("c", 2)}, {("a", 1), ("c", 2)}]
    for n, (batch, state) in enumerate(zip(batches, expected)):
        (folder / f"{n}.json").write_text("".join(json.dumps(e) + "\n" for e in batch))
        stream = feed.events_from_files(spark, str(folder))
        writer.start(stream, str(tmp_path / "checkpoint"), once=True).awaitTermination()
        assert latest(writer, spark) == state
    assert {(r.code, r.rev) for r in writer.revisions(spark).collect()} == {("a", 5), ("a", 6), ("b", 1), ("a", 1), ("c", 2)}
    # A batch that is replayed after a failure changes nothing.
    writer.apply(frame(spark, *batches[2]), 2)
    assert latest(writer, spark) == expected[2]
    assert writer.revisions(spark).count() == 5


BROKEN = [
    '{"code": "a", "position": 90',
    "[1]",
    json.dumps(event(51, code="a", flavor="nope", product={"rev": 70})),
    json.dumps(event(52, code="a", product={"q": 1})),
    json.dumps({**event(53, code="a"), "product": '{"rev": '}),
]


def test_refused_events(spark, tmp_path):
    """What cannot be applied is stored with its reason and changes nothing."""
    (tmp_path / "in").mkdir()
    lines = [json.dumps(event(1, code="a", product={"rev": 4})), *BROKEN, json.dumps(event(54, code="")), json.dumps(event(55, code="a"))]
    (tmp_path / "in" / "0.json").write_text("\n".join(lines) + "\n")
    writer = feed.FeedWriter(str(tmp_path / "out"))
    writer.start(feed.events_from_files(spark, str(tmp_path / "in")), str(tmp_path / "checkpoint"), once=True).awaitTermination()
    refused = sorted((r.position or 0, r.reason, r.line) for r in writer.refused(spark).collect())
    assert [r[:2] for r in refused] == [(0, "json"), (0, "json"), (51, "flavor"), (52, "document"), (53, "document")]
    assert [r[2] for r in refused if r[1] == "json"] == sorted(BROKEN[:2])
    assert latest(writer, spark) == {("a", 4)}


@pytest.mark.parametrize("per_batch", [1, 2, 5])
def test_cut_into_batches_decides_nothing(spark, tmp_path, per_batch):
    """Late arrivals, repeated revisions and deletions, with times against the stream's order."""
    events = [
        event(1, code="a", product={"rev": 1}), event(5, code="a", product={"rev": 2}), event(3, "deleted", code="a"),
        event(9, "deleted", code="b"), event(4, code="b", product={"rev": 7}), event(2, code="c", product={"rev": 1, "v": "old"}),
        event(8, code="c", product={"rev": 1, "v": "new"}), event(6, code="c", product={"rev": 3}), event(7, code="d", product={"rev": 5}),
        event(7, code="d", product={"rev": 5}),
    ]
    (tmp_path / "in").mkdir()
    for n, e in enumerate(events):
        e["timestamp"] = f"2024-01-01T00:{59 - e['position']:02d}:00Z"
        (tmp_path / "in" / f"{n}.json").write_text(json.dumps(e) + "\n")
    writer = feed.FeedWriter(str(tmp_path / "out"), snapshot_every=2)
    stream = feed.events_from_files(spark, str(tmp_path / "in"), files_per_batch=per_batch)
    writer.start(stream, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    assert sorted((r.code, r.rev) for r in writer.latest(spark).collect()) == [("a", 2), ("c", 1), ("d", 5)]
    revisions = {(r.code, r.rev): r.body for r in writer.revisions(spark).collect()}
    assert set(revisions) == {("a", 1), ("a", 2), ("b", 7), ("c", 1), ("c", 3), ("d", 5)}
    assert json.loads(revisions["c", 1])["v"] == "new"


def test_messages(spark):
    df = spark.createDataFrame([(bytearray(json.dumps(event(1)).encode()), 44)], "value binary, offset long")
    row = feed.events_from_messages(df).head()
    assert (row.code, row.position) == (CODE, 1)


def written(writer, spark):
    """Bytes of every live run."""
    return {name: sum(sizes.values()) for name, sizes in writer.store.version(spark).runs.items()}


def test_snapshot_writes_what_changed(spark, tmp_path):
    """A large view, then small batches: its run stays as it is, small runs are merged, and readers keep their version."""
    writer = feed.FeedWriter(str(tmp_path / "out"), snapshot_every=1, buckets=4, small_bytes=3000)
    rng = random.Random(1)
    many = [event(n % 60, code=f"p{n}", product={"rev": 1, "note": rng.randbytes(200).hex()}) for n in range(400)]
    writer.apply(frame(spark, *many), 0)
    (large,) = written(writer, spark)
    early = writer.latest(spark)
    sizes = []
    for n in range(1, 6):
        writer.apply(frame(spark, event(60 + n, code=f"p{n}", product={"rev": 1 + n}), event(59, "deleted", code=f"p{100 + n}")), n)
        runs = written(writer, spark)
        assert large in runs and len(runs) <= 3
        sizes.append(sum(runs.values()) - runs[large])
        if n == 1:  # planned before a snapshot, read after it
            assert early.count() == 400
    assert max(sizes) < runs[large] / 4
    rows = {r.code: r.rev for r in writer.latest(spark).collect()}
    assert len(rows) == 395 and all(rows[f"p{n}"] == 1 + n for n in range(1, 6)) and "p103" not in rows
    assert len(writer.store.version(spark).spans) <= 3 and len(list((tmp_path / "out" / "batches").iterdir())) <= 2
    assert writer.revisions(spark).count() == 405


def test_lookup_opens_few_buckets(spark, tmp_path):
    writer = feed.FeedWriter(str(tmp_path / "out"), snapshot_every=1, buckets=8)
    writer.apply(frame(spark, *[event(n, code=f"p{n}", product={"rev": n}) for n in range(1, 50)]), 0)
    writer.apply(frame(spark, event(55, code="p7", product={"rev": 70})), 1)
    found = writer.latest(spark, ["p7", "p9", "none"])
    assert {(r.code, r.rev) for r in found.collect()} == {("p7", 70), ("p9", 9)}
    assert len({f.split("bucket=")[1].split("/")[0] for f in found.inputFiles() if "bucket=" in f}) <= 3


def test_interrupted_snapshot(spark, tmp_path, monkeypatch):
    """Files of a snapshot that did not end count for nothing; the repeated batch makes it again."""
    writer = feed.FeedWriter(str(tmp_path / "out"), snapshot_every=1, buckets=2)
    writer.apply(frame(spark, event(1, code="a", product={"rev": 1})), 0)
    with monkeypatch.context() as patch:
        patch.setattr("larder.streaming.store.write_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            writer.apply(frame(spark, event(2, code="a", product={"rev": 2}), event(3, code="b", product={"rev": 1})), 1)
    assert latest(writer, spark) == {("a", 2), ("b", 1)}  # from the batch itself
    writer.apply(frame(spark, event(2, code="a", product={"rev": 2}), event(3, code="b", product={"rev": 1})), 1)
    assert latest(writer, spark) == {("a", 2), ("b", 1)}
    assert writer.store.version(spark).upto == 1 and writer.revisions(spark).count() == 3


def test_ties_in_the_stream_are_decided(spark, tmp_path):
    """At one place and time the higher revision wins, whatever the order of arrival."""
    events = [event(4, code="a", product={"rev": n, "v": n % 2}) for n in (3, 9, 1)]
    for n, order in enumerate((events, events[::-1])):
        writer = feed.FeedWriter(str(tmp_path / f"out{n}"), snapshot_every=1, buckets=1)
        for k, e in enumerate(order):
            writer.apply(frame(spark, e), k)
        assert latest(writer, spark) == {("a", 9)}


def test_stored_revision_numbers_are_not_parsed_again(spark):
    events = frame(spark, event(1, product={"rev": 5}), event(2, product={"q": 1}))
    plain = {(r.position, r.reason) for r in feed.refused_events(events).collect()}
    held = events.withColumn("_rev", F.when(F.col("position") == 1, F.lit(5).cast("bigint")))
    assert plain == {(r.position, r.reason) for r in feed.refused_events(held).collect()} == {(2, "document")}
    assert "parse_json" not in feed.refused_events(held)._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.position, r.rev) for r in feed.capture_changes(feed.route_events(held)).collect()] == [(1, 5)]
