"""Near-duplicates by SetSketch registers, joint likelihood, and verification on full sets.

A document is the set of its word shingles.  Its sketch has ``REGISTERS``
registers: the smallest of many exponential variables, truncated to a scale of
powers of ``BASE``.  Registers of a union are the smaller times, so sketches
merge; equal registers are likelier the more two sets share.  Bands of registers
propose pairs, the likelihood of all registers of a pair estimates its
similarity, and the pairs left are checked on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import map_columns, unused
from larder.llm.graph import connected_components
from larder.session import scratch_path

BANDS, ROWS = 40, 8
REGISTERS = BANDS * ROWS
BASE = 1.08  # registers hold 0..255: exponential minima from about 8e-9 to 3
SCALE_TOP = 15  # the register of a minimum of 1
# Pairs whose likeliest similarity lies this far under the threshold are not
# verified.  With 320 registers it is more than four standard deviations.
SLACK = 0.09
# The sketch of nodes whose links are still open, and five standard deviations of its estimate.
WIDE = 1280
WIDE_SLACK = 0.05
BLOCK_NODES = 1_000  # of a bucket compared with each other in one task

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_MULTIPLY = _rng.integers(0, 2**31, REGISTERS, np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 2**32, REGISTERS, np.uint32)
_WIDE_MULTIPLY = _rng.integers(0, 2**31, WIDE, np.uint32) * np.uint32(2) + np.uint32(1)
_WIDE_ADD = _rng.integers(0, 2**32, WIDE, np.uint32)
_POWER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_POWER, -1, 2**64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 2**64))
        out[done : 2 * done] = out[: min(done, n - done)] * step
        done *= 2
    return out


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text.

    Words are runs of anything but ASCII white space, A-Z made small.  A text of
    fewer than ``size`` words has its whole sequence as its one shingle, one
    without words has none.
    """
    raw = (text or "").encode().translate(_LOWER)
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_and(data != 32, (data < 9) | (data > 13), out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * _powers(_POWER, len(data)), out=sums[1:])
    words = _mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(data))[starts])
    n = min(size, len(words))
    out = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        out = _mix(out + words[k : len(words) - n + 1 + k] * np.uint64(2 * k + 3))
    return np.unique(out)


def sketch(hashes: np.ndarray, multiply: np.ndarray = _MULTIPLY, add: np.ndarray = _ADD) -> np.ndarray:
    """The registers of a set, one byte each."""
    least = np.full(len(multiply), 0xFFFFFFFF, np.uint32)
    small = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    for at in range(0, len(small), 256):  # blocks that stay in the processor's cache
        part = small[at : at + 256]
        x = part[None, :] * multiply[:, None] + add[:, None]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        np.minimum(least, x.min(axis=1), out=least)
    minima = -np.log1p(-(least.astype(np.float64) + 0.5) / 2**32)
    return np.clip(np.floor(SCALE_TOP - np.log(minima) / math.log(BASE)), 0, 255).astype(np.uint8)


def likeliest_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches (rows) with known set sizes.

    With shares u, v of the summed sizes, a register of the first set is larger
    with probability p(u - vJ), of the second with p(v - uJ), where
    p(x) = -log_b(1 - x (b - 1) / b).  The log-likelihood is concave in J.
    """
    first, second = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - first - second
    u = n_a / (n_a + n_b)
    v = 1 - u

    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def value(j):
        p1, p2 = p(u - v * j), p(v - u * j)
        return first * np.log(p1) + second * np.log(p2) + same * np.log(np.maximum(1 - p1 - p2, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    golden = (math.sqrt(5) - 1) / 2
    for _ in range(40):
        left, right = high - golden * (high - low), low + golden * (high - low)
        better = value(left) > value(right)
        low, high = np.where(better, low, left), np.where(better, right, high)
    return (low + high) / 2


def _sketched(docs: DataFrame, size: int, hashed: bool) -> DataFrame:
    def run(batch) -> dict:
        out: dict = {k: [] for k in ("doc_id", "n_shingles", "s1", "s2", "registers")}
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            hashes = shingle_hashes(text, size)
            out["doc_id"].append(doc_id)
            out["n_shingles"].append(len(hashes))
            with np.errstate(over="ignore"):
                # Sums over the set: equal sets, and in practice only they, agree in both.
                out["s1"].append(int(_mix(hashes).sum(dtype=np.uint64).astype(np.int64)))
                out["s2"].append(int(_mix(hashes + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
            out["registers"].append(sketch(hashes).tobytes() if len(hashes) else None)
        return {**out, "text_hash": batch.column(2)} if hashed else out

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *([F.xxhash64("text").alias("text_hash")] if hashed else []))
    return map_columns(texts, run, "doc_id long, n_shingles long, s1 long, s2 long, registers binary" + ", text_hash long" * hashed)


def _band_rows(least: float) -> int:
    """The most registers of a band to compare, so that a pair at the threshold is missed by all
    bands with a probability under 1e-5."""
    p = (1 - least) / 2
    equal = 1 + 2 * math.log1p(-p * (BASE - 1) / BASE) / math.log(BASE)
    return next((r for r in range(ROWS, 1, -1) if (1 - equal**r) ** BANDS < 1e-5), 1)


def _band_keys(nodes: DataFrame, least: float) -> DataFrame:
    rows = _band_rows(least)

    def run(batch) -> dict:
        registers = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64).reshape(-1, BANDS)
        registers = registers & np.uint64(2 ** (8 * rows) - 1)
        keys = _mix(registers ^ _mix(np.arange(1, BANDS + 1, dtype=np.uint64))[None, :])
        return {
            "key": keys.reshape(-1).view(np.int64), "band": np.tile(np.arange(BANDS, dtype=np.int32), len(keys)),
            "node": np.repeat(np.asarray(batch.column(0)), BANDS),
        }

    return map_columns(nodes.select("node", "registers"), run, "key long, band int, node long")


def _likely(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Pairs whose registers do not rule out the similarity."""
    own = nodes.select("node", "registers", "n_shingles")
    given = pairs.join(own.toDF("a", "ra", "na"), "a").join(own.toDF("b", "rb", "nb"), "b")

    def run(batch) -> dict:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS) for c in ("ra", "rb"))
        na, nb = (np.asarray(batch.column(c)).astype(np.float64) for c in ("na", "nb"))
        good = likeliest_similarity(a, b, na, nb) >= least - SLACK
        return {c: np.asarray(batch.column(c))[good] for c in ("a", "b")}

    # Sizes alone bound the similarity.
    sized = given.where(F.least("na", "nb") >= F.greatest("na", "nb") * (least - 1e-9))
    return map_columns(sized, run, "a long, b long").distinct()


def _verified(pairs: DataFrame, texts: DataFrame, size: int, threshold: tuple[int, int]) -> DataFrame:
    """Pairs that reach the threshold on their full sets."""
    given = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[str, np.ndarray] = {}
            good = []
            for pair in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist()):
                for text in pair:
                    if text not in sets:
                        sets[text] = shingle_hashes(text, size)
                x, y = sets[pair[0]], sets[pair[1]]
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(threshold[1] * both >= threshold[0] * (len(x) + len(y) - both))
            good = np.array(good, bool)
            yield pa.RecordBatch.from_arrays([pa.array(np.asarray(batch.column(c))[good]) for c in ("a", "b")], names=["a", "b"])

    return given.mapInArrow(run, "a long, b long")


def _close_between(rows: pa.Table, least: float, band_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of different parts, one from either block of a bucket, whose wide registers do not rule
    them out.  A pair is told by the first band in which it agrees, so only once."""
    node, part, n, block = (np.asarray(rows.column(c)) for c in ("node", "part", "n", "block"))
    band = rows.column("band")[0].as_py()
    bands = np.frombuffer(b"".join(rows.column("registers").to_pylist()), np.uint64).reshape(len(node), BANDS)
    bands = bands & np.uint64(2 ** (8 * band_rows) - 1)
    wide = np.frombuffer(b"".join(rows.column("wide").to_pylist()), np.uint8).reshape(len(node), WIDE)
    left, right = np.flatnonzero(block == rows.column("lo")[0].as_py()), np.flatnonzero(block == rows.column("hi")[0].as_py())
    out: tuple[list, list] = ([], [])
    for at in range(0, len(left), 256):
        some = left[at : at + 256]
        wanted = part[some][:, None] != part[right][None, :]
        small, large = (f(n[some][:, None], n[right][None, :]) for f in (np.minimum, np.maximum))
        wanted &= small >= large * (least - 1e-9)
        for k in range(band):
            wanted &= bands[some, k][:, None] != bands[right, k][None, :]
        i, j = np.nonzero(wanted)
        for k in range(0, len(i), 20_000):
            x, y = some[i[k : k + 20_000]], right[j[k : k + 20_000]]
            good = (wide[x] == wide[y]).mean(1) >= least - 2 * WIDE_SLACK
            x, y = x[good], y[good]
            good = likeliest_similarity(wide[x], wide[y], n[x].astype(float), n[y].astype(float)) >= least - WIDE_SLACK
            out[0].append(np.minimum(node[x], node[y])[good])
            out[1].append(np.maximum(node[x], node[y])[good])
    empty = [np.empty(0, np.int64)]
    return np.concatenate(out[0] or empty), np.concatenate(out[1] or empty)


def _open_pairs(mixed: DataFrame, nodes: DataFrame, texts: DataFrame, size: int, least: float, store) -> DataFrame:
    """Likely pairs ``a, b`` of different parts that share a bucket.

    Only the nodes of such buckets get a wider sketch.  Large buckets are dealt
    into blocks, each pair of blocks is one group of bounded size, and only
    pairs that are likely leave it: texts that are merely related stay inside.
    """
    band_rows = _band_rows(least)
    wanted = mixed.select("node").distinct()

    def widen(batch) -> dict:
        sets = [shingle_hashes(t, size) for t in batch.column(1).to_pylist()]
        return {"node": batch.column(0), "wide": [sketch(s, _WIDE_MULTIPLY, _WIDE_ADD).tobytes() for s in sets]}

    own = texts.toDF("node", "text").join(wanted, "node", "left_semi").dropDuplicates(["node"])
    known = nodes.select("node", F.col("n_shingles").alias("n"), "registers").join(map_columns(own, widen, "node long, wide binary"), "node")
    known = store(known.dropDuplicates(["node"]), "wide")
    blocks = mixed.groupBy("key").agg(F.ceil(F.count("*") / BLOCK_NODES).cast("int").alias("blocks"))
    dealt = (
        mixed.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", "band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "part")
    )

    def compare(rows: pa.Table) -> pa.Table:
        a, b = _close_between(rows, least, band_rows)
        return pa.table({"a": a, "b": b})

    return dealt.join(known, "node").groupBy("key", "lo", "hi").applyInArrow(compare, "a long, b long").where("a <> b").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``.

    Two documents are linked if ``threshold[1] * |A & B| >= threshold[0] * |A | B|``.
    Documents with equal sets become one node first.  In every bucket of a band
    the smallest node is tried with all others.  In buckets that still hold
    several components all pairs between these are then compared by wider
    sketches, in blocks, and the likely ones verified.

    Every row is placed by its own text, so repeated rows fall together; should
    different texts share an id that is the smallest of their classes, the
    classes count as linked.  Documents without words are linked with nothing;
    rows without an id have no component and are kept.
    """
    return _placed(docs, size, threshold)


def _placed(docs: DataFrame, size: int, threshold: tuple[int, int], hashed: bool = False) -> DataFrame:
    """The rows of ``near_duplicates``; if asked, with ``text_hash``."""
    spark = docs.sparkSession
    least = threshold[0] / threshold[1]

    def store(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"near-{name}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    rows = store(_sketched(docs, size, hashed), "sketches")
    filled = rows.where("n_shingles > 0 and doc_id is not null")
    classes = store(filled.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("node")), "classes")
    # A node's registers come from one row of its id; a repeated id may give several.
    nodes = store(
        filled.join(classes, ["s1", "s2", "n_shingles"]).where("doc_id = node").select("node", "n_shingles", "registers").distinct(), "nodes"
    )
    buckets = _band_keys(nodes, least)
    shared = buckets.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    members = store(buckets.join(shared, "key").select("key", "band", "pivot", "node"), "members")
    stars = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    # All later steps need only the texts of nodes that share a bucket; they move once.
    sharing = members.select(F.col("node").alias("doc_id")).distinct()
    texts = store(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sharing, "doc_id", "left_semi"), "texts")
    likely = store(_likely(stars, nodes, least), "likely")
    links = store(_verified(likely, _texts_of(likely, texts), size, threshold), "links")
    parts = connected_components(links)
    # Buckets with several components.
    labelled = members.join(parts.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").select(
        "key", "band", "node", F.coalesce("component", "node").alias("part")
    )
    several = labelled.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    mixed = store(labelled.join(several, "key").select("key", "band", "node", "part"), "mixed")
    more_likely = store(_open_pairs(mixed, nodes, texts, size, least, store), "likely")
    more = store(_verified(more_likely, _texts_of(more_likely, texts), size, threshold), "links")
    parts = connected_components(links.union(more))
    # Rows of one class share its node, and rows of one id its smallest component.
    placed = classes.join(parts.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").select(
        "s1", "s2", "n_shingles", F.coalesce("component", "node").alias("component")
    )
    joined = rows.join(placed, ["s1", "s2", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        *(["text_hash"] if hashed else []),
    )
    return joined.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, size: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """The rows of ``docs``, all columns, without all but the first document of every group.

    A repeated row (same id, same text) stays once; rows without an id all stay.  Of
    several texts under one id each stays or goes by itself.
    """
    digest, row = unused(docs, "_hash", "_row")
    gone = _placed(docs, size, threshold, hashed=True).where("not kept").select("doc_id", F.col("text_hash").alias(digest)).distinct()
    left = docs.withColumn(digest, F.xxhash64("text")).join(gone, ["doc_id", digest], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    mark = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64("text"))
    return left.withColumn(row, mark).dropDuplicates(["doc_id", row]).drop(row)


def _texts_of(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Texts of the documents that occur in ``pairs``, one per id."""
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    return texts.join(wanted, "doc_id", "left_semi")
