"""Removal of repeated word windows by fixed-block anchors.

Reference blocks of half a window lie end to end over every text, so each window
holds a whole one.  All blocks are indexed; every rolling block of every text
probes the index.  A block met elsewhere is a hit, and is extended: the windows
around hits are compared in full, and those that begin earlier elsewhere join into
the maximal repeats that go.

Texts never travel.  They are written once, in chunks, to a table bucketed by
chunk.  A chunk deals its sorted hashes over buckets of hashes, and a bucket answers
with one bit per hash, which the chunk turns back into places.  A hash travels once
per chunk however often it occurs there, so frequent passages and large groups of
copies make no bucket or task larger than others.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import scratch_path

CHUNK_BYTES = 8 << 20  # text of a chunk, unless one document is longer
BUCKET_BYTES = 16 << 20  # text whose hashes meet in one bucket
SLICE_BYTES = 256 << 10  # text hashed at once
PART_BYTES = 64 << 20  # text that one task reads back
LAST = np.iinfo(np.int64).max  # stands for a null id
DEALT = "bucket int, chunk long, data binary"
ANSWERS = "chunk long, bucket int, bits binary"
CUT = "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string, kept string"


# --- packed columns -----------------------------------------------------------


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, byte by byte of their values, compressed."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(data: bytes, *kinds: type) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    sizes = [np.dtype(k).itemsize for k in kinds]
    n, at, out = len(raw) // sum(sizes), 0, []
    for kind, size in zip(kinds, sizes):
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


def steps(ordered: np.ndarray) -> np.ndarray:
    """Differences of an ascending column; ``np.cumsum`` undoes them."""
    return np.diff(ordered, prepend=ordered.dtype.type(0))


# --- hashes of words, blocks and windows --------------------------------------


_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BASES = (0x9E3779B97F4A7C1B, 0xC2B2AE3D27D4EB53)  # odd, one per lane; both 3 modulo 8, so powers differ in many bits


class WordHashes:
    """Hashes of all words of a buffer at once.

    A word's hash is a polynomial of its bytes: the difference of two running sums
    over the buffer, moved to exponent zero by the inverse power of its start.  Long
    words are hashed by themselves.
    """

    LONG = 64

    def __init__(self):
        self.powers = [[np.ones(1, np.uint64)] * 2 for _ in _BASES]

    def _powers(self, n: int, lane: int) -> list[np.ndarray]:
        """Powers of the lane's base and of its inverse, ``n`` of each at least."""
        if len(self.powers[lane][0]) < n:
            n = max(n, 2 * SLICE_BYTES)
            for k, base in enumerate((_BASES[lane], pow(_BASES[lane], -1, 1 << 64))):
                factors = np.full(n, base, np.uint64)
                factors[0] = 1
                self.powers[lane][k] = np.cumprod(factors)
        return self.powers[lane]

    def of(self, raw: bytes, lane: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every word."""
        starts, hashes, at = [], [], 0
        while at < len(raw):
            end = min(len(raw), at + SLICE_BYTES)
            part = np.frombuffer(raw, np.uint8, end - at, at)
            cut = np.flatnonzero(_WHITE[part]) if end < len(raw) else ()
            while end < len(raw) and not len(cut):  # a word longer than a slice
                end = min(len(raw), 2 * end - at)
                part = np.frombuffer(raw, np.uint8, end - at, at)
                cut = np.flatnonzero(_WHITE[part])
            if end < len(raw):
                part = part[: cut[-1] + 1]
            first, hashed = self._slice(part, lane)
            starts.append(first + at)
            hashes.append(hashed)
            at += len(part)
        return np.concatenate([*starts, np.zeros(0, np.int64)]), np.concatenate([*hashes, np.zeros(0, np.uint64)])

    def _slice(self, part: np.ndarray, lane: int) -> tuple[np.ndarray, np.ndarray]:
        white = np.ones(len(part) + 2, bool)
        white[1:-1] = _WHITE[part]
        edges = np.flatnonzero(white[1:] != white[:-1])
        first, last = edges[::2], edges[1::2]
        power, inverse = self._powers(len(part) + 1, lane)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=sums[1:])
        hashed = (sums[last] - sums[first]) * inverse[first]
        for k in np.flatnonzero(last - first > self.LONG):
            hashed[k] = xxhash.xxh3_64_intdigest(part[first[k] : last[k]].tobytes(), seed=lane)
        return first, joined(hashed, (last - first).astype(np.uint64), lane)


def joined(a: np.ndarray, b: np.ndarray, lane: int) -> np.ndarray:
    """Hash of what ``a`` stands for, followed by what ``b`` does; lanes are independent."""
    first, second = ((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))[lane]
    x = a * np.uint64(first) + (b ^ (b >> np.uint64(31))) * np.uint64(second)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def run_hashes(word: np.ndarray, n: int, lane: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words, by halves."""
    if n == 1:
        return word
    half = n // 2
    whole = run_hashes(word, half, lane)
    whole = joined(whole[: max(0, len(whole) - half)], whole[half:], lane)
    return joined(whole[: max(0, len(whole) - 1)], word[2 * half :], lane) if n % 2 else whole


class Chunk:
    """Some documents: their words' hashes end to end, and what follows from them."""

    def __init__(self, ids: list[int | None], texts: list[bytes], window: int, memo: WordHashes):
        self.ids = np.array([LAST if i is None else i for i in ids], np.int64)
        self.window, self.block = window, (window + 1) // 2
        self.memo, self.raw = memo, b" ".join(texts)
        at, word = memo.of(self.raw, 0)
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.doc = np.searchsorted(ends, at, "right")
        self.sizes = np.bincount(self.doc, minlength=len(texts))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.n_words = len(word)
        self.place = np.arange(len(word)) - self.starts[self.doc]  # in its document
        self.hashes = run_hashes(word, self.block, 0)

    def room(self, n: int) -> np.ndarray:
        """Where ``n`` words of one document begin."""
        return np.flatnonzero(self.place + n <= self.sizes[self.doc])

    def probes(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All rolling blocks: sorted distinct keys (bucket, 32 bits of hash), which of them are
        reference blocks here, and by block its place and key number."""
        at = self.room(self.block)
        h = self.hashes[at]
        key = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
        keys, number = np.unique(key, return_inverse=True)
        indexed = np.zeros(len(keys), bool)
        indexed[number[self.place[at] % self.block == 0]] = True
        return keys, indexed, at, number

    def hit_windows(self, buckets: int, answers: list) -> np.ndarray:
        """Starts of the windows around hits: reference blocks that occur elsewhere as well."""
        keys, indexed, at, number = self.probes(buckets)
        live = indexed & (np.bincount(number, minlength=len(keys)) > 1)
        for bucket, bits in answers or ():
            low, high = np.searchsorted(keys, [np.uint64(bucket << 32), np.uint64(bucket + 1 << 32)])
            live[low:high] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=int(high - low)).astype(bool)
        hits = np.zeros(self.n_words + 1, np.int64)
        hits[at + 1] = live[number]
        upto = np.cumsum(hits)
        starts = self.room(self.window)
        return starts[upto[starts + self.window - self.block + 1] > upto[starts]]

    def sequences(self, starts: np.ndarray, buckets: int):
        """The distinct word sequences of windows: their two hashes and bucket, sorted by those,
        the first (id, place) of each, and by window its sequence and whether it comes after that first."""
        lanes = []
        for lane in range(2):
            block = self.hashes if lane == 0 else run_hashes(self.memo.of(self.raw, 1)[1], self.block, 1)
            lanes.append(joined(block[starts], block[starts + self.window - self.block], lane))
        bucket = (lanes[0] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)  # ascends with the hash
        order = np.lexsort(lanes[::-1])
        edge = np.ones(len(order), bool)
        edge[1:] = np.logical_or(*(np.diff(lane[order]) != 0 for lane in lanes))
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(edge) - 1
        _, ranks = np.unique(self.ids, return_inverse=True)
        rank = (ranks[self.doc[starts]] << 40) | self.place[starts]
        groups = np.flatnonzero(edge)
        first = np.minimum.reduceat(rank[order], groups) if len(order) else rank
        ids = np.unique(self.ids)[first >> 40] if len(first) else self.ids[:0]
        of = order[groups]
        return lanes[0][of], lanes[1][of], bucket[of], ids, first & ((1 << 40) - 1), number, rank > first[number]

    def removed(self, starts: np.ndarray) -> np.ndarray:
        """Which words the windows at ``starts`` cover."""
        edges = np.zeros(self.n_words + 1, np.int64)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + self.window, -1)
        return np.cumsum(edges)[:-1] > 0


# --- what a bucket of hashes answers ------------------------------------------


def _bits(chunks: list[int], bucket: int, sizes: list[int], yes: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """The answers to each chunk that asked; none where all are no."""
    for chunk, own in zip(chunks, np.split(yes, np.cumsum(sizes)[:-1])):
        if own.any():
            yield chunk, bucket, np.packbits(own).tobytes()


def met_elsewhere(asked: list[tuple[int, bytes]], bucket: int) -> Iterator[tuple[int, int, bytes]]:
    """Blocks that are a reference block somewhere and occur in more than one chunk."""
    parts = [unpack(data, np.uint32, np.bool_) for _, data in asked]
    key = np.concatenate([np.cumsum(p[0], dtype=np.uint32) for p in parts])
    indexed = np.concatenate([p[1] for p in parts])
    _, number, count = np.unique(key, return_inverse=True, return_counts=True)
    yes = (np.bincount(number, indexed) > 0) & (count > 1)
    return _bits([c for c, _ in asked], bucket, [len(p[0]) for p in parts], yes[number])


def earlier_elsewhere(asked: list[tuple[int, bytes]], bucket: int) -> Iterator[tuple[int, int, bytes]]:
    """Sequences that another chunk holds under a smaller (id, place)."""
    parts = [unpack(data, np.uint64, np.uint64, np.int64, np.int64) for _, data in asked]
    a = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
    b, ids, place = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
    order = np.lexsort((place, ids, b, a))
    edge = np.ones(len(order), bool)
    edge[1:] = (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)
    least = order[np.flatnonzero(edge)][np.cumsum(edge) - 1]
    yes = np.empty(len(order), bool)
    yes[order] = (ids[order] != ids[least]) | (place[order] != place[least])
    return _bits([c for c, _ in asked], bucket, [len(p[0]) for p in parts], yes)


def _dealt(chunk: int, bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Sorted columns cut by bucket; the first column travels as steps."""
    found, edges = np.unique(bucket, return_index=True)
    for b, low, high in zip(found.tolist(), edges, [*edges[1:], len(bucket)]):
        yield b, chunk, pack(steps(columns[0][low:high]), *(c[low:high] for c in columns[1:]))


def _batches(rows: Iterator[tuple], schema: str, size: int = 64) -> Iterator[pa.RecordBatch]:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    lot = []

    def batch():
        columns = zip(*lot) if lot else ((),) * len(fields)
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])

    for row in rows:
        lot.append(row)
        if len(lot) >= size:
            yield batch()
            lot = []
    yield batch()


# --- over the corpus ----------------------------------------------------------


def stored_chunks(texts: DataFrame, total: int, chunk_bytes: int) -> DataFrame:
    """``texts(doc_id, text)`` written as rows of about ``chunk_bytes``, bucketed by chunk: joins on it move no text."""
    spark = texts.sparkSession

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, ids, raw, size = TaskContext.get().partitionId(), 0, [], [], 0

        def chunk():
            columns = [pa.array([task << 24 | n]), pa.array([ids], pa.list_(pa.int64())), pa.array([raw], pa.list_(pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "ids", "texts"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                ids.append(doc_id)
                raw.append(text or b"")
                size += len(raw[-1])
                if size >= chunk_bytes:
                    yield chunk()
                    n, ids, raw, size = n + 1, [], [], 0
        if ids:
            yield chunk()

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / PART_BYTES))
    name = f"larder_chunks_{uuid.uuid4().hex}"
    chunks = texts.mapInArrow(gather, "chunk long, ids array<long>, texts array<binary>")
    writer = chunks.write.bucketBy(parts, "chunk").option("compression", "zstd")
    writer.option("path", scratch_path(spark, "chunks")).saveAsTable(name)
    return spark.table(name)


def repeated_words(docs: DataFrame, window: int = 20, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, n_spans, kept_sha256, kept``.

    Words are runs of bytes other than ASCII white space.  Every word goes that is
    covered by a window whose words also begin at a smaller (id, place) in the input;
    ``n_spans`` counts the removed runs, ``kept`` is what stays, joined by single
    spaces.  Null texts have no words.  A null id counts as the largest.  Rows with one
    id count as one document read twice: equal places do not make each other go.
    Texts shorter than a window keep everything; an empty table gives no rows.  Other
    columns are not read.  A task holds a chunk of texts, so memory follows the
    longest document, not the table.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    chunks = stored_chunks(texts, total, chunk_bytes)

    def per_chunk(work, schema):
        """``work(row, chunk)`` over the chunks of a task."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memo = WordHashes()

            def rows():
                for batch in batches:
                    for row in batch.to_pylist():
                        yield from work(row, Chunk(row["ids"], row["texts"], window, memo))

            yield from _batches(rows(), schema)

        return run

    def per_bucket(answer):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asked: dict[int, list] = {}
            for batch in batches:
                for bucket, chunk, data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "chunk", "data"))):
                    asked.setdefault(bucket, []).append((chunk, data))
            yield from _batches((row for bucket, rows in asked.items() for row in answer(rows, bucket)), ANSWERS)

        return run

    def round_of(given: DataFrame, work, answer, name: str) -> DataFrame:
        """Hashes go to their buckets, bits come back: one stored row per chunk."""
        dealt = given.mapInArrow(per_chunk(work, DEALT), DEALT).repartitionById(buckets, F.col("bucket"))
        path = scratch_path(spark, name)
        dealt.mapInArrow(per_bucket(answer), ANSWERS).write.parquet(path)
        return spark.read.parquet(path).groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))

    def probe(row, chunk):
        keys, indexed, _, _ = chunk.probes(buckets)
        yield from _dealt(row["chunk"], keys >> np.uint64(32), (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32), indexed)

    def windows(row, chunk):
        return chunk.hit_windows(buckets, [(a["bucket"], a["bits"]) for a in row["hits"] or ()])

    def extend(row, chunk):
        a, b, bucket, ids, place, _, _ = chunk.sequences(windows(row, chunk), buckets)
        yield from _dealt(row["chunk"], bucket, a, b, ids, place)

    def cut(row, chunk):
        starts = windows(row, chunk)
        _, _, bucket, _, _, number, later = chunk.sequences(starts, buckets)
        earlier = np.zeros(len(bucket), bool)
        for answer in row["repeats"] or ():
            low, high = np.searchsorted(bucket, [np.uint64(answer["bucket"]), np.uint64(answer["bucket"] + 1)])
            earlier[low:high] = np.unpackbits(np.frombuffer(answer["bits"], np.uint8), count=int(high - low))
        gone = chunk.removed(starts[later | earlier[number]])
        for k, (doc_id, text) in enumerate(zip(row["ids"], row["texts"])):
            own = gone[chunk.starts[k] : chunk.starts[k + 1]]
            words = text.split()
            kept = b" ".join(compress(words, ~own) if own.any() else words)
            spans = int(np.count_nonzero(np.diff(own.astype(np.int8), prepend=0) == 1))
            yield doc_id, len(words), int(own.sum()), spans, hashlib.sha256(kept).hexdigest(), kept.decode()

    hits = round_of(chunks, probe, met_elsewhere, "hits")
    known = chunks.join(hits, "chunk", "left")
    repeats = round_of(known, extend, earlier_elsewhere, "repeats")
    return known.join(repeats, "chunk", "left").mapInArrow(per_chunk(cut, CUT), CUT)


REPEATED_SQL = """
WITH bd_docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
bd_windows AS (SELECT r, doc_id, unnest(range(1, len(w) - 18)) AS s FROM bd_docs WHERE len(w) >= 20),
bd_sequences AS (SELECT v.r, v.doc_id, v.s, sha256(array_to_string(d.w[v.s:v.s + 19], ' ')) AS q FROM bd_windows v JOIN bd_docs d ON d.r = v.r),
bd_firsts AS (SELECT q, min((coalesce(doc_id, 9223372036854775807), s)) AS f FROM bd_sequences GROUP BY q),
bd_gone AS (
  SELECT DISTINCT r, unnest(range(s, s + 20)) AS i FROM bd_sequences JOIN bd_firsts USING (q)
  WHERE (coalesce(doc_id, 9223372036854775807), s) > f),
bd_flat AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM bd_docs),
bd_kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS kept FROM bd_flat ANTI JOIN bd_gone USING (r, i) GROUP BY r),
bd_counts AS (SELECT r, count(*) AS n, count(*) FILTER (WHERE NOT follows) AS spans
  FROM (SELECT r, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i) = 1, false) AS follows FROM bd_gone) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(coalesce(kept, '')) AS kept_sha256
FROM bd_docs LEFT JOIN bd_counts USING (r) LEFT JOIN bd_kept USING (r)"""
