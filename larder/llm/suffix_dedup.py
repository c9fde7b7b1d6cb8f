"""Exact removal of long repeated substrings across documents, by a distributed merge sort of suffixes.

A string of ``length`` bytes is removed wherever it starts in a document while
it also starts in one with a smaller id.  Sorting every suffix of a corpus would
ship each byte dozens of times.  Instead each string is filed under one *anchor*
inside it, the place of the smallest hash among its ``ANCHOR``-byte pieces: equal
strings have the same anchor, and neighbouring strings mostly share one.  So only
the suffixes that begin at anchors are sorted, about one in twenty.  An entry
is such a suffix (at most ``length`` bytes), the bytes before it, and the range
of strings filed under it.

1. Tasks cut texts into runs, sort the entries of a run, and front code them.
   Of equal entries within a run only those of the first document travel.
2. Runs are split by sampled splitters of the first bytes, so bins hold ranges
   of the suffix array, and exchanged.
3. A bin drops entries whose anchor piece occurs in one document only, and
   merges the rest with loser trees.  Shared prefixes to the right and left of
   the anchor give, for each distance, the classes of equal strings.
4. Removed stretches meet their texts by hashed id, in one more exchange.

Everything is by content: no window, count or size limits what is found.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm import suffix_runs as runs_of
from larder.llm.near_dup import _mix

LENGTH = 50
ANCHOR = 12
REACH = LENGTH - ANCHOR  # an anchor lies at most so far behind the string's start
PLACE_BITS = 24
RUN_BYTES = 8 << 20  # text of a run; at most 2**PLACE_BITS
BIN_BYTES = 8 << 20  # text per bin
SAMPLE_BYTES = 8 << 20  # text the splitters are taken from
STRIDE = 1 << 15  # places whose anchors are sought at once
LEFT_WORDS = 5  # 38 bytes before the anchor, padding, length
PACK_LEVEL = 3

_PLACE = np.uint64((1 << PLACE_BITS) - 1)


def _pack(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=PACK_LEVEL).compress(data)


def _unpack(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def dump(arrays: list[np.ndarray]) -> bytes:
    """Arrays as one packed byte string."""
    head = [len(arrays)] + [x for a in arrays for x in (ord(a.dtype.char), len(a))]
    return _pack(np.array(head, "<i8").tobytes() + b"".join(a.tobytes() for a in arrays))


def load(data: bytes) -> list[np.ndarray]:
    raw = _unpack(data)
    (n,) = np.frombuffer(raw, "<i8", 1)
    head = np.frombuffer(raw, "<i8", 2 * int(n), 8)
    out, at = [], 8 + 16 * int(n)
    for kind, size in head.reshape(-1, 2):
        a = np.frombuffer(raw, np.dtype(chr(kind)), int(size), at)
        out.append(a)
        at += a.nbytes
    return out


# --- entries of a run ---------------------------------------------------------


class Run:
    """Pieces of texts laid end to end: (doc id, checksum, offset of the piece in its text, bytes)."""

    def __init__(self, pieces: list[tuple[int, int, int, bytes]]):
        self.ids = np.array([p[0] for p in pieces], np.int64)
        self.sums = np.array([p[1] for p in pieces], np.uint32)
        self.offsets = np.array([p[2] for p in pieces], np.int64)
        self.starts = np.cumsum([0] + [len(p[3]) for p in pieces])
        data = b"".join(p[3] for p in pieces)
        self.n = len(data)
        self.data = np.frombuffer(data + bytes(64), np.uint8)

    def _eight(self, at: int = 0, stop: int | None = None) -> np.ndarray:
        """The eight bytes from every place on, as a little-endian number."""
        stop = self.n if stop is None else stop
        v = self.data[at : stop + 56].astype(np.uint64)
        for step in (1, 2, 4):
            v = v[:-step] | (v[step:] << np.uint64(8 * step))
        return v

    def _owners(self) -> np.ndarray:
        """For every place the anchor of the string that starts there, in blocks that fit the cache."""
        out = np.empty(self.n, np.uint32)
        for at in range(0, self.n, STRIDE):
            stop = min(at + STRIDE, self.n)
            eight = self._eight(at, stop)
            wanted = stop - at + REACH
            h = eight[:wanted] * np.uint64(0x9E3779B97F4A7C15)
            h += (eight[ANCHOR - 8 : wanted + ANCHOR - 8] ^ np.uint64(0x94D049BB133111EB)) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            h &= ~_PLACE
            h |= np.arange(at, at + wanted, dtype=np.uint64)
            span = 1
            while span * 2 <= REACH + 1:
                h = np.minimum(h[:-span], h[span:])
                span *= 2
            rest = REACH + 1 - span
            h = np.minimum(h[:-rest], h[rest:]) if rest else h
            out[at:stop] = (h & _PLACE)[: stop - at]
        return out

    def anchors(self) -> None:
        """Entries: anchor place, and how far before it its first and last string start."""
        owners = self._owners()
        ends = self.starts[1:] - LENGTH + 1  # behind the last string of each piece
        changes = np.flatnonzero(owners[1:] != owners[:-1]) + 1
        first = np.unique(np.concatenate([changes, self.starts[:-1], ends[ends > self.starts[:-1]]]))
        last = np.append(first[1:], self.n) - 1
        whole = first < ends[self.piece_of(first)]
        first, last = first[whole], last[whole]
        self.place = owners[first].astype(np.int64)
        self.far = (self.place - first).astype(np.uint8)
        self.near = (self.place - last).astype(np.uint8)
        eight = self._eight()
        self.right = self._words(eight, self.place, LENGTH - self.near.astype(np.int64), runs_of.WORDS)
        # The bytes before the anchor, nearest first: a forward read of the text backwards.
        back = Run.__new__(Run)
        back.n, back.data = self.n, np.concatenate([self.data[: self.n][::-1], np.zeros(64, np.uint8)])
        self.left = self._words(back._eight(), self.n - self.place, self.far.astype(np.int64), LEFT_WORDS)

    @staticmethod
    def _words(eight: np.ndarray, places: np.ndarray, lengths: np.ndarray, n: int) -> list[np.ndarray]:
        """The strings as big-endian words, zero padded, the length in the last byte."""
        out = []
        for k in range(n):
            word = eight[np.minimum(places + 8 * k, len(eight) - 1)].byteswap()
            left = np.clip(lengths - 8 * k, 0, 8)
            shift = ((8 - left) * 8).astype(np.uint64)
            word = np.where(left > 0, (word >> np.minimum(shift, np.uint64(63))) << np.minimum(shift, np.uint64(63)), np.uint64(0))
            out.append(word)
        out[-1] = out[-1] | lengths.astype(np.uint64)
        return out

    def piece_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1

    def take(self, spots: np.ndarray) -> None:
        for name in ("place", "far", "near", "piece"):
            setattr(self, name, getattr(self, name)[spots])
        self.right = [w[spots] for w in self.right]
        self.left = [w[spots] for w in self.left]

    def sort(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sort the entries; those equal to one of an earlier document leave.

        Returns the removed ones' pieces and stretches of string starts.
        """
        self.piece = self.piece_of(self.place)
        owner = self.ids[self.piece]
        self.take(np.argsort(owner, kind="stable"))
        self.take(runs_of.sort_rows(self.right + self.left))
        same = np.ones(max(len(self.place) - 1, 0), bool)
        for w in self.right + self.left:
            same &= w[1:] == w[:-1]
        group = np.cumsum(np.concatenate([[True], ~same])) - 1 if len(self.place) else np.empty(0, np.int64)
        first_of = np.flatnonzero(np.concatenate([[True], ~same])) if len(self.place) else np.empty(0, np.int64)
        owner = self.ids[self.piece]
        later = owner > owner[first_of[group]] if len(group) else np.empty(0, bool)
        gone = (self.piece[later], (self.place - self.far)[later], (self.place - self.near)[later])
        self.take(np.flatnonzero(~later))
        return gone

    def block(self, spots: slice) -> bytes:
        """Some consecutive sorted entries, front coded, with what is needed of their pieces."""
        right, left = [w[spots] for w in self.right], [w[spots] for w in self.left]
        near, far = self.near[spots], self.far[spots]
        lengths = (LENGTH - near).astype(np.uint8)
        shared = runs_of.common_bytes(right)
        body = runs_of.to_bytes(right)
        back = runs_of.to_bytes(left)
        known = runs_of.common_bytes(left)
        pieces, own = np.unique(self.piece[spots], return_inverse=True)
        inside = (self.place[spots] - self.starts[pieces][own]).astype(np.uint32)
        kind = np.uint16 if len(pieces) < 65536 else np.uint32
        return dump([
            self.ids[pieces], self.sums[pieces], self.offsets[pieces], own.astype(kind), inside, near, far, shared,
            np.frombuffer(runs_of.front_code(body, np.minimum(shared, lengths), lengths), np.uint8),
            np.minimum(known, far), np.frombuffer(runs_of.front_code(back, np.minimum(known, far), far), np.uint8),
        ])


class Entries:
    """A block read back."""

    def __init__(self, data: bytes):
        ids, sums, offsets, own, inside, self.near, self.far, self.shared, body, known, back = load(data)
        self.doc, self.sum = ids[own], sums[own]
        self.place = offsets[own] + inside  # bytes before the anchor in its text
        lengths = (LENGTH - self.near).astype(np.uint8)
        self.rows = runs_of.front_decode(body, np.minimum(self.shared, lengths), lengths, runs_of.WIDTH)
        self.rows[:, -1] = lengths
        self.back = runs_of.front_decode(back, known, self.far, 8 * LEFT_WORDS)
        self.back[:, -1] = self.far

    def take(self, spots: np.ndarray) -> None:
        """Keep some entries; what a row shares with the one kept before is the least in between."""
        if len(spots):
            shared = np.minimum.reduceat(self.shared[: spots[-1] + 1], np.concatenate([[0], spots[:-1] + 1]))
            shared[0] = 0
            self.shared = shared
        else:
            self.shared = self.shared[:0]
        for name in ("near", "far", "doc", "sum", "place", "rows", "back"):
            setattr(self, name, getattr(self, name)[spots])


def _hash_heads(rows: np.ndarray, size: int) -> np.ndarray:
    head = np.zeros((len(rows), -(-size // 8) * 8), np.uint8)
    head[:, :size] = rows[:, :size]
    key = np.zeros(len(rows), np.uint64)
    for word in runs_of.to_words(head):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + word)
    return key


def _several_owners(keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Whether the key of a row occurs with at least two documents."""
    order = np.argsort(keys, kind="stable")
    k, d = keys[order], docs[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    several = np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first)
    out = np.empty(len(keys), bool)
    out[order] = np.repeat(several, np.diff(np.append(first, len(k))))
    return out


def merge_bin(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Strings of a bin that start in an earlier document too: (doc, checksum, first start, end start)."""
    parts = [Entries(b) for b in blocks]
    for size in (ANCHOR, 24, 32):
        # A string filed under an entry reaches at least this far behind the anchor.
        reach = [LENGTH - p.far.astype(np.int64) for p in parts]
        keys = np.concatenate([_hash_heads(p.rows, size) for p in parts]) if parts else np.empty(0, np.uint64)
        if not len(keys):
            break
        several = _several_owners(keys, np.concatenate([p.doc for p in parts])) | (np.concatenate(reach) < size)
        at = 0
        for p in parts:
            n = len(p.doc)
            p.take(np.flatnonzero(several[at : at + n]))
            at += n
        parts = [p for p in parts if len(p.doc)]
    if not parts:
        return (np.empty(0, np.int64), np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64))
    merged, shared = runs_of.merge_runs(
        [([row.tobytes() for row in p.rows], p.shared.tolist()) for p in parts]
    )
    source = np.array(merged)
    base = np.concatenate([[0], np.cumsum([len(p.doc) for p in parts])])
    order = np.empty(len(source), np.int64)
    for r in range(len(parts)):
        order[source == r] = np.arange(base[r], base[r + 1])
    near, far, doc, check, place = (
        np.concatenate([getattr(p, name) for p in parts])[order] for name in ("near", "far", "doc", "sum", "place")
    )
    back = runs_of.to_words(np.concatenate([p.back for p in parts])[order])
    right_shared = np.array(shared, np.uint8)
    by_left = runs_of.sort_rows(back)
    left_shared = runs_of.common_bytes([w[by_left] for w in back])
    out: list[tuple] = []
    for distance in range(REACH + 1):
        spots = np.flatnonzero((near <= distance) & (distance <= far))
        if not len(spots):
            continue
        right = np.cumsum(right_shared < LENGTH - distance)
        left = np.empty(len(near), np.int64)
        left[by_left] = np.cumsum(left_shared < distance) if distance else 0
        key = (right[spots].astype(np.uint64) << np.uint64(32)) | left[spots].astype(np.uint64)
        by_key = np.argsort(key, kind="stable")
        k, d = key[by_key], doc[spots][by_key]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        least = np.repeat(np.minimum.reduceat(d, first), np.diff(np.append(first, len(k))))
        gone = spots[by_key[d > least]]
        out.append((doc[gone], check[gone], place[gone] - distance))
    docs, sums, starts = (np.concatenate(x) for x in zip(*out))
    return _stretches(docs, sums, starts, starts + 1)


def _stretches(docs: np.ndarray, sums: np.ndarray, first: np.ndarray, end: np.ndarray):
    """Join touching or overlapping stretches of one document."""
    order = np.lexsort((first, sums, docs))
    docs, sums, first, end = docs[order], sums[order], first[order], end[order]
    if not len(docs):
        return docs, sums, first, end
    other = np.concatenate([[True], (docs[1:] != docs[:-1]) | (sums[1:] != sums[:-1])])
    # Running ends within a document, by an offset that keeps documents apart.
    shift = np.cumsum(other).astype(np.int64) << 40
    reach = np.maximum.accumulate(end + shift)
    new = other | np.concatenate([[True], (first + shift)[1:] > reach[:-1]])
    spots = np.flatnonzero(new)
    lasts = np.append(spots[1:], len(docs)) - 1
    return docs[spots], sums[spots], first[spots], (reach - shift)[lasts]


# --- the job ------------------------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch], run_bytes: int) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Texts in lots of about ``run_bytes``; longer texts in pieces that overlap by one string."""
    lot, size = [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = (text or "").encode()
            if doc_id is None or len(data) < LENGTH:
                continue
            check, at = zlib.crc32(data), 0
            while True:
                part = data[at : at + run_bytes]
                if size and size + len(part) > run_bytes:
                    yield lot
                    lot, size = [], 0
                lot.append((doc_id, check, at, part))
                size += len(part)
                if at + run_bytes >= len(data):
                    break
                at += run_bytes - LENGTH + 1
    if lot:
        yield lot


def _splitters(texts: DataFrame, total: int, bins: int, run_bytes: int) -> np.ndarray:
    """First words that split the sorted entries evenly, from a sample of about ``SAMPLE_BYTES`` of text."""
    if bins == 1:
        return np.empty(0, np.uint64)
    share = min(1.0, SAMPLE_BYTES / total)
    some = texts if share == 1.0 else texts.sample(share, seed=5)

    def heads(batches):
        for lot in _pieces(batches, run_bytes):
            run = Run(lot)
            run.anchors()
            yield pa.RecordBatch.from_pydict({"head": pa.array([run.right[0].tobytes()], pa.binary())})

    found = [np.frombuffer(r["head"], np.uint64) for r in some.mapInArrow(heads, "head binary").collect()]
    values = np.sort(np.concatenate(found)) if found else np.empty(0, np.uint64)
    if not len(values):
        return np.empty(0, np.uint64)
    return np.unique(values[(np.arange(1, bins) * len(values)) // bins])


def repeated_bytes(docs: DataFrame, run_bytes: int = RUN_BYTES, bin_bytes: int = BIN_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the bytes left).

    Null texts are empty.  Rows without an id, and texts under 50 bytes, neither
    lose bytes nor cause losses.  Repeated rows (same id) do not cause losses in
    each other and get the same result.  Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bins = max(1, math.ceil(total / bin_bytes))
    splitters = _splitters(texts, total, bins, run_bytes)
    bins = len(splitters) + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in _pieces(batches, run_bytes):
            run = Run(lot)
            run.anchors()
            piece, first, last = run.sort()
            moved = run.offsets[piece] - run.starts[piece]
            gone = dump(list(_stretches(run.ids[piece], run.sums[piece], first + moved, last + moved + 1)))
            edges = np.concatenate([[0], np.searchsorted(run.right[0], splitters, "right"), [len(run.place)]])
            rows = [(int(run.ids[0]) % bins, 0, gone)]
            for b in np.flatnonzero(np.diff(edges)):
                rows.append((int(b), 1, run.block(slice(int(edges[b]), int(edges[b + 1])))))
            for at in range(0, len(rows), 16):
                some = rows[at : at + 16]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in some], pa.int32()), pa.array([r[1] for r in some], pa.int32()), pa.array([r[2] for r in some], pa.binary())],
                    names=["bin", "kind", "data"],
                )

    # Texts meet their stretches in buckets of hashed ids.
    def bucket(ids: np.ndarray) -> np.ndarray:
        return (_mix(ids.astype(np.uint64)) % np.uint64(bins)).astype(np.int64)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, found = [], []
        for batch in batches:
            for kind, data in zip(batch.column("kind").to_pylist(), batch.column("data").to_pylist()):
                if kind:
                    blocks.append(data)
                else:
                    found.append(load(data))
        if blocks:
            found.append(merge_bin(blocks))
        if not found:
            return
        ids, sums, first, end = _stretches(*(np.concatenate(x) for x in zip(*found)))
        to = bucket(ids)
        for b in np.unique(to):
            own = to == b
            data = dump([ids[own], sums[own], first[own], end[own]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(b)], pa.int32()), pa.array([0], pa.int32()), pa.array([None], pa.int64()), pa.array([data], pa.binary())],
                names=["bucket", "kind", "doc_id", "data"],
            )

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            raw = [(t or "").encode() for t in batch.column(1).to_pylist()]
            to = bucket(np.asarray(ids.fill_null(0)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(to.astype(np.int32)), pa.array(np.ones(len(raw), np.int32)), ids, pa.array([_pack(r) if r else b"" for r in raw], pa.binary())],
                names=["bucket", "kind", "doc_id", "data"],
            )

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, table = [], None
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
            for kind, doc_id, data in zip(*(batch.column(c).to_pylist() for c in ("kind", "doc_id", "data"))):
                if not kind:
                    found.append(load(data))
                    continue
                if table is None:  # all stretches come before the first text
                    table = _stretches(*(np.concatenate(x) for x in zip(*found))) if found else None
                    table = table or tuple(np.empty(0, np.int64) for _ in range(4))
                raw = _unpack(data) if data else b""
                kept, removed, spans = _cut_out(raw, doc_id, table)
                for name, value in zip(out, (doc_id, len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept)):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[n], t) for n, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))],
                names=list(out),
            )

    schema = "bucket int, kind int, doc_id long, data binary"
    stretches = texts.mapInArrow(cut, "bin int, kind int, data binary").repartitionById(bins, F.col("bin")).mapInArrow(merge, schema)
    both = stretches.union(texts.mapInArrow(carry, schema)).repartitionById(bins, F.col("bucket")).sortWithinPartitions("kind")
    return both.mapInArrow(apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def _cut_out(raw: bytes, doc_id: int | None, table) -> tuple[bytes, int, int]:
    """The bytes left of one text, how many went, and in how many runs."""
    ids, sums, first, end = table
    low, high = (np.searchsorted(ids, doc_id, side) for side in ("left", "right")) if doc_id is not None else (0, 0)
    if low == high:
        return raw, 0, 0
    own = slice(int(low), int(high))
    match = sums[own] == zlib.crc32(raw)
    starts, ends = first[own][match], end[own][match] - 1 + LENGTH
    parts, at, removed, spans = [], 0, 0, 0
    for start, stop in zip(starts.tolist(), ends.tolist()):
        if start > at or not spans:
            spans += 1
        start = max(start, at)
        if stop > start:
            parts.append(raw[at:start])
            removed += stop - start
            at = stop
    parts.append(raw[at:])
    return b"".join(parts), removed, spans
