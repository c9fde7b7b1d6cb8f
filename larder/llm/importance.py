"""Importance resampling towards a target: documents drawn by how their n-grams resemble it.

Features are runs of one to three words, hashed by CRC-32 into buckets.  A CRC of
joined bytes follows from the CRC of the front and of the rest (the front's is
moved over the rest's length, a linear map), so a word needs its states only once.
Frequent words and pairs form a head: their exact states are worked out once and
broadcast; everything else takes its CRC from its own bytes.  The head decides the
speed only: both parts feed the same exact totals.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import map_columns
from larder.session import scratch_path

BUCKETS = 10_000
HEAD_SHARE = 1 << 14  # a head feature is one in so many words at least, so there are no more than so many of each kind
HEAD_BYTES = 64  # longer features never join the head
CHUNK_WORDS = 1 << 18
PIECE_BYTES = 1 << 20
POLYNOMIAL = 0xEDB88320

# A-Z to a-z; everything ASCII that is neither letter nor digit to a space.
_FOLD = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()


# --- cyclic redundancy checks -------------------------------------------------


class Shifts:
    """Moves arrays of CRC states over as many bytes as wanted.

    The state of a followed by b is ``over(state(a), len(b)) ^ crc32(b)``.  Short
    moves are one table look-up per byte of the state; longer ones go on in powers of two.
    """

    SHORT = 64

    def __init__(self):
        byte = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            byte = (byte >> 1) ^ np.where(byte & 1, np.uint32(POLYNOMIAL), np.uint32(0))
        tables = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
        for _ in range(self.SHORT):
            last = tables[-1]
            tables.append((last >> 8) ^ byte[last & 255])
        self.powers = [tables.pop()]  # over SHORT bytes, twice as many, ...
        self.short = np.stack(tables, axis=1).reshape(4, -1)  # by byte of the state: length * 256 + value

    def over(self, state: np.ndarray, length: np.ndarray) -> np.ndarray:
        at = (length & (self.SHORT - 1)) << 8
        moved = np.zeros_like(state)
        for k in range(4):
            moved ^= self.short[k][at + ((state >> np.uint32(8 * k)) & np.uint32(255))]
        rest, power = length >> 6, 0
        while rest.any():
            if power == len(self.powers):
                self.powers.append(self._apply(self.powers[-1], self.powers[-1]))
            odd = np.flatnonzero(rest & 1)
            moved[odd] = self._apply(self.powers[power], moved[odd])
            rest, power = rest >> 1, power + 1
        return moved

    @staticmethod
    def _apply(table: np.ndarray, state: np.ndarray) -> np.ndarray:
        out = table[0][state & np.uint32(255)]
        for k in range(1, 4):
            out = out ^ table[k][(state >> np.uint32(8 * k)) & np.uint32(255)]
        return out


def pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, at most about a megabyte of them at a time."""
    start = 0
    while start < len(raw):
        end = raw.find(b" ", start + PIECE_BYTES, len(raw)) if start + PIECE_BYTES < len(raw) else -1
        end = len(raw) if end < 0 else end
        yield raw[start:end].split()
        start = end


@dataclass
class Chunk:
    """Words end to end: head number (or -1), CRC, length, row of the text, and whether it is new.

    A text that goes on in another piece hands it its last two words, which are not
    new there.  Rows of neighbouring pieces of one text differ by sign, so that no
    feature spans them.
    """

    ids: np.ndarray
    state: np.ndarray
    length: np.ndarray
    rows: np.ndarray
    new: np.ndarray

    def __post_init__(self):
        self.owner = np.where(self.rows < 0, -self.rows - 1, self.rows)
        self.pairs = (self.rows[1:] == self.rows[:-1]) & self.new[1:]
        self.triples = self.pairs[1:] & (self.rows[1:-1] == self.rows[:-2])


class Features:
    """Buckets of all features of texts, by the head's states and pairs or by the bytes."""

    def __init__(self, head: list[bytes]):
        self.shifts = Shifts()
        words = [f for f in head if b" " not in f]
        self.n_head, self.number = len(words), {w: i for i, w in enumerate(words)}
        self.head_state = np.array([zlib.crc32(w) for w in words], np.uint32)
        # Frequent pairs lie in a table with one place per hash; of two with one place the first stays.
        pairs = [f for f in head if b" " in f]
        ids = [tuple(map(self.number.get, f.split())) for f in pairs]
        known = [(f, a * len(words) + b) for f, (a, b) in zip(pairs, ids) if a is not None and b is not None]
        self.bits = max(4, (4 * len(known)).bit_length())
        self.pair_key = np.full(1 << self.bits, -1, np.int64)
        self.pair_state = np.zeros(1 << self.bits, np.uint32)
        for pair, key in reversed(known):
            place = int(self._place(np.array([key]))[0])
            self.pair_key[place], self.pair_state[place] = key, zlib.crc32(pair)
        self.pair_bucket = self.pair_state % np.uint32(BUCKETS)

    def _place(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def _looked_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Head number, CRC and length; words outside the head take their CRC from the bytes."""
        ids = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        tail = ids < 0
        state = np.empty(len(words), np.uint32)
        state[~tail] = self.head_state[ids[~tail]]
        state[tail] = np.fromiter(map(zlib.crc32, compress(words, tail)), np.uint32)
        return ids, state, np.fromiter(map(len, words), np.int64, len(words))

    def chunks(self, texts: list[bytes | None]) -> Iterator[tuple[Chunk, list[bytes]]]:
        """The words of texts in chunks of bounded size, with their spellings."""
        parts, spelled, n = [], [], 0
        for row, text in enumerate(texts):
            carried, side = None, row
            for words in pieces((text or b"").translate(_FOLD)):
                if not words:
                    continue
                columns, new = self._looked_up(words), np.ones(len(words), bool)
                if carried is not None:
                    columns = [np.concatenate(c) for c in zip(carried[:3], columns)]
                    new = np.concatenate([np.zeros(len(carried[0]), bool), new])
                    words = carried[3] + words
                parts.append((*columns, np.full(len(words), side), new))
                spelled += words
                n += len(words)
                carried, side = (*(c[-2:] for c in columns), words[-2:]), -side - 1
                if n >= CHUNK_WORDS:
                    yield Chunk(*map(np.concatenate, zip(*parts))), spelled
                    parts, spelled, n = [], [], 0
        if n:
            yield Chunk(*map(np.concatenate, zip(*parts))), spelled

    def spaced(self, state: np.ndarray, length: np.ndarray) -> np.ndarray:
        """CRC of a space and the word, from the word's."""
        return self.shifts.over(np.full(len(state), zlib.crc32(b" "), np.uint32), length) ^ state

    def joined(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """CRC and bucket of each word and the next; CRC of every word behind a space, and that one's length."""
        spaced, step = self.spaced(chunk.state, chunk.length), chunk.length + 1
        first, second = chunk.ids[:-1], chunk.ids[1:]
        key = np.where((first < 0) | (second < 0), -2, first * self.n_head + second)
        place = self._place(key)
        state, bucket = self.pair_state[place], self.pair_bucket[place]
        tail = np.flatnonzero(self.pair_key[place] != key)
        state[tail] = self.shifts.over(chunk.state[tail], step[tail + 1]) ^ spaced[tail + 1]
        bucket[tail] = state[tail] % np.uint32(BUCKETS)
        return state, bucket, spaced, step

    def buckets(self, texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Bucket of every feature and the row of the text it is in."""
        for chunk, _ in self.chunks(texts):
            pair, bucket, spaced, step = self.joined(chunk)
            triples = chunk.triples
            triple = self.shifts.over(pair[:-1][triples], step[2:][triples]) ^ spaced[2:][triples]
            found = [chunk.state[chunk.new] % np.uint32(BUCKETS), bucket[chunk.pairs], triple % np.uint32(BUCKETS)]
            owners = [chunk.owner[chunk.new], chunk.owner[1:][chunk.pairs], chunk.owner[2:][triples]]
            yield np.concatenate(found).astype(np.int64), np.concatenate(owners)


# --- over the corpus ----------------------------------------------------------


def _raw(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _frequent(batch: pa.RecordBatch) -> dict:
    """Words and pairs that are frequent in a chunk, with their counts; all words under an empty name.

    They are counted by CRC and spelled as where they first occur.  Two with one CRC
    count as one of them, which can only put a rarer feature into the head.
    """
    features, found = Features([]), {b"": 0}
    for chunk, words in features.chunks(_raw(batch)):
        n_words = int(chunk.new.sum())
        found[b""] += n_words
        pair, _, _, _ = features.joined(chunk)
        for states, at, size in ((chunk.state, np.flatnonzero(chunk.new), 1), (pair, np.flatnonzero(chunk.pairs), 2)):
            _, first, counts = np.unique(states[at], return_index=True, return_counts=True)
            often = counts >= max(2, n_words // HEAD_SHARE)
            for place, n in zip(at[first[often]].tolist(), counts[often].tolist()):
                name = b" ".join(words[place : place + size])
                if len(name) <= HEAD_BYTES:
                    found[name] = found.get(name, 0) + n
    return {"feature": list(found), "n": list(found.values())}


def head_features(docs: DataFrame) -> list[bytes]:
    """Words and pairs that make up one in ``HEAD_SHARE`` words at least, most frequent first.

    Of each kind there can be no more than ``HEAD_SHARE``, so the list is bounded at any size.
    """
    path = scratch_path(docs.sparkSession, "head")
    counts = map_columns(docs.select("text"), _frequent, "feature binary, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    counts.write.parquet(path)
    stored = docs.sparkSession.read.parquet(path)
    words = stored.where(F.octet_length("feature") == 0).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    frequent = stored.where((F.octet_length("feature") > 0) & (F.col("n") * HEAD_SHARE >= words)).collect()
    return [bytes(r.feature) for r in sorted(frequent, key=lambda r: (-r.n, r.feature))]


def bucket_totals(docs: DataFrame, head) -> np.ndarray:
    """How many features of all texts fall into each bucket: one partial total per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, totals = Features(head.value), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for bucket, _ in features.buckets(_raw(batch)):
                totals += np.bincount(bucket, minlength=BUCKETS)
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(totals[at])], names=["bucket", "n"])

    totals = np.zeros(BUCKETS, np.int64)
    for row in docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        totals[row.bucket] = row.n
    return totals


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed share in the target to that in the corpus."""
    s_all, t_all = int(corpus.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log(float((t + 1) * (s_all + BUCKETS)) / float((s + 1) * (t_all + BUCKETS))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel draw that only the id and the seed decide."""
    name = "" if doc_id is None else doc_id
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, head, gain: np.ndarray, seed: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row of ``docs(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(head.value)
        for batch in batches:
            texts, ids = _raw(batch), batch.column("doc_id").to_pylist()
            n_features, weight = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for bucket, row in features.buckets(texts):
                n_features += np.bincount(row, minlength=len(texts))
                weight += np.bincount(row, gain[bucket], minlength=len(texts)).astype(np.int64)
            # n words make n features of one word, n - 1 of two and n - 2 of three.
            n_words = np.where(n_features > 1, n_features // 3 + 1, n_features)
            score = weight + np.array([noise(i, seed) for i in ids], np.int64)
            columns = [batch.column("doc_id"), *map(pa.array, (n_words, n_features, weight, score))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row's ``doc_id, n_features, weight, score, rank``; ``rank`` is null unless the row is drawn.

    Drawn are the ``percent`` % (rounded down) highest scores among the rows of at
    least ``least_words`` words, ties to the smaller id.  Null texts have no words.
    Rows with one id share one draw of noise and are told apart by score and weight;
    equal rows take neighbouring ranks.  A null id draws as an empty one and comes
    last among ties.  An empty table gives no rows; an empty target is a target in
    which no bucket has a feature.  Other columns of either table are not looked at.

    Three passes over the texts (head, totals, weights), each of them narrow; what
    is shuffled are counts, and five numbers per document for the ranking.  Ranks
    come from a stored global sort: a row's place in its part plus the rows of the
    parts before it.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    head = spark.sparkContext.broadcast(head_features(docs))
    gain = gains(bucket_totals(docs, head), bucket_totals(target.select(F.col(text).alias("text")), head))
    path = scratch_path(spark, "scores")
    scored(docs, head, gain, seed).write.parquet(path)
    scores = spark.read.parquet(path)
    eligible = scores.where(F.col("n_words") >= least_words)
    drawn = eligible.count() * percent // 100
    path = scratch_path(spark, "ranking")
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features")]
    eligible.orderBy(*order).withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).withColumn("part", F.shiftright("place", 33))
    before, n = [], 0
    for row in sorted(placed.groupBy("part").count().collect()):  # one row per part
        before.append((row.part, n))
        n += row["count"]
    starts = spark.createDataFrame(before, "part long, before long")
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = placed.join(starts, "part").select(*columns, F.when(rank <= drawn, rank).alias("rank"))
    return ranked.union(scores.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank")))


# CRC-32 in SQL: the bytes' shares, each a power of the step over one bit, joined by place and exclusive-ored.
RESAMPLE_SQL = """
WITH RECURSIVE ir_texts AS (
  SELECT row_number() OVER () AS r, doc_id, 1 AS corpus, text FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, 0, text FROM benchmark),
ir_words AS (
  SELECT r, doc_id, corpus, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM ir_texts),
ir_single AS (SELECT r, doc_id, corpus, len(w) AS n, unnest(w) AS w1, unnest(range(1, len(w) + 1)) AS i FROM ir_words),
ir_runs AS (
  SELECT r, doc_id, corpus, w1, lead(w1) OVER (PARTITION BY r ORDER BY i) AS w2, lead(w1, 2) OVER (PARTITION BY r ORDER BY i) AS w3 FROM ir_single),
ir_features AS (
  SELECT r, corpus, w1 AS f FROM ir_runs
  UNION ALL SELECT r, corpus, w1 || ' ' || w2 FROM ir_runs WHERE w2 IS NOT NULL
  UNION ALL SELECT r, corpus, w1 || ' ' || w2 || ' ' || w3 FROM ir_runs WHERE w3 IS NOT NULL),
ir_counts AS (SELECT r, corpus, f, count(*) AS n FROM ir_features GROUP BY ALL),
ir_names AS (SELECT f, hex(encode(f)) AS h, octet_length(encode(f)) AS n FROM (SELECT DISTINCT f FROM ir_counts)),
ir_bits(k, b, c) AS (
  SELECT 0, b, CASE WHEN b < 256 THEN b ELSE 4294967295 END FROM range(0, 257) t(b)
  UNION ALL
  SELECT k + 1, b, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) FROM ir_bits WHERE k < 8 * (SELECT max(n) FROM ir_names)),
ir_shares AS (SELECT k // 8 AS d, b, c FROM ir_bits WHERE k % 8 = 0),
ir_bytes AS (SELECT f, n, unnest(range(1, n + 1)) AS i, h FROM ir_names),
ir_crc AS (
  SELECT y.f, xor(bit_xor(s.c), any_value(xor(z.c, 4294967295))) % 10000 AS bucket
  FROM ir_bytes y JOIN ir_shares s ON s.d = y.n - y.i + 1 AND s.b = CAST('0x' || substr(y.h, 2 * y.i - 1, 2) AS BIGINT)
  JOIN ir_shares z ON z.b = 256 AND z.d = y.n GROUP BY y.f),
ir_buckets AS (
  SELECT b.bucket, CAST(coalesce(sum(n) FILTER (WHERE corpus = 1), 0) AS BIGINT) AS s, CAST(coalesce(sum(n) FILTER (WHERE corpus = 0), 0) AS BIGINT) AS t
  FROM range(0, 10000) b(bucket) LEFT JOIN ir_crc c ON c.bucket = b.bucket LEFT JOIN ir_counts n ON n.f = c.f GROUP BY b.bucket),
ir_gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (sum(s) OVER () + 10000) AS DOUBLE) / CAST((s + 1) * (sum(t) OVER () + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM ir_buckets),
ir_weights AS (SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM ir_counts JOIN ir_crc USING (f) JOIN ir_gains USING (bucket) GROUP BY r),
ir_scores AS (
  SELECT w.doc_id, len(w.w) >= 20 AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(w.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM ir_words w LEFT JOIN ir_weights x ON x.r = w.r WHERE corpus = 1),
ir_ranks AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS place, count(*) FILTER (WHERE able) OVER () AS n FROM ir_scores)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 5 * n // 100 THEN place END AS rank FROM ir_ranks"""
