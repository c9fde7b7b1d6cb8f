"""How quality filters act together: what each removes in every order they could run in.

A document's failures pick one 32-bit word: bit S is set if the document survives
the subset S of the filters.  Carry-save positional popcounts over these words give
the survivors of all subsets per part and label, and those counts answer every
question about every order; no order is ever run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import map_columns
from larder.operators.joins import lookup_join
from larder.session import scratch_path

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)  # one bit each of a 32-bit word
BUFFER = 1 << 17  # words counted at once
PROFILE = "doc_id long, part string, fails int, digest binary"
REPORT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


# --- the words ----------------------------------------------------------------


def survival_words() -> np.ndarray:
    """By set of failed filters: the word whose bit S says that no filter of S is among them."""
    failed, subset = np.arange(SUBSETS, dtype=np.uint32)[:, None], np.arange(SUBSETS, dtype=np.uint32)
    return np.bitwise_or.reduce(((failed & subset) == 0).astype(np.uint32) << subset, axis=1)


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of ``words`` have each of the 32 bits set.

    Three words of one weight become a sum word of that weight and a carry word of
    twice the weight, until at most two words of each weight are left.
    """
    counts, weight = np.zeros(SUBSETS, np.int64), 0
    while len(words):
        carries = []
        while len(words) >= 3:
            n = len(words) // 3
            a, b, c = words[:n], words[n : 2 * n], words[2 * n : 3 * n]
            odd = a ^ b
            carries.append((a & b) | (odd & c))
            words = np.concatenate([odd ^ c, words[3 * n :]])
        for word in words:
            counts += ((word >> np.arange(SUBSETS, dtype=np.uint32)) & 1).astype(np.int64) << weight
        words = np.concatenate(carries) if carries else words[:0]
        weight += 1
    return counts


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: survivors of every subset by (part, good, toxic)."""
    table = survival_words()

    def counted(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        parts = rows.column("part").combine_chunks().dictionary_encode()
        good, toxic = (rows.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("good", "toxic"))
        cell = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 4 + good * 2 + toxic
        order = np.argsort(cell, kind="stable")
        words = table[rows.column("fails").to_numpy()[order]]
        cells, starts = np.unique(cell[order], return_index=True)
        names = parts.dictionary.to_pylist()
        return pa.RecordBatch.from_arrays(
            [
                pa.array([names[c // 4] for c in cells], pa.string()),
                pa.array(cells & 2 > 0), pa.array(cells & 1 > 0),
                pa.array([positional_counts(w) for w in np.split(words, starts[1:])], pa.list_(pa.int64())),
            ],
            names=["part", "good", "toxic", "survivors"],
        )

    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BUFFER:
            yield counted(held)
            held, n = [], 0
    if n:
        yield counted(held)


# --- the report ---------------------------------------------------------------


def _report(batch: pa.RecordBatch) -> dict:
    """All orders and steps of the parts in a batch, from the survivors of the subsets."""
    k, full = len(FILTERS), SUBSETS - 1
    out = {name.split()[0]: [] for name in REPORT.split(", ")}
    for row in batch.to_pylist():
        alive, good, toxic = (np.array(row[name]) for name in ("alive", "good", "toxic"))
        shapley = [
            sum(
                factorial(s.bit_count()) * factorial(k - 1 - s.bit_count()) * int(alive[s] - alive[s | 1 << f])
                for s in range(SUBSETS) if not s >> f & 1
            )
            for f in range(k)
        ]
        for order in permutations(range(k)):
            before = 0
            for step, f in enumerate(order, 1):
                after = before | 1 << f
                removed = int(alive[before] - alive[after])
                values = (
                    row["part"], "".join(FILTERS[i] for i in order), step, int(alive[after]), removed,
                    int(alive[0] - alive[1 << f]) - removed, int(alive[full ^ 1 << f] - alive[full]),
                    int(good[before] - good[after]), int(toxic[before] - toxic[after]), shapley[f],
                )
                for column, value in zip(out.values(), values):
                    column.append(value)
                before = after
    return out


def audit(flags: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from ``flags(part, fails, good, toxic)``.

    Bit i of ``fails`` says that the document fails filter i; ``good`` and ``toxic``
    are booleans.  What leaves a task is 32 counts per part and label.  A part
    without documents cannot appear, so an empty table gives no rows.
    """
    cells = flags.select("part", "fails", "good", "toxic").mapInArrow(
        _count_batches, "part string, good boolean, toxic boolean, survivors array<long>"
    )
    subsets = cells.select("part", "good", "toxic", F.posexplode("survivors").alias("subset", "n")).groupBy("part", "subset").agg(
        F.sum("n").alias("alive"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("subset", "alive", "good", "toxic")))
    parts = subsets.groupBy("part").agg(ordered.alias("s")).select("part", "s.alive", "s.good", "s.toxic")
    return map_columns(parts, _report, REPORT)


# --- the five filters ---------------------------------------------------------


def _profile(batch: pa.RecordBatch) -> dict:
    text = pc.fill_null(batch.column("text"), "")
    raw = text.cast(pa.binary()).to_pylist()
    n_words, n_distinct = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64)
    for i, b in enumerate(raw):
        words = b.split()  # on the six ASCII white-space bytes
        n_words[i], n_distinct[i] = len(words), len(set(words))
    capitals = pc.count_substring_regex(text, "[A-Z]").to_numpy(zero_copy_only=False).astype(np.int64)
    points = pc.utf8_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    marks = pc.match_substring_regex(text, "[#$%&*|]").to_numpy(zero_copy_only=False)
    fails = (n_words < 100) + 2 * (100 * n_distinct < 80 * n_words) + 4 * (100 * capitals > 10 * points) + 8 * marks
    return {
        "doc_id": batch.column("doc_id"), "part": batch.column("part"), "fails": fails,
        "digest": [hashlib.sha256(b).digest() for b in raw],
    }


def flagged(docs: DataFrame, labels: DataFrame, part: str = "lang", key: str = "doc_id", text: str = "text") -> DataFrame:
    """``part, fails, good, toxic`` of every row of ``docs`` under the five filters.

    A: under 100 words; B: under 80 distinct in 100 words; C: over 10 capitals A-Z
    in 100 characters; D: any of ``#$%&*|``; E: a smaller id has the same text.
    Null texts are empty, null parts the empty string.  Rows of one id and text are
    no copies of each other; a row without an id is no copy and has no label; labels
    without an id count for nothing, and of several for one id any 1 counts.  Other
    columns of either table are not looked at.

    Texts are read once, into one short stored row each.  The first id of a text is
    met by (text digest, id), so that however many rows hold a text, they do not
    meet in one task.
    """
    path = scratch_path(docs.sparkSession, "audit-profile")
    short = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text")
    )
    map_columns(short, _profile, PROFILE).write.parquet(path)
    profile = docs.sparkSession.read.parquet(path)
    marks = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    firsts = profile.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    joined = lookup_join(profile, marks, "doc_id", "doc_id", ["good", "toxic"], "").join(firsts, ["digest", "doc_id"], "left")
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return joined.select(
        "part", (F.col("fails") + F.when(copy, 16).otherwise(0)).cast("int").alias("fails"),
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``audit`` of the five filters over ``docs``, by ``lang``."""
    return audit(flagged(docs, labels))


AUDIT_SQL = """
WITH RECURSIVE fa_words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
fa_firsts AS (SELECT text, min(doc_id) AS first_id FROM fa_words GROUP BY text),
fa_flags AS (
  SELECT w.part,
    [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
     100 * len(regexp_extract_all(w.text, '[A-Z]')) > 10 * length(w.text), regexp_matches(w.text, '[#$%&*|]'),
     coalesce(f.first_id < w.doc_id, false)] AS fails,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND l.quality = 1) AS good,
    EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = w.doc_id AND l.toxic = 1) AS toxic
  FROM fa_words w LEFT JOIN fa_firsts f ON f.text = w.text),
fa_kinds AS (SELECT part, fails, good, toxic, count(*) AS n FROM fa_flags GROUP BY ALL),
fa_orders(o) AS (
  SELECT '' UNION ALL
  SELECT o || f.f FROM fa_orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) f(f) WHERE NOT contains(o, f.f)),
fa_steps AS (
  SELECT o AS filter_order, CAST(s AS INTEGER) AS step,
    list_transform(range(1, s), lambda i: ascii(o[i]) - 64) AS earlier, ascii(o[s]) - 64 AS f
  FROM fa_orders, range(1, 6) t(s) WHERE length(o) = 5),
fa_runs AS (
  SELECT k.part, s.filter_order, s.step, s.f, k.n, k.good, k.toxic, k.fails[s.f] AS failing,
    len(list_filter(s.earlier, lambda i: k.fails[i])) > 0 AS gone, len(list_filter(k.fails, lambda x: x)) AS n_fails
  FROM fa_kinds k, fa_steps s),
fa_rows AS (
  SELECT part, filter_order, step, f, CAST(sum(if(NOT gone AND NOT failing, n, 0)) AS BIGINT) AS kept,
    CAST(sum(if(NOT gone AND failing, n, 0)) AS BIGINT) AS removed, CAST(sum(if(gone AND failing, n, 0)) AS BIGINT) AS redundant,
    CAST(sum(if(failing AND n_fails = 1, n, 0)) AS BIGINT) AS unique_fails,
    CAST(sum(if(NOT gone AND failing AND good, n, 0)) AS BIGINT) AS good_lost,
    CAST(sum(if(NOT gone AND failing AND toxic, n, 0)) AS BIGINT) AS toxic_lost
  FROM fa_runs GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM fa_rows"""
