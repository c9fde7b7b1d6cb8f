"""Benchmark decontamination: rare word n-grams find the place, local alignment scores the copy.

A passage that was edited or partly reworded still shares some n-grams with its
item.  One of them makes a candidate; how rare its n-grams are in the whole corpus
only says which candidate is tried first.  Smith-Waterman alignment of words around
the seeds then tells how much of the item is there, whatever was changed, put in or
left out; it is skipped only where no alignment could reach the score.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import map_columns

SEED_WORDS = 3
SCORE = 0.5  # alignment score over the item's own, from which a text counts as contaminated
MATCH, MISMATCH, GAP = 2, -1, -1
BLOCK_BYTES = 32 << 20  # of benchmark text searched in one pass over the corpus

# ASCII that is neither letter nor digit parts words.
_TABLE = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_TABLE).split()


def seeds_of(words: list[bytes]) -> Iterator[tuple]:
    return zip(*(words[k:] for k in range(SEED_WORDS)))


def align(item: list[bytes], window: list[bytes]) -> tuple[int, int, int, int]:
    """Best local alignment: score, matched words, and the stretch of ``window`` it covers."""
    best = (0, 0, 0, 0)
    score = [0] * (len(window) + 1)
    start, hits = list(range(len(window) + 1)), [0] * (len(window) + 1)
    for word in item:
        diagonal, diagonal_start, diagonal_hits = 0, 0, 0
        left, left_start, left_hits = 0, 0, 0
        for j, other in enumerate(window, 1):
            same = word == other
            s, at, n = diagonal + (MATCH if same else MISMATCH), diagonal_start, diagonal_hits + same
            if score[j] + GAP > s:
                s, at, n = score[j] + GAP, start[j], hits[j]
            if left + GAP > s:
                s, at, n = left + GAP, left_start, left_hits
            if s <= 0:
                s, at, n = 0, j, 0
            diagonal, diagonal_start, diagonal_hits = score[j], start[j], hits[j]
            score[j], start[j], hits[j] = left, left_start, left_hits = s, at, n
            if s > best[0]:
                best = (s, n, at, j)
    return best


def reach(words: list[bytes], others: list[bytes]) -> int:
    """A bound on the score of any alignment: each word of a stretch matches at most, or costs a change."""
    there, best, run = set(others), 0, 0
    for word in words:
        run = run + MATCH if word in there else max(0, run + max(MISMATCH, GAP))
        best = max(best, run)
    return best


class Index:
    """Seeds of one block of items."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids = [item_id for item_id, _ in items]
        self.items = [words_of(text) for _, text in items]
        self.owners: dict[tuple, list[int]] = defaultdict(list)
        for k, words in enumerate(self.items):
            for seed in set(seeds_of(words)):
                self.owners[seed].append(k)
        self.names = {seed: n for n, seed in enumerate(self.owners)}
        self.seeds = frozenset(self.owners)

    def weigh(self, found_in: dict[int, int], n_docs: int) -> None:
        """Weight of a seed: log of corpus size over the number of texts that hold it."""
        self.weight = {s: math.log((n_docs + 2) / (found_in.get(n, 0) + 1)) for s, n in self.names.items()}

    def matches(self, text: str | None) -> Iterator[tuple]:
        """(item, score share, matched words, first word, end word) of one text, the rarest seeds first."""
        words = words_of(text)
        hits = self.seeds.intersection(seeds_of(words))
        if not hits:
            return
        weight: dict[int, float] = defaultdict(float)
        for seed in hits:
            for k in self.owners[seed]:
                weight[k] += self.weight[seed]
        places: dict[int, list[int]] = defaultdict(list)
        for at, seed in enumerate(seeds_of(words)):
            if seed in hits:
                for k in self.owners[seed]:
                    places[k].append(at)
        for k in sorted(weight, key=lambda k: (-weight[k], k)):
            item, best = self.items[k], (0, 0, 0, 0)
            whole = MATCH * len(item)
            for first, last in _stretches(places[k], len(item)):
                # An alignment of this score has fewer words put in than the item has words.
                low = max(0, first - 2 * len(item))
                window = words[low : last + SEED_WORDS + 2 * len(item)]
                if min(reach(item, window), reach(window, item)) < SCORE * whole:
                    continue
                s, n, start, end = align(item, window)
                best = max(best, (s, n, -(low + start), low + end))
            share = best[0] / whole
            if share >= SCORE:
                yield self.ids[k], share, best[1], -best[2], best[3]


def _stretches(places: list[int], reach: int) -> Iterator[tuple[int, int]]:
    """Runs of seed places that one copy of the item could hold together."""
    first = last = places[0]
    for at in places[1:]:
        if at - last > reach:
            yield first, last
            first = at
        last = at
    yield first, last


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    block, size = [], 0
    rows = benchmark.where("text is not null").select("item_id", "text").distinct().orderBy("item_id", "text")
    for row in rows.toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def _indexes(texts: DataFrame, benchmark: DataFrame, block_bytes: int):
    """Weighed indexes of the benchmark's blocks, as broadcast variables."""
    context = texts.sparkSession.sparkContext
    for block in _blocks(benchmark, block_bytes):
        index = Index(block)
        if not index.seeds:
            continue
        shared = context.broadcast((index.seeds, index.names))

        def count(batch) -> dict:
            seeds, names = shared.value
            counts: dict[int, int] = defaultdict(int)
            for text in batch.column(0).to_pylist():
                for seed in seeds.intersection(seeds_of(words_of(text))):
                    counts[names[seed]] += 1
            # The entry -1 counts the texts themselves.
            return {"seed": [-1, *counts], "n": [batch.num_rows, *counts.values()]}

        counted = map_columns(texts.select("text"), count, "seed int, n long").groupBy("seed").agg(F.sum("n").alias("n"))
        found_in = {r["seed"]: r["n"] for r in counted.collect()}  # one number per seed of the block
        index.weigh(found_in, found_in.pop(-1, 0))
        yield context.broadcast(index)


def contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs`` and item found in it:
    ``doc_id, item_id, score, n_matched, first_word, end_word``.

    ``score`` is the best alignment's over that of the item with itself.  The
    benchmark travels to the executors in blocks of at most ``block_bytes``; each
    block takes two narrow passes over the texts, one to count its seeds and one
    to align.  Nothing but seed counts is shuffled.  A copy is found if it has three
    words in a row as the item has them, however many texts hold them.  Items of fewer than three
    words and null texts take no part; every text under one item id is an item of its
    own, and so are those without an id, reported with a null one; repeated items
    count once; repeated rows of ``docs`` are reported as often as they occur, null
    ids with a null id.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, score double, n_matched int, first_word long, end_word long"
    found = docs.sparkSession.createDataFrame([], schema)
    for index in _indexes(texts, benchmark, block_bytes):

        def search(batch, index=index) -> dict:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += [(doc_id, *m) for m in index.value.matches(text)]
            names = ("doc_id", "item_id", "score", "n_matched", "first_word", "end_word")
            return {name: [r[k] for r in rows] for k, name in enumerate(names)}

        found = found.unionByName(map_columns(texts, search, schema))
    return found


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item of the benchmark."""
    place = docs.columns.index("text")
    left = docs
    for index in _indexes(docs, benchmark, block_bytes):

        def run(batches, index=index):
            for batch in batches:
                yield batch.filter(pa.array([next(index.value.matches(t), None) is None for t in batch.column(place).to_pylist()], pa.bool_()))

        left = left.mapInArrow(run, docs.schema)
    return left
