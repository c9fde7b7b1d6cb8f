"""Token counts from a transducer compiled on demand.

A piece vocabulary never merges across the step from a word to the space mark
after it, nor across a character that only exists as raw bytes (a line feed).
So the tokenizer is a transducer over *segments* (text between two such steps):
one boundary state, and from it one transition per segment, annotated with the
number of tokens it emits.  Transitions are compiled when first met and kept in
a bounded table.

A text is cut into chunks at any place.  The map of a chunk takes the open
segment it is entered with to the open segment it leaves, and emits tokens in
between; it is known from (head, tokens, tail) alone.  Maps compose
associatively, so those of a text are combined by a parallel prefix scan.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

from pyspark.sql import DataFrame

from larder.llm.common import Memo, map_columns

CHUNK = 1 << 15  # characters
CACHED_SEGMENTS = 400_000  # per worker, twice
SPACE_MARK = "▁"


class Transitions(Memo):
    """Tokens emitted from the boundary state, by segment.

    A segment is a word with the one space before it left out; a line feed opens
    a segment that has no space before.
    """

    def __init__(self, path: str):
        import sentencepiece

        super().__init__(CACHED_SEGMENTS)
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        vocabulary = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        inside = [p for p in vocabulary if SPACE_MARK in p.lstrip(SPACE_MARK) or "\n" in p]
        if inside:
            raise ValueError("pieces cross segments")

    def make(self, segment: str) -> int:
        # The model puts one space mark before every input.  A line feed never
        # joins it, so for such a segment the mark is a token of its own.
        return len(self.model.encode(segment, num_threads=1)) - segment.startswith("\n")

    def spaces(self, n: int) -> int:
        """Tokens of a run of ``n`` spaces with nothing that could join it."""
        return len(self.model.encode(" " * (n - 1), num_threads=1)) if n > 1 else 1


class ChunkMap(NamedTuple):
    """``head`` completes the segment left open before; ``tail`` stays open.

    Without a boundary inside (``closed`` false) the chunk only lengthens the
    open segment, and is all head.
    """

    head: str
    tokens: int
    tail: str
    closed: bool


def _segments(text: str) -> list[str]:
    return text.replace("\n", " \n").split(" ")


def _emitted(table: Transitions, segments: list[str]) -> int:
    """Tokens of whole segments; empty ones are spaces that go before the next word."""
    if "" not in segments:
        return sum(map(table.__getitem__, segments))
    total, run = 0, 0
    for segment in segments:
        if segment == "":
            run += 1
        elif segment[0] == "\n":
            total += table[segment] + (table.spaces(run) if run else 0)
            run = 0
        else:
            total += table[" " * run + segment] if run else table[segment]
            run = 0
    return total + (table.spaces(run) if run else 0)


def chunk_map(table: Transitions, chunk: str) -> ChunkMap:
    """A boundary lies before a space or line feed that follows another character."""
    first = _boundary(chunk)
    if first < 0:
        return ChunkMap(chunk, 0, "", False)
    last = _last_boundary(chunk)
    inner = chunk[first:last]
    return ChunkMap(chunk[:first], _count(table, inner) if inner else 0, chunk[last:], True)


def _boundary(chunk: str) -> int:
    at = 1
    while at < len(chunk):
        spots = [k for k in (chunk.find(" ", at), chunk.find("\n", at)) if k >= 0]
        if not spots:
            return -1
        at = min(spots)
        if chunk[at - 1] not in " \n":
            return at
        at += 1
    return -1


def _last_boundary(chunk: str) -> int:
    at = len(chunk)
    while at > 0:
        at = max(chunk.rfind(" ", 0, at), chunk.rfind("\n", 0, at))
        if at > 0 and chunk[at - 1] not in " \n":
            return at
    return -1


def _count(table: Transitions, run: str) -> int:
    """Tokens of text that begins and ends at boundaries: its first space opens the first segment."""
    segments = _segments(run)
    return _emitted(table, segments[1:] if segments[0] == "" else segments)


def compose(table: Transitions, a: ChunkMap, b: ChunkMap) -> ChunkMap:
    """First ``a``, then ``b``."""
    if not b.closed:
        b_open = a.tail + b.head if a.closed else a.head + b.head
        joined = chunk_map(table, b_open)
        if not a.closed:
            return joined
        return ChunkMap(a.head, a.tokens, b_open, True) if not joined.closed else _close(table, a, joined)
    if not a.closed:
        return _open(table, a.head + b.head, b)
    return _close(table, a, _open(table, a.tail + b.head, b))


def _open(table: Transitions, head: str, b: ChunkMap) -> ChunkMap:
    """``b`` behind a longer head, which may hold boundaries of its own now."""
    joined = chunk_map(table, head)
    if not joined.closed:
        return ChunkMap(head, b.tokens, b.tail, True)
    return ChunkMap(joined.head, joined.tokens + _count(table, joined.tail) + b.tokens, b.tail, True)


def _close(table: Transitions, a: ChunkMap, middle: ChunkMap) -> ChunkMap:
    """``middle`` begins where the open segment of ``a`` began."""
    if not middle.closed:
        return ChunkMap(a.head, a.tokens, middle.head, True)
    return ChunkMap(a.head, a.tokens + (_count(table, middle.head) if middle.head else 0) + middle.tokens, middle.tail, True)


def prefix_scan(table: Transitions, maps: list[ChunkMap]) -> list[ChunkMap]:
    """All running compositions, in a logarithmic number of rounds of independent steps."""
    step = 1
    while step < len(maps):
        maps = maps[:step] + [compose(table, maps[k - step], maps[k]) for k in range(step, len(maps))]
        step *= 2
    return maps


def count_text(table: Transitions, text: str, chunk: int = CHUNK) -> int:
    """Exactly ``len(model.encode(text))``."""
    if not text:
        return 0
    text = text.replace(SPACE_MARK, " ")  # the model reads both alike
    if len(text) <= chunk:
        return _emitted(table, _segments(text) if text[0] != "\n" else ["", *_segments(text)[1:]])
    maps = [chunk_map(table, text[k : k + chunk]) for k in range(0, len(text), chunk)]
    whole = functools.reduce(functools.partial(compose, table), maps[1:], maps[0]) if len(maps) < 4 else prefix_scan(table, maps)[-1]
    head = _count(table, " " + whole.head)  # the model's own space mark precedes the text
    return head + (whole.tokens + _count(table, whole.tail) if whole.closed else 0)


@functools.cache
def transitions(path: str) -> Transitions:
    return Transitions(path)


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row of ``docs``, in one narrow pass.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows and null keys
    are counted row by row; other columns are not read.
    """

    def count(batch) -> dict:
        table = transitions(model)
        texts = [t or "" for t in batch.column(1).to_pylist()]
        counts = [count_text(table, t) for t in texts]
        return {
            "doc_id": batch.column(0),
            "n_bytes": [len(t.encode()) for t in texts],
            "n_tokens": counts,
            "over_limit": [n > limit for n in counts],
        }

    return map_columns(docs.select(key, text), count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
