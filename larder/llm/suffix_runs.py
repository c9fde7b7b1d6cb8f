"""Sorted runs of text suffixes, front coded, and their merge by a loser tree.

A run is kept as a matrix of 8-byte big-endian words, so that numbers compare as
the bytes do.  Rows are zero padded and end in a length byte, so different
strings never look alike.
"""

from __future__ import annotations

import numpy as np

WIDTH = 56  # bytes of a row: 50 of text at most, padding, length
WORDS = WIDTH // 8


def sort_rows(words: list[np.ndarray]) -> np.ndarray:
    """The order of rows given as columns of words; later columns only break ties."""
    order = np.argsort(words[0], kind="stable")
    first = words[0][order]
    same = first[1:] == first[:-1]
    for column in words[1:]:
        if not same.any():
            break
        tied = np.zeros(len(order), bool)
        tied[1:] |= same
        tied[:-1] |= same
        spots = np.flatnonzero(tied)
        group = np.cumsum(np.concatenate([[True], ~same]))[spots]
        values = column[order[spots]]
        inner = np.lexsort((values, group))
        order[spots] = order[spots][inner]
        values, still = values[inner], same[spots[1:] - 1]
        # Neighbours in ``spots`` of one group stay tied only if this word is equal too.
        equal = (values[1:] == values[:-1]) & (group[1:] == group[:-1]) & still
        same = np.zeros_like(same)
        same[spots[1:][equal] - 1] = True
    return order


def common_bytes(words: list[np.ndarray]) -> np.ndarray:
    """For sorted rows: bytes each row shares with the one before (0 for the first)."""
    n = len(words[0])
    shared = np.zeros(n, np.uint8)
    if n < 2:
        return shared
    open_rows = np.arange(1, n)
    for column in words:
        differ = column[open_rows] ^ column[open_rows - 1]
        found = differ != 0
        rows, bits = open_rows[found], differ[found]
        for k in range(1, 8):
            shared[rows] += bits < np.uint64(1 << (8 * k))
        open_rows = open_rows[~found]
        shared[open_rows] += 8
        if not len(open_rows):
            break
    return shared


def to_bytes(words: list[np.ndarray]) -> np.ndarray:
    """Rows as a matrix of bytes."""
    out = np.empty((len(words[0]), len(words)), ">u8")
    for k, column in enumerate(words):
        out[:, k] = column
    return out.view(np.uint8)


def to_words(rows: np.ndarray) -> list[np.ndarray]:
    wide = np.ascontiguousarray(rows).view(">u8")
    return [wide[:, k].astype(np.uint64) for k in range(wide.shape[1])]


def front_code(rows: np.ndarray, shared: np.ndarray, lengths: np.ndarray) -> bytes:
    """What each row has beyond the bytes shared with the one before."""
    columns = np.arange(rows.shape[1], dtype=np.uint8)[None, :]
    return rows[(columns >= shared[:, None]) & (columns < lengths[:, None])].tobytes()


def front_decode(data: np.ndarray, shared: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """The rows again: a byte that a row shares is taken from the last row that brought its own."""
    n = len(shared)
    rows = np.zeros((n, width), np.uint8)
    columns = np.arange(width, dtype=np.uint8)[None, :]
    own = (columns >= shared[:, None]) & (columns < lengths[:, None])
    rows[own] = data
    index = np.arange(n)
    for c in range(int(shared.max()) if n else 0):
        brings = np.where(shared <= c, index, 0)
        rows[:, c] = rows[np.maximum.accumulate(brings), c]
    rows[columns >= lengths[:, None]] = 0
    return rows


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int]]:
    """Merge sorted runs of (rows, bytes shared with the row before) by a loser tree.

    Returns the run of every row in merged order, and the bytes each row shares
    with the one before.  A node of the tree keeps, with its loser, the bytes the
    loser shares with the last winner.  Of two candidates the one sharing more is
    smaller, without a look at any byte; only if both share equally much are they
    compared, from that byte on.  So no known prefix is compared again.
    """
    k = 1
    while k < max(1, len(runs)):
        k *= 2
    size = [len(r[0]) for r in runs] + [0] * (k - len(runs))
    rows = [r[0] for r in runs] + [[]] * (k - len(runs))
    shares = [r[1] for r in runs] + [[]] * (k - len(runs))
    at = [0] * k
    current: list[bytes | None] = [rows[r][0] if size[r] else None for r in range(k)]
    width = len(next((c for c in current if c is not None), b""))
    loser, loser_shares = [0] * k, [0] * k

    def play(a: int, ha: int, b: int, hb: int) -> tuple[int, int, int, int]:
        """(winner, its shared bytes, loser, its shared bytes), both relative to the last winner;
        a loser met by comparison has the bytes it shares with this winner."""
        x, y = current[a], current[b]
        if y is None:
            return a, ha, b, 0
        if x is None:
            return b, hb, a, 0
        if ha > hb:
            return a, ha, b, hb
        if hb > ha:
            return b, hb, a, ha
        if ha == width:
            return (a, ha, b, width) if a < b else (b, ha, a, width)
        p, q = int.from_bytes(x[ha:], "big"), int.from_bytes(y[ha:], "big")
        if p == q:
            return (a, ha, b, width) if a < b else (b, ha, a, width)
        h = width - ((p ^ q).bit_length() + 7) // 8
        return (a, ha, b, h) if p < q else (b, ha, a, h)

    # First round, from the leaves up; before any winner nothing is shared.
    winners = [(r, 0) for r in range(k)]
    level = k
    while level > 1:
        above = []
        for n in range(0, level, 2):
            (a, ha), (b, hb) = winners[n], winners[n + 1]
            w, hw, x, hx = play(a, ha, b, hb)
            node = level // 2 + n // 2
            loser[node], loser_shares[node] = x, hx
            above.append((w, hw))
        winners, level = above, level // 2
    w, h = winners[0]
    merged, shared = [], []
    put, put_shared = merged.append, shared.append
    for _ in range(sum(size)):
        put(w)
        put_shared(h)
        at[w] = spot = at[w] + 1
        if spot < size[w]:
            current[w], h = rows[w][spot], shares[w][spot]
        else:
            current[w], h = None, 0
        node = (w + k) >> 1
        while node:
            other = loser[node]
            y = current[other]
            if y is not None:
                ho = loser_shares[node]
                x = current[w]
                if x is None or ho > h:  # the waiting row is smaller
                    loser[node], loser_shares[node], w, h = w, h, other, ho
                elif ho == h:
                    w, h, loser[node], loser_shares[node] = play(w, h, other, ho)
            node >>= 1
    return merged, shared
