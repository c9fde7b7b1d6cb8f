"""Personal data: fixed patterns, widened by a skip-chain conditional random field.

The patterns find what is written in full.  The field labels every token with a
digit or an at sign (and tokens that repeat a found one): local weights are
learned from the patterns' own finds over the whole corpus, neighbours share
chain potentials, and equal or similar tokens of a document, however far apart,
share skip potentials: every repeat with all found tokens like it, and with the
next repeat.  Loopy message passing, until it settles, carries a sure label to the
shortened or broken repeats that the patterns miss.  Found spans always stay.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import map_columns

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
SURE = 0.6  # probability from which a token's label makes a span
LOCAL_LIMIT = 4.0  # of a token's own log-odds, so that its repeats can outweigh them
SAME_TOKEN = 6.0  # skip potential of tokens with the same digits, name or letters
DAMPING, SETTLED = 0.3, 1e-4  # a message that moves less has settled
COOLING = 0.95  # of the steps' length once every label could have come through, so that swinging messages end too

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Digit runs are taken whole, so a failed start is not tried again inside one.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S+")
_EDGE = ".,;:!?\"'()[]{}<>|*#"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all pattern finds, by start, then kind."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end(), "email"))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        d = _digits(m.group()) if m.end() - m.start() <= 40 else ""
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


# --- tokens and their features ------------------------------------------------


class Tokens:
    """The labelled tokens of a text: places, words around them, observed labels, keys of likeness."""

    def __init__(self, text: str, base: list[tuple[int, int, str]]):
        found = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
        names = set()
        for start, end, kind in base:
            if kind == "email":
                names.add(_letters(text[start:end].split("@")[0]))
        self.places, self.words, self.before, self.after, self.index = [], [], [], [], []
        for k, (start, end) in enumerate(found):
            word = text[start:end]
            if not _TRIGGER.search(word) and (len(word) < 4 or _letters(word) not in names):
                continue
            trimmed = word.strip(_EDGE) or word
            shift = word.find(trimmed)
            self.places.append((start + shift, start + shift + len(trimmed)))
            self.words.append(word)
            self.before.append(text[slice(*found[k - 1])] if k else "")
            self.after.append(text[slice(*found[k + 1])] if k + 1 < len(found) else "")
            self.index.append(k)
        self.observed = [0] * len(self.places)
        self.touched = [False] * len(self.places)
        spot = 0
        for start, end, kind in base:
            while spot < len(self.places) and self.places[spot][1] <= start:
                spot += 1
            k = spot
            while k < len(self.places) and self.places[k][0] < end:
                self.observed[k], self.touched[k] = LABELS.index(kind), True
                k += 1

    def features(self, k: int) -> tuple[str, ...]:
        word, before, after = self.words[k], self.before[k], self.after[k]
        d = _digits(word)
        parts = word.strip(_EDGE).split(".")
        quad = len(parts) == 4 and all(p.isdecimal() and p.isascii() and len(p) <= 3 and int(p) <= 255 for p in parts)
        return (
            f"at{'@' in word}", f"letters{any(c.isalpha() for c in word)}", f"digits{min(int(len(d) ** 0.5 * 2), 12)}",
            f"dots{min(word.count('.'), 4)}", f"plus{word[:1] == '+'}", f"open{word[:1] == '('}", f"dash{'-' in word}", f"is{'=' in word}",
            f"quad{quad}", f"luhn{12 <= len(d) <= 19 and luhn(d)}", f"after+{before[:1] == '+'}", f"after({before[:1] == '('}",
            f"then({after[:1] == '('}", f"thendigit{after[:1].isdigit()}",
        )

    def pairs(self) -> list[tuple[int, int, bool]]:
        """(a, b, skip): neighbours, and each token not found by a pattern with the next such one like it."""
        out = [(k - 1, k, False) for k in range(1, len(self.index)) if self.index[k] == self.index[k - 1] + 1]
        last: dict[tuple, int] = {}
        for k, word in enumerate(self.words):
            if self.touched[k]:
                continue
            for key in _keys(word):
                if key in last and last[key] != k:
                    out.append((last[key], k, True))
                last[key] = k
        return list(dict.fromkeys(out))

    def found_alike(self) -> np.ndarray:
        """How many found tokens of each label are like each token: a found label is sure, so
        the links to all of them are one sum.  Of a token's keys the one with most counts."""
        found: dict[tuple, np.ndarray] = {}
        for k, word in enumerate(self.words):
            if self.touched[k]:
                for key in _keys(word):
                    found.setdefault(key, np.zeros(len(LABELS)))[self.observed[k]] += 1
        out = np.zeros((len(self.words), len(LABELS)))
        for k, word in enumerate(self.words):
            if found and not self.touched[k]:
                for key in _keys(word):
                    if key in found:
                        out[k] = np.maximum(out[k], found[key])
        return out


def _letters(word: str) -> str:
    return "".join(c for c in word.lower() if c.isalnum())


def _keys(word: str) -> list[tuple]:
    """Tokens with a key in common are alike."""
    keys = []
    if len(letters := _letters(word)) >= 5:
        keys.append(("letters", letters))
    if "@" in word and len(name := _letters(word.split("@")[0])) >= 4:
        keys.append(("letters", name))
    if len(d := _digits(word)) >= 7:
        keys += [("digits", d[-10:]), ("digits", d[-7:])]
    return list(dict.fromkeys(keys))


# --- the field ----------------------------------------------------------------


class Field:
    """Local weights by feature, chain potentials, and the skip potential of merely similar tokens."""

    def __init__(self, weights: dict[str, np.ndarray], chain: np.ndarray):
        self.weights, self.chain = weights, chain

    def local(self, features: tuple[str, ...]) -> np.ndarray:
        zero = np.zeros(len(LABELS))
        total = sum((self.weights.get(f, zero) for f in features), self.weights.get("", zero))
        total = total - total.max()
        return np.maximum(total, -LOCAL_LIMIT)

    def label(self, tokens: Tokens) -> np.ndarray:
        """Label probabilities of every token, by damped message passing."""
        n, k = len(tokens.places), len(LABELS)
        local = np.array([self.local(tokens.features(i)) for i in range(n)]) + SAME_TOKEN * tokens.found_alike()
        for i, seen in enumerate(tokens.touched):
            if seen:
                local[i] = -np.inf
                local[i, tokens.observed[i]] = 0.0
        pairs = tokens.pairs()
        if not pairs:
            return _normal(local)
        a = np.array([p[0] for p in pairs])
        b = np.array([p[1] for p in pairs])
        skip = SAME_TOKEN * np.eye(k)
        potential = np.array([skip if p[2] else self.chain for p in pairs])
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        joint = np.concatenate([potential, potential.transpose(0, 2, 1)])  # [message, from, to]
        back = np.concatenate([np.arange(len(a), 2 * len(a)), np.arange(len(a))])
        messages = np.zeros((len(source), k))
        belief = local.copy()
        live, length, step = np.ones(n, bool), 1 - DAMPING, 0
        # Only tokens around a message that moved send again.
        while live.any():
            sent = np.flatnonzero(live[source])
            out = (belief[source[sent]] - messages[back[sent]])[:, :, None] + joint[sent]
            top = out.max(axis=1)
            new = np.log(np.exp(out - top[:, None]).sum(axis=1)) + top
            new -= new.max(axis=1, keepdims=True)
            move = length * (new - messages[sent])
            messages[sent] += move
            np.add.at(belief, target[sent], move)
            moved = sent[np.abs(move).max(axis=1) > SETTLED]
            live[:] = False
            live[source[moved]] = live[target[moved]] = True
            step += 1
            if step > 100 + n:
                length *= COOLING
        return _normal(belief)


def _normal(scores: np.ndarray) -> np.ndarray:
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def train(docs: DataFrame) -> Field:
    """Weights from the patterns' finds in all texts.

    Spark counts how often each combination of features goes with each label;
    the combinations are few, as every feature has few values.
    """

    def count(batch) -> dict:
        seen: Counter = Counter()
        for text in batch.column(0).to_pylist():
            if not text or not _TRIGGER.search(text):
                continue
            tokens = Tokens(text, base_spans(text))
            for k in range(len(tokens.places)):
                seen["|".join(tokens.features(k)), tokens.observed[k]] += 1
            for i, j, skip in tokens.pairs():
                if not skip:
                    seen[f"chain{tokens.observed[i]}", tokens.observed[j]] += 1
        return {"what": [w for w, _ in seen], "label": [x for _, x in seen], "n": list(seen.values())}

    counted = map_columns(docs.select("text"), count, "what string, label int, n long")
    rows = counted.groupBy("what", "label").agg(F.sum("n").alias("n")).collect()
    chain = np.ones((len(LABELS), len(LABELS)))
    local: dict[str, np.ndarray] = {}
    for r in rows:
        if r["what"].startswith("chain"):
            chain[int(r["what"][5:]), r["label"]] += r["n"]
        else:
            local.setdefault(r["what"], np.zeros(len(LABELS)))[r["label"]] += r["n"]
    expected = chain.sum(1, keepdims=True) * chain.sum(0, keepdims=True) / chain.sum()
    return Field(_fit(local), np.clip(np.log(chain / expected), -1.0, 1.0))


def _fit(local: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Multinomial logistic regression on counted feature combinations, by gradient steps."""
    names = sorted({f for what in local for f in what.split("|")})
    place = {f: k for k, f in enumerate(names)}
    what = sorted(local)
    x = np.zeros((len(what), len(names) + 1))
    for row, w in enumerate(what):
        x[row, [place[f] for f in w.split("|")]] = 1
    x[:, -1] = 1
    y = np.array([local[w] for w in what]).reshape(len(what), len(LABELS))
    y = y / max(1.0, y.sum())
    w = np.zeros((x.shape[1], len(LABELS)))
    speed = np.zeros_like(w)
    for _ in range(1500):
        gradient = x.T @ (y - y.sum(1, keepdims=True) * _normal(x @ w)) - 1e-4 * w
        speed = 0.9 * speed + 0.5 * gradient
        w = w + speed
    return {**{f: w[k] for f, k in place.items()}, "": w[-1]}


def find(text: str | None, field: Field) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The patterns' spans, and all spans with those the field adds."""
    if not text or not _TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    tokens = Tokens(text, base)
    if all(tokens.touched):
        return base, base
    sure = field.label(tokens)
    added: list[list] = []
    for k, p in enumerate(sure):
        label = int(np.argmax(p))
        if tokens.touched[k] or not label or p[label] < SURE:
            continue
        start, end = tokens.places[k]
        if added and added[-1][3] == tokens.index[k] - 1 and added[-1][2] == LABELS[label]:
            added[-1][1], added[-1][3] = end, tokens.index[k]
        else:
            added.append([start, end, LABELS[label], tokens.index[k]])
    both = base + [(s, e, kind) for s, e, kind, _ in added]
    return base, sorted(both, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` per row, over whole texts.

    Counts and digest are those of the patterns; ``spans`` also has what the
    field adds.  Null and empty texts have no spans; repeated rows and null ids
    are treated row by row; other columns are not read.
    """

    def run(batch) -> dict:
        out: dict = {c: [] for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
        for text in batch.column(1).to_pylist():
            base, spans = find(text, field)
            counts = Counter(s[2] for s in base)
            for kind in KINDS:
                out[f"n_{kind}"].append(counts[kind])
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(spans))
        return {"doc_id": batch.column(0), **out}

    return map_columns(
        docs.select(F.col("doc_id").cast("long"), "text"), run,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    )
