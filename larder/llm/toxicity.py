"""Toxicity by a support vector machine on gapped subsequences of words.

Two strings are alike by the letter triples they share in order, gaps allowed
and discounted (subsequence string kernel, ``ORDER`` letters, ``DECAY`` per
letter spanned).  The kernel is taken against landmark words (Nystroem), the
machine is linear in that space, and a text scores as its worst word does.
Because the machine is linear, its weights fold into one table over letter
triples, so a word costs one table look-up per triple.
"""

from __future__ import annotations

import re
import unicodedata
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import map_columns
from larder.session import scratch_path

ORDER = 3
DECAY = 0.6
LETTERS = 32
LONGEST = 14  # letters; longer words are read through overlapping windows of that size
TRAIN_ROWS = 8_000  # labelled rows the model is fitted on, smallest hash of the id first
NEGATIVES = 12_000  # words of texts labelled clean, by hash
LANDMARKS = 96
# A word marks toxic text if it is that much commoner there, and often enough
# (the first term of the log-likelihood ratio).
RATIO = 10.0
EXCESS = 30.0
MARKED = 300
STEEPEST = 16.0  # of the calibration: forms unlike those seen stay in doubt
SPOILED = 12  # distorted forms per marked word
CACHED_WORDS = 300_000

# Letters written as other signs; signs that stand for letters here are taken out first.
_FOLD = str.maketrans("013457@$!", "oieastasi", "{|}~\x7f")


def _marked_letters() -> dict[int, str]:
    """Latin letters with a mark are letters of their own, in four classes by the letter below."""
    out = {}
    for k in range(0xC0, 0x250):
        base = unicodedata.normalize("NFKD", chr(k))[0].lower()
        out[k] = {"e": "{", "a": "|", "o": "}"}.get(base, "~")
    return out


_FOLD.update(_marked_letters())
_OTHER = re.compile(r"[^a-z{|}~\x7f]+")
_NOT_ASCII = re.compile(r"[^\x00-\x7f]")
# Letters set apart by white space: "w o r d".
_SPELLED = re.compile(r"(?<!\S)(?:[^\W\d_]\s){3,}[^\W\d_](?!\S)")


def words_of(text: str | None) -> set[str]:
    """The different words of a text as the kernel sees them: folded letters, nothing else."""
    if not text:
        return set()
    text = text.lower()
    words = set(text.split())
    if _SPELLED.search(text):
        words.update("".join(m.group().split()) for m in _SPELLED.finditer(text))
    return words


def letters_of(word: str) -> str:
    """The letters of a word, in ASCII; letters of other scripts are all one letter."""
    word = word.translate(_FOLD)
    if not word.isascii():
        word = _NOT_ASCII.sub("\x7f", word)
    return word if word.isalpha() else _OTHER.sub("", word)


def _windows(letters: str) -> list[str]:
    if len(letters) <= LONGEST:
        return [letters]
    return [letters[k : k + LONGEST] for k in range(0, len(letters) - LONGEST // 2, LONGEST // 2)]


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of letter codes from 1."""
    flat = np.frombuffer("".join(words).encode(), np.uint8).reshape(len(words), -1)
    return (flat - 96).astype(np.int32)


def _self_kernel(codes: np.ndarray) -> np.ndarray:
    """k(x, x) for words of one length: pairs of equal subsequences, by their last letters."""
    n = codes.shape[1]
    same = (codes[:, :, None] == codes[:, None, :]).astype(np.float32) * np.float32(DECAY**2)
    ends = same.copy()
    for _ in range(ORDER - 1):
        upto = ends.copy()
        for i in range(1, n):
            upto[:, i] += DECAY * upto[:, i - 1]
        for j in range(1, n):
            upto[:, :, j] += DECAY * upto[:, :, j - 1]
        ends = np.zeros_like(same)
        ends[:, 1:, 1:] = same[:, 1:, 1:] * upto[:, :-1, :-1]
    return ends.sum(axis=(1, 2))


def _triples(n: int) -> tuple[np.ndarray, np.ndarray]:
    spots = np.array(list(combinations(range(n), ORDER)), np.int64).reshape(-1, ORDER)
    return spots, (DECAY ** (spots[:, -1] - spots[:, 0] + 1)).astype(np.float32)


def _by_length(words: list[str]) -> dict[int, list[int]]:
    groups: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        groups.setdefault(len(word), []).append(k)
    return groups


def _kernel_sums(words: list[str], table: np.ndarray) -> np.ndarray:
    """sum over the triples of each word of their discounted table rows, over the word's own norm."""
    out = np.zeros((len(words), table.shape[1]), np.float32)
    for n, spots in _by_length(words).items():
        if n < ORDER:
            continue
        triples, decay = _triples(n)
        for at in range(0, len(spots), 4096):
            some = spots[at : at + 4096]
            codes = _codes([words[k] for k in some])
            total = np.zeros((len(some), table.shape[1]), np.float32)
            for (i, j, k), weight in zip(triples, decay):
                total += weight * table[(codes[:, i] * LETTERS + codes[:, j]) * LETTERS + codes[:, k]]
            out[some] = total / np.sqrt(_self_kernel(codes))[:, None]
    return out


def _landmark_table(landmarks: list[str]) -> np.ndarray:
    """Discounted triples of every landmark, each over its norm."""
    table = np.zeros((LETTERS**ORDER, len(landmarks)), np.float32)
    for column, word in enumerate(landmarks):
        codes = _codes([word])
        norm = np.sqrt(_self_kernel(codes)[0])
        for (i, j, k), weight in zip(*_triples(len(word))):
            table[(codes[0, i] * LETTERS + codes[0, j]) * LETTERS + codes[0, k], column] += weight / norm
    return table


# --- training -----------------------------------------------------------------


def _distort(word: str, rng: np.random.Generator) -> str:
    """A letter put in or written twice."""
    at = int(rng.integers(1, len(word)))
    letter = word[at] if rng.random() < 0.5 else chr(97 + int(rng.integers(26)))
    return word[:at] + letter + word[at:]


def _fit_machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 2_000.0) -> np.ndarray:
    """Linear support vector machine, squared hinge loss, both sides of equal weight, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    cost = c * weight / np.where(y > 0, weight[y > 0].sum(), weight[y < 0].sum())
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        active = y * (x @ w) < 1
        xa = x[active] * cost[active, None]
        new = np.linalg.solve(ridge + x[active].T @ xa, xa.T @ y[active])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


class Model:
    """The folded table, the machine's offset and the calibration."""

    def __init__(self, table: np.ndarray, offset: float, slope: float = 1.0, shift: float = 0.0):
        self.table, self.offset, self.slope, self.shift = table, offset, slope, shift

    def margins(self, words: list[str]) -> np.ndarray:
        """Margins of words as written; a word of fewer than three letters has the offset."""
        parts, owner = [], []
        for k, word in enumerate(words):
            for part in _windows(letters_of(word)):
                parts.append(part)
                owner.append(k)
        out = np.full(len(words), -np.inf, np.float32)
        np.maximum.at(out, np.array(owner, np.int64), _kernel_sums(parts, self.table)[:, 0] + np.float32(self.offset))
        return out

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


class Scorer:
    """Margins of texts, with a bounded memory of words."""

    def __init__(self, model: Model):
        self.model, self.seen = model, {}

    def texts(self, texts: list[str | None]) -> np.ndarray:
        sets = [words_of(t) for t in texts]
        new = list(set().union(*sets).difference(self.seen)) if sets else []
        if len(self.seen) + len(new) > CACHED_WORDS:
            self.seen = {}
            new = list(set().union(*sets))
        if new:
            self.seen.update(zip(new, self.model.margins(new).tolist()))
        look = self.seen.__getitem__
        return np.array([max(map(look, s)) if s else self.model.offset for s in sets], np.float64)


def _score_margins(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    kept = [f for f in docs.schema.fields if f.name in columns]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept] + ["margin double"])

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            margins = scorer.texts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(margins)], names=[f.name for f in kept] + ["margin"]
            )

    return docs.select("text", *[f.name for f in kept]).mapInArrow(run, schema)


def is_held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``rows`` labelled rows that are not held out; equal texts count once.

    Only word statistics, sampled words and a histogram of margins reach the
    driver, all bounded by ``rows`` and the constants above.  Without labelled
    toxic rows every text scores the share of toxic labels.
    """
    spark = docs.sparkSession
    chosen = (
        labels.where(~is_held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    sample = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")  # at most ``rows`` short rows
        .groupBy(F.xxhash64("text").alias("same")).agg(F.max_by("text", "doc_id").alias("text"), F.max("toxic").alias("toxic"))
    )
    path = scratch_path(spark, "toxic-sample")
    sample.write.parquet(path)
    sample = spark.read.parquet(path)

    def words(batch) -> dict:
        rows = []
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            tokens = [letters_of(w) for w in text.lower().split()]
            spelled = [(letters_of(w), "") for w in words_of(text).difference(text.lower().split())]
            rows += [(w, before, toxic) for w, before in {*zip(tokens, ["", *tokens]), *spelled} if ORDER <= len(w) <= LONGEST]
        return {name: [r[k] for r in rows] for k, name in enumerate(("word", "before", "toxic"))}

    # Copies of one text repeat a word behind the same word; they count once.
    counted = (
        map_columns(sample.select("text", "toxic"), words, "word string, before string, toxic int")
        .groupBy("word", "before").agg(F.max("toxic").alias("t"), F.max(1 - F.col("toxic")).alias("c"))
        .groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    )
    words_path = scratch_path(spark, "toxic-words")
    counted.write.parquet(words_path)
    counted = spark.read.parquet(words_path)
    sizes = sample.agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).first()
    n_toxic, n_clean = int(sizes["t"] or 0), int(sizes["n"]) - int(sizes["t"] or 0)
    prior = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
    constant = Model(np.zeros((LETTERS**ORDER, 1), np.float32), 0.0, 0.0, float(np.log(prior / (1 - prior))))
    seen = counted.agg(F.sum("t").alias("t"), F.sum("c").alias("c")).first()
    all_t, all_c = float(seen["t"] or 0), float(seen["c"] or 0)
    ratio = (F.col("t") / all_t) / ((F.col("c") + 0.5) / max(all_c, 1.0)) if all_t else F.lit(0.0)
    telling = counted.withColumn("ratio", ratio).where((F.col("ratio") >= RATIO) & (F.col("t") * F.log("ratio") >= EXCESS))
    found = {r["word"]: r["t"] for r in telling.orderBy(F.desc(F.col("t") * F.log("ratio")), "word").limit(MARKED).collect()}
    marked = list(found)
    if not marked:
        return constant
    clean = counted.where("c > 0")
    plain = [r["word"] for r in clean.orderBy(F.xxhash64("word"), "word").limit(NEGATIVES).collect()]
    rng = np.random.default_rng(7)
    spoiled = [_distort(w, rng) for w in marked for _ in range(SPOILED)]
    pull = [float(found[w]) for w in marked] + [found[w] / SPOILED / 2 for w in marked for _ in range(SPOILED)]
    landmarks = list(dict.fromkeys(marked + plain))[: max(LANDMARKS, 2 * len(marked))]
    table = _landmark_table(landmarks)
    values, vectors = np.linalg.eigh(_kernel_sums(landmarks, table).astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T  # the inverse root of the landmark kernel

    def fit(negatives: list[str]) -> Model:
        given = marked + spoiled + negatives
        y = np.array([1.0] * (len(marked) + len(spoiled)) + [-1.0] * len(negatives))
        weight = np.array(pull + [1.0] * len(negatives))
        w = _fit_machine(_kernel_sums(given, table).astype(np.float64) @ root, y, weight)
        return Model((table @ (root @ w[:-1]).astype(np.float32))[:, None], float(w[-1]))

    model = fit(plain)

    def hard(batch) -> dict:
        words = batch.column("word").to_pylist()
        return {"word": words, "margin": model.margins(words)}

    # Words of clean texts that come nearest to the wrong side.
    near = map_columns(clean.select("word"), hard, "word string, margin double").orderBy(F.desc("margin"), "word").limit(1000)
    model = fit(plain + [r["word"] for r in near.collect()])
    bins = (
        _score_margins(sample, model, ["toxic"]).groupBy(F.round("margin", 1).alias("m")).agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).collect()
    )
    model.slope, model.shift = _calibrate(np.array([(r["m"], r["t"], r["n"]) for r in bins], np.float64))
    return model


def _calibrate(bins: np.ndarray) -> tuple[float, float]:
    """Logistic fit of the label's share on the margin; smoothed, so that it stays finite."""
    m, t, n = bins.T
    w = np.array([1.0, 0.0])
    for _ in range(100):
        w[0] = min(max(w[0], 0.0), STEEPEST)
        p = 1 / (1 + np.exp(-np.clip(w[0] * m + w[1], -30, 30)))
        slope = np.array([((t - n * p) * m).sum() - 0.01 * w[0], (t - n * p).sum()])
        h = n * p * (1 - p) + 1e-9
        curve = np.array([[(h * m * m).sum() + 0.01, (h * m).sum()], [(h * m).sum(), h.sum()]])
        step = np.linalg.solve(curve, slope)
        w += step / max(1.0, np.abs(step).max() / 3)
    return float(min(max(w[0], 0.0), STEEPEST)), float(w[1])


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row; null and empty texts score as a text without any word.

    Repeated rows are scored alike; null keys count as not held out; columns
    other than ``doc_id`` and ``text`` are not read.
    """
    margins = _score_margins(docs.select("doc_id", "text"), model, ["doc_id"])
    value = 1 / (1 + F.exp(-F.greatest(F.least(F.lit(model.slope) * F.col("margin") + model.shift, F.lit(30.0)), F.lit(-30.0))))
    return margins.select("doc_id", is_held_out().alias("held_out"), value.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, that score below the threshold."""
    place = docs.columns.index("text")

    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            scores = model.score(scorer.texts(batch.column(place).to_pylist()))
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema)
