"""Operators 11 to 13 on small tables, against brute force and against their SQL: nulls, empty and long
texts, ties, repeated rows, empty tables and extra columns with clashing names."""

import hashlib
import math
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest

import __spark_entry__ as entry_points
from conftest import SMALLEST
from larder.llm import block_dedup, filter_audit, importance
from larder.llm.common import tune
from oracle import compare, connect


@pytest.fixture(autouse=True)
def _tuned(spark):
    tune(spark)


# Extra columns named like what the operators use inside.
EXTRA = "part string, fails string, good string, first string, digest string, ids string, texts string, chunk string, place string, n long, weight string, rank string"


def documents(spark, rows):
    filler = ("x",) * 9 + (1, "x", "x")
    schema = f"doc_id long, text string, lang string, {EXTRA}"
    return spark.createDataFrame([(*row, *filler) for row in rows], schema)


@pytest.mark.parametrize("name", ["op11_block_dedup", "op12_filter_audit", "op13_importance"])
def test_matches_sql(spark, name):
    frame = entry_points.queries()[name](spark, str(SMALLEST))
    assert compare(frame, connect(str(SMALLEST)), entry_points.oracle_sql()[name]) is None


def test_registered():
    names = set(entry_points.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


# --- repeated windows -----------------------------------------------------------


def order_of(doc_id):
    return block_dedup.LAST if doc_id is None else doc_id


def cut_brute(docs, window):
    first = {}
    for i, t in docs:
        w = (t or "").encode().split()
        for s in range(len(w) - window + 1):
            q = tuple(w[s : s + window])
            first[q] = min(first.get(q, (order_of(i), s)), (order_of(i), s))
    out = []
    for i, t in docs:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if (order_of(i), s) > first[tuple(w[s : s + window])]:
                gone[s : s + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(w), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept.decode()))
    return out


def passages(rng, n_docs, vocabulary):
    pool = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 70))] for _ in range(6)]
    rows = []
    for i in range(n_docs):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choice(pool)[rng.randint(0, 9) :] + [f"u{rng.randint(0, 9999)}"] * rng.randint(0, 2)
        rows.append((i, rng.choice([" ", "\n", "\t ", "\x0b"]).join(words), "en"))
    return rows


@pytest.mark.parametrize("window,chunk_bytes,bucket_bytes", [(20, 1 << 20, 1 << 20), (20, 700, 2000), (5, 300, 500)])
def test_repeated_words_brute(spark, window, chunk_bytes, bucket_bytes):
    """Several chunks and buckets or one; odd rows among them."""
    rng = random.Random(window + chunk_bytes)
    rows = passages(rng, 40, ["la", "mo", "ri", "é", "ten,", "Su"]) + passages(rng, 5, ["a"])
    rows += [(None, rows[3][1], None), (None, rows[3][1], None), (7, rows[7][1], "en"), (7, rows[2][1], "en"), (900, None, "fr"), (901, "", "fr"), (902, " \n ", "")]
    rows += [(903, "word " * 3000, "en"), (904, "x" * 5000 + " " + "y" * 90, "en"), (905, "no break here " * 30, "en")]
    got = block_dedup.repeated_words(documents(spark, rows), window, chunk_bytes, bucket_bytes).collect()
    expected = cut_brute([r[:2] for r in rows], window)
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert sum(r[2] for r in expected) > 0


def test_repeated_words_moves_no_text(spark):
    """Texts are read from their chunks: no exchange carries them, even where answers are too many to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = block_dedup.repeated_words(documents(spark, passages(random.Random(1), 30, ["a", "b", "c"])))
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and "SortMergeJoin" in plan
    # Below an exchange stands what it carries: only answers do.
    carried = [plan.split("\n")[k + 1] for k, line in enumerate(plan.split("\n")) if "Exchange" in line]
    assert carried and not any("texts" in line for line in carried)


def test_repeated_words_empty_table(spark):
    assert block_dedup.repeated_words(documents(spark, [])).collect() == []
    assert [tuple(r) for r in block_dedup.repeated_words(documents(spark, [(1, None, "en")])).collect()] == [
        (1, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
    ]


def test_word_hashes_agree_across_slices(monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("abzé中") for _ in range(rng.randint(1, 90))).encode() for _ in range(300)]
    raw = b" ".join(words)
    whole = block_dedup.WordHashes().of(raw, 0)[1]
    assert len({(w, h) for w, h in zip(words, whole.tolist())}) == len(set(words)) == len(set(whole.tolist()))
    for size in (1, 7, 100):
        monkeypatch.setattr(block_dedup, "SLICE_BYTES", size)
        starts, hashes = block_dedup.WordHashes().of(raw, 0)
        assert (hashes == whole).all() and [raw[s : s + len(w)] for s, w in zip(starts, words)] == words


# --- filter audit ---------------------------------------------------------------


def audit_brute(docs, labels):
    quality = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    texts = [(i, t or "") for i, t, _ in docs]
    first = {}
    for i, t in texts:
        if i is not None:
            first[t] = min(first.get(t, i), i)
    fails = []
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append((
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search(r"[#$%&*|]", t)), i is not None and first[t] < i,
        ))
    out = []
    for part in {d[2] or "" for d in docs}:
        own = [k for k, d in enumerate(docs) if (d[2] or "") == part]
        shapley, rows = [0] * 5, []
        for order in permutations(range(5)):
            for step, f in enumerate(order):
                alive = [k for k in own if not any(fails[k][g] for g in order[:step])]
                removed = [k for k in alive if fails[k][f]]
                shapley[f] += len(removed)
                rows.append((
                    "".join("ABCDE"[g] for g in order), step + 1, f, len(alive) - len(removed), len(removed),
                    sum(fails[k][f] for k in own) - len(removed), sum(fails[k][f] and sum(fails[k]) == 1 for k in own),
                    sum(docs[k][0] in quality for k in removed), sum(docs[k][0] in toxic for k in removed),
                ))
        out += [(part, name, step, *rest, shapley[f]) for name, step, f, *rest in rows]
    return sorted(out)


def test_audit_brute(spark):
    rng = random.Random(9)
    docs = []
    for i in range(120):
        words = [rng.choice(["alpha", "Beta", "GAMMA", "d#", "e", "ÉTÉ"]) if rng.random() < 0.2 else f"w{rng.randint(0, 400)}" for _ in range(rng.choice([0, 99, 100, 101, 150]))]
        text = rng.choice([" ", "\x0c", "\n"]).join(words)
        docs.append((rng.choice([i, i, i, None, rng.randint(0, 30)]), rng.choice([text, text, text, docs[-1][1] if docs else None, None, ""]), rng.choice(["en", "fr", None, ""])))
    labels = [(rng.choice([None, *range(120)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(150)]
    table = spark.createDataFrame([(*r, "x", "x") for r in labels], "doc_id long, quality int, toxic int, good string, first string")
    got = filter_audit.audit_filters(documents(spark, docs), table).collect()
    assert sorted(map(tuple, got)) == audit_brute(docs, labels)


def test_audit_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(documents(spark, []), labels).collect() == []
    rows = filter_audit.audit_filters(documents(spark, [(None, None, None)]), labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""} and sum(r.removed for r in rows) == 120


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 31, 1000, 4097])
def test_positional_counts(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    expected = [(int(((words >> np.uint32(b)) & np.uint32(1)).sum())) for b in range(32)]
    assert filter_audit.positional_counts(words).tolist() == expected


def test_survival_words():
    table = filter_audit.survival_words()
    assert all(bool(int(table[f]) >> s & 1) == (f & s == 0) for f in range(32) for s in range(32))


# --- importance -----------------------------------------------------------------


def features_brute(text):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", raw)
    return len(w), [zlib.crc32(b" ".join(w[i : i + k])) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def resample_brute(docs, target):
    own, wanted = [features_brute(t) for _, t, _ in docs], [f for t in target for f in features_brute(t)[1]]
    s, t = np.bincount([f for _, fs in own for f in fs], minlength=10000), np.bincount(wanted, minlength=10000)
    gain = [math.floor(1000 * math.log((b + 1) * (int(s.sum()) + 10000) / ((a + 1) * (int(t.sum()) + 10000)))) for a, b in zip(s.tolist(), t.tolist())]
    rows = []
    for (i, _, _), (n, fs) in zip(docs, own):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[f] for f in fs)
        rows.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], math.inf if r[0] is None else r[0], -r[2], -r[1]))
    drawn = len(able) * 5 // 100
    return sorted(
        [(*r[:4], k + 1 if k < drawn else None) for k, r in enumerate(able)] + [(*r[:4], None) for r in rows if r[4] < 20], key=str
    )


@pytest.mark.parametrize("chunk_words,piece_bytes,share", [(1 << 18, 1 << 20, 1 << 14), (50, 30, 20), (3, 1, 4)])
def test_resample_brute(spark, monkeypatch, chunk_words, piece_bytes, share):
    """Whatever the chunks and the head are, the totals and the draw are the same."""
    rng = random.Random(5)
    words = ["la", "Mo", "ri9", "été", "ÉTÉ", "x-y", "long" * 40, "__", "7"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60))), "en") for i in range(150)]
    docs += [(None, docs[1][1], None), (3, docs[3][1], "en"), (3, docs[4][1], "en"), (400, None, "en"), (401, "", ""), (402, "ri9 la " * 4000, "en")]
    target = [" ".join(rng.choice(words[:4]) for _ in range(30)) for _ in range(10)] + [None, ""]
    monkeypatch.setattr(importance, "HEAD_SHARE", share)
    table = spark.createDataFrame([(n, t) for n, t in enumerate(target)], "doc_id long, text string")
    frame = documents(spark, docs)
    head = importance.head_features(frame)
    assert all(len(f) <= importance.HEAD_BYTES for f in head) and len(head) <= 2 * share
    expected = resample_brute(docs, target)
    got = importance.resample(frame, table).collect()
    assert sorted(map(tuple, got), key=str) == expected and sum(r[4] is not None for r in expected) == 5
    monkeypatch.setattr(importance, "CHUNK_WORDS", chunk_words)
    monkeypatch.setattr(importance, "PIECE_BYTES", piece_bytes)
    features = importance.Features(head)
    found = [[] for _ in docs]
    for bucket, row in features.buckets([None if t is None else t.encode() for _, t, _ in docs]):
        for b, r in zip(bucket.tolist(), row.tolist()):
            found[r].append(b)
    assert [sorted(f) for f in found] == [sorted(features_brute(t)[1]) for _, t, _ in docs]


def test_resample_empty_tables(spark):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(documents(spark, []), none).collect() == []
    rows = importance.resample(documents(spark, [(1, None, "en"), (2, "a b", "en")]), none).collect()
    assert sorted((r.doc_id, r.n_features, r["rank"]) for r in rows) == [(1, 0, None), (2, 3, None)]


@pytest.mark.parametrize("length", [0, 1, 63, 64, 65, 1000, 5000])
def test_checksums_move(length):
    rng = random.Random(length)
    front, rest = rng.randbytes(9), rng.randbytes(length)
    moved = importance.Shifts().over(np.array([zlib.crc32(front)], np.uint32), np.array([length]))
    assert int(moved[0]) ^ zlib.crc32(rest) == zlib.crc32(front + rest)


# --- stages and clashing names ----------------------------------------------------


def test_stages_keep_clashing_columns(spark):
    """Columns named like what the stages use inside come back as they were."""
    from larder.llm import decontaminate, mixing, near_dup, toxicity

    names = ["_hash", "_row", "_source", "_distribution", "_count", "_u", "_identity", "_key", "_found", "_HASH_"]
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["la", "mo", "ri", "ten", "su"]) + str(rng.randint(0, 99)) for _ in range(30)), "s", *[f"{n}{i}" for n in names]) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(30)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "nothing of this is in any of the documents at hand")], "item_id long, text string")
    stages = [
        near_dup.keep_one(docs), mixing.replicate(docs, epochs=1.0).drop("mix_copy", "mix_key"),
        decontaminate.keep_uncontaminated(docs, items), toxicity.keep_clean(docs, toxicity.train(docs, labels)),
    ]
    for k, frame in enumerate(stages):
        assert frame.columns == docs.columns
        got = set(map(tuple, frame.collect()))
        assert got <= set(rows) and (k not in (0, 2) or got == set(rows))


@pytest.mark.parametrize("block_bytes", [10, 200, 1 << 20])
def test_items_are_told_apart_by_text(spark, block_bytes):
    """Several texts under one item id, and items without an id, are all searched, whatever the blocks hold."""
    from larder.llm import decontaminate

    rng = random.Random(6)
    items = [" ".join(f"w{rng.randint(0, 9999)}" for _ in range(20)) for _ in range(5)]
    table = spark.createDataFrame([(7, items[0]), (7, items[1]), (None, items[2]), (None, items[3]), (7, items[0]), (8, None)], "item_id long, text string")
    docs = spark.createDataFrame([(k, f"before {t} after") for k, t in enumerate(items)], "doc_id long, text string")
    found = decontaminate.contaminated(docs, table, block_bytes).collect()
    assert sorted((r.doc_id, r.item_id or 0) for r in found) == [(0, 7), (1, 7), (2, 0), (3, 0)]
    assert [r.doc_id for r in decontaminate.keep_uncontaminated(docs, table, block_bytes).collect()] == [4]
