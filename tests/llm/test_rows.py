"""The corpus operators on small tables, against brute force: nulls, empty and long texts, ties,
repeated rows, empty tables and extra columns with clashing names."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from larder.llm import ann, decontaminate, html_text, mixing, near_dup, pii, suffix_dedup, suffix_runs, token_counts, token_files, toxicity
from larder.llm.common import tune



@pytest.fixture(autouse=True)
def _tuned(spark):
    tune(spark)


SCHEMA = "doc_id long, text string, source string, score string, kept string, component_id string, n_bytes string"


def documents(spark, *texts, ids=None, sources=None):
    ids = ids or range(len(texts))
    sources = sources or ["s"] * len(texts)
    return spark.createDataFrame([(i, t, s, "x", "x", "x", "x") for i, t, s in zip(ids, texts, sources)], SCHEMA)


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def prose(rng, n):
    parts = ["la", "mo", "ri", "ten", "su", "ka", "do", "é", "vel"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


# --- suffixes -----------------------------------------------------------------


def cut_brute(docs):
    """(doc_id, text) to (doc_id, n_bytes, n_removed, n_spans, sha) per row."""
    starts = {}
    for i, t in docs:
        b = (t or "").encode()
        if i is not None:
            for p in range(len(b) - 49):
                starts[b[p : p + 50]] = min(i, starts.get(b[p : p + 50], i))
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if i is not None and starts.get(b[p : p + 50], i) < i:
                gone[p : p + 50] = b"\1" * 50
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("run_bytes, bin_bytes", [(1 << 20, 1 << 20), (400, 700)])
def test_repeated_bytes(spark, run_bytes, bin_bytes):
    rng = random.Random(5)
    shared = [prose(rng, 14) for _ in range(4)]
    docs = [(k, " ".join([prose(rng, rng.randint(0, 20)), *rng.sample(shared, rng.randint(0, 2)), prose(rng, 9)])) for k in range(25)]
    docs += [(30, docs[3][1]), (31, docs[3][1]), (31, docs[3][1]), (40, None), (41, ""), (None, docs[3][1]), (42, "ab" * 400), (43, "ba" * 90), (44, "x" * 49)]
    docs += [(45, shared[0] + "\0" + shared[1] + "é" * 60), (46, "é" * 70)]
    df = documents(spark, *[t for _, t in docs], ids=[i for i, _ in docs])
    got = rows_of(suffix_dedup.repeated_bytes(df, run_bytes, bin_bytes).drop("kept"))
    assert sorted(got, key=str) == cut_brute(docs)


def test_repeated_bytes_of_nothing(spark):
    assert rows_of(suffix_dedup.repeated_bytes(documents(spark).limit(0))) == []


def test_loser_tree_merges_and_keeps_shared_bytes():
    rng = random.Random(2)
    runs = []
    for _ in range(7):
        rows = sorted(bytes(rng.choice(b"ab\0") for _ in range(12)) for _ in range(rng.randint(1, 30)))
        matrix = np.frombuffer(b"".join(r.ljust(16, b"\0") for r in rows), np.uint8).reshape(-1, 16)
        runs.append(([r.ljust(16, b"\0") for r in rows], suffix_runs.common_bytes(suffix_runs.to_words(matrix)).tolist()))
    order, shared = suffix_runs.merge_runs(runs)
    each = [iter(r[0]) for r in runs]
    merged = [next(each[k]) for k in order]
    assert merged == sorted(x for r in runs for x in r[0])
    for a, b, n in zip(merged, merged[1:], shared[1:]):
        assert n == next((k for k in range(16) if a[k] != b[k]), 16)


# --- near duplicates ----------------------------------------------------------


def words_set(text, size):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())


def groups_brute(docs, size, threshold):
    sets = {i: words_set(t, size) for i, t in docs}
    group = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                both = len(sets[i] & sets[j])
                if both and both * threshold[1] >= threshold[0] * len(sets[i] | sets[j]) and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    return sorted((i, len(sets[i]), group[i], group[i] == i) for i in sets)


@pytest.mark.parametrize("size, threshold", [(3, (85, 100)), (5, (80, 100))])
def test_near_duplicates(spark, size, threshold):
    """Chains of edits, so that components reach over pairs under the threshold."""
    rng = random.Random(11)
    docs = []
    for _ in range(6):
        words = prose(rng, 120).split()
        for _ in range(9):
            docs.append(" ".join(words))
            for at in rng.sample(range(120), 2):
                words[at] = words[at].upper() if rng.random() < 0.3 else prose(rng, 1)
    docs += [docs[4], docs[4].upper(), None, "", " \t\n", "one two", "ONE  two", "one", prose(rng, 20_000)]
    docs = list(enumerate(docs))
    rng.shuffle(docs)
    df = documents(spark, *[t for _, t in docs], ids=[i for i, _ in docs])
    assert sorted(rows_of(near_dup.near_duplicates(df, size, threshold))) == groups_brute(docs, size, threshold)


def test_near_duplicates_rows(spark):
    df = documents(spark, "a b c d e f", "a b c d e f", "a b c d e f", None, ids=[4, 4, None, None])
    got = rows_of(near_dup.near_duplicates(df))
    assert sorted(got, key=str) == sorted([(4, 2, 4, True), (4, 2, 4, True), (None, 2, None, True), (None, 0, None, True)], key=str)
    kept = near_dup.keep_one(df)
    assert kept.columns == df.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 4]
    assert rows_of(near_dup.near_duplicates(df.limit(0))) == []


def test_keep_one_removes_texts_not_ids(spark):
    copied, own = "a b c d e f g", "q r s t u v w x"
    df = documents(spark, copied, copied, own, own, ids=[1, 5, 5, 5])
    assert sorted((r.doc_id, r.text) for r in near_dup.keep_one(df).collect()) == [(1, copied), (5, own)]


def test_likelihood_estimates_similarity():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 30_000, np.uint64)
    for shared, own in ((0.9, 1000), (0.5, 1000), (0.8, 60)):
        n = int(shared * own * 2 / (1 + shared))
        a, b = pool[:own], pool[own - n : 2 * own - n]
        true = n / (2 * own - n)
        got = near_dup.likeliest_similarity(*(near_dup.sketch(np.sort(x))[None] for x in (a, b)), np.array([own]), np.array([own]))
        assert abs(got[0] - true) < 0.1


# --- pages --------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="menu-open">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a></li></ul></nav><div id="cookie-notice">We use cookies, and you agree to them all.</div>
<article><h1>Fish &amp; chips</h1><p>First <b>para</b>graph of&nbsp; the
 text.<p>Second &lt;one&gt; &#233;&#x41;.<div class="ad-slot">Buy this very fine thing now, it costs less than ever before.</div>
<script>if (a < b) { "</p>" }</script><p>Short</p></article>
<section class="comments"><p>Nice article, I liked it very much, thank you.</p></section><form><label>Mail</label></form>
<aside>More stories</aside><footer>About us</footer>"""


def test_main_text(spark):
    expected = "Fish & chips\nFirst paragraph of the text.\nSecond <one> éA.\nShort"
    df = spark.createDataFrame(
        [(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (None, "u", "<nav>menu</nav>", "x"), (1, "u", PAGE, "x")],
        "page_id long, url string, html string, text string",
    )
    got = rows_of(html_text.extract(df))
    assert sorted(got, key=str) == sorted(
        [(1, "u", expected, len(expected))] * 2 + [(2, None, "", 0), (3, "u", "", 0), (None, "u", "", 0)], key=str
    )
    assert rows_of(html_text.extract(df.limit(0))) == []


LONG = "This sentence goes on about the sea and the many ships that cross it every day in fair and foul weather alike. " * 3


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "site footer-widgets", "post has-comments", "sidebar", "header-fixed"])
def test_names_of_wrappers_do_not_hide_the_article(name):
    article = "<h1>On ships</h1><p>Short one.</p><p>A second one follows.</p>"
    for tag in ("article", "main"):
        page = f'<div class="{name}"><div><{tag}>{article}<div class="ad">Buy it now.</div></{tag}></div><div class="widget"><p>Most read.</p></div></div>'
        assert html_text.main_text(page) == "On ships\nShort one.\nA second one follows."
    prose = f'<div id="{name}"><p>{LONG}</p><p>{LONG}</p><ul><li><a href="/">Home</a></li></ul><div class="share"><p>Share it.</p></div></div>'
    assert html_text.main_text(prose) == f"{LONG.strip()}\n{LONG.strip()}"
    assert html_text.main_text(f'<div class="{name}"><p>Call us.</p></div>') == ""
    inside = f'<article><div class="{name}"><p>{LONG}</p><p>{LONG}</p></div></article>'
    assert html_text.main_text(inside) == f"{LONG.strip()}\n{LONG.strip()}"


def test_comments_stay_out():
    comment = "I read this with much joy and I should like to hear more of it some day soon, if you can find the time."
    comments = f'<div id="comments"><ol class="commentlist">{f"""<li class="comment"><article class="comment-body"><p>{comment}</p></article></li>""" * 9}</ol></div>'
    assert html_text.main_text(f"<main><p>{LONG}</p>{comments}</main>") == LONG.strip()


def test_embedded_elements_keep_their_text():
    page = (
        "<article><p>The area is <math><mi>x</mi><mo>=</mo><mn>2</mn></math> and no more.</p><object><p>The chart shows a rise of two.</p></object>"
        "<canvas>A ship on the sea.</canvas><audio>Waves are heard.</audio><video src=v>Ships come in.</video><svg><path d=''/><title>icon</title><text>North</text></svg>"
        "<template><p>Never</p></template><select><option>One</select><p>The end.</p></article>"
    )
    lines = ["The area is x=2 and no more.", "The chart shows a rise of two.", "A ship on the sea.", "Waves are heard.", "Ships come in.", "North", "The end."]
    assert html_text.main_text(page) == "\n".join(lines)
    for tag in ("svg", "math", "object", "canvas", "audio", "video"):
        assert html_text.main_text(f"<article><div><{tag}></div><p>{LONG}</p></article>") == LONG.strip()
    assert html_text.main_text("<div><video>Your browser cannot show this.</video></div>") == ""
    assert html_text.main_text(f"<article><p>{LONG}</p><script>if (a) {{</article>") == LONG.strip()


def test_minimum_cut_is_the_cheapest_labelling():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 7)
        scores = [rng.uniform(-2, 2) for _ in range(n)]
        edges = [(i, j, rng.uniform(0, 1)) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cost(label):
            return sum(max(s, 0) if not x else max(-s, 0) for s, x in zip(scores, label)) + sum(w for i, j, w in edges if label[i] != label[j])

        best = min(cost([bool(m >> k & 1) for k in range(n)]) for m in range(2**n))
        assert abs(cost(html_text.minimum_cut(scores, edges)) - best) < 1e-6


# --- tokens -------------------------------------------------------------------

PIECES = [" ", "  ", "\n", " \n", "a", "the", "hello.", "é", "x's", "▁", "<s>", "\t", "<|endoftext|>", "①", "123", "!?", "\x1c", "\xa0", "🙂", "\r\n", "ing,", "²"]


def mixtures(n):
    rng = random.Random(8)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_token_counts(spark):
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    plain = sentencepiece.SentencePieceProcessor(model_file=model)
    table = token_counts.transitions(model)
    for text in mixtures(1500):
        for chunk in (1, 3, 7, 1000):
            assert token_counts.count_text(table, text, chunk) == len(plain.encode(text)), repr(text)
    texts = [None, "", "same", "same", "word " * 30_000, *mixtures(30)]
    got = rows_of(token_counts.count_tokens(documents(spark, *texts, ids=[None, *range(1, len(texts))]), model))
    counts = [len(plain.encode(t or "")) for t in texts]
    assert got == [(k or None, len((t or "").encode()), n, n > 4096) for k, (t, n) in enumerate(zip(texts, counts))]
    assert rows_of(token_counts.count_tokens(documents(spark).limit(0), model)) == []


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    texts = [None, "", "same", "same", "word é " * 40_000, *mixtures(300)]
    ids = [7, 7, 5, 5, 9, *range(100, 400)]
    df = documents(spark, *texts, ids=ids).repartition(3)
    manifest = token_files.write_token_files(df, str(tmp_path / "ids"), path)
    got = rows_of(token_files.read_token_files(manifest, str(tmp_path / "ids")))
    expected, start = [], 0
    for i, t in sorted(zip(ids, texts), key=lambda x: (x[0], x[1] or "")):
        own = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        expected.append((i, start, len(own), zlib.crc32(own.tobytes())))
        start += len(own)
    assert sorted(got, key=lambda r: r[1]) == expected
    first = manifest.orderBy("shard").first()
    some = token_files.read_documents(str(tmp_path / "ids"), first["file"], [2, 0])
    assert [len(x) for x in some] == [expected[2][2], expected[0][2]]
    damaged = bytearray((tmp_path / "ids" / first["file"]).read_bytes())
    damaged[12] ^= 255
    (tmp_path / "ids" / first["file"]).write_bytes(damaged)
    with pytest.raises(Exception):
        token_files.read_documents(str(tmp_path / "ids"), first["file"], [0])


# --- toxicity -----------------------------------------------------------------


def test_toxicity(spark):
    rng = random.Random(1)
    insults = ["zurkel", "bragnot", "fimwad"]
    texts, toxic = [], []
    for k in range(500):
        words = prose(rng, 40).split()
        bad = k % 5 == 0
        if bad:
            words[rng.randrange(40)] = rng.choice(insults)
        texts.append(" ".join(words))
        toxic.append(int(bad))
    extra = ["some z.u.r.k.e.l here", "a z u r k e l there", "brragnot", "BRAGNOT!", None, "", "la mo"]
    df = documents(spark, *texts, *extra)
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    model = toxicity.train(df, labels)
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    held = {k for k in range(500) if zlib.crc32(str(k).encode()) % 4 == 2}
    assert {k for k in range(500) if got[k].held_out} == held
    assert all(got[k].predicted == toxic[k] for k in held)
    assert [got[500 + k].predicted for k in range(len(extra))] == [1, 1, 1, 1, 0, 0, 0]
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = toxicity.keep_clean(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if not r.predicted}
    none = toxicity.train(df, labels.where("toxic = 0"))
    assert {r.predicted for r in toxicity.score(df, none).collect()} == {0}
    assert rows_of(toxicity.score(df.limit(0), model)) == []


def test_kernel_is_the_sum_over_common_subsequences():
    from itertools import combinations

    def brute(x, y):
        def parts(s):
            return [("".join(s[k] for k in p), toxicity.DECAY ** (p[-1] - p[0] + 1)) for p in combinations(range(len(s)), toxicity.ORDER)]

        return sum(a * b for u, a in parts(x) for v, b in parts(y) if u == v)

    words = ["abcab", "banana", "abc", "zzzz"]
    got = toxicity._kernel_sums(words, toxicity._landmark_table(words))
    for i, x in enumerate(words):
        for j, y in enumerate(words):
            assert got[i, j] == pytest.approx(brute(x, y) / (brute(x, x) * brute(y, y)) ** 0.5, abs=1e-5)


# --- personal data ------------------------------------------------------------


def pii_brute(text):
    found = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if max(map(int, m[0].split("."))) <= 255]
    for k, kind, pattern in ((2, "card", r"[0-9]([\x20-]?[0-9])+"), (3, "phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "card" and 12 <= len(d) <= 19 and pii.luhn(d)) or (kind == "phone" and 9 <= len(d) <= 15):
                found.append((m.start(), k, m.end(), kind))
    return [(s, e, kind) for s, _, e, kind in sorted(found)]


def test_patterns():
    rng = random.Random(9)
    parts = ["a", "b.", "@", "x.com", "1", "23", "255", ".", "-", " ", "+", "(", "4111111111111111", "+1 (555)", "300", "0001", "\n", "é"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == pii_brute(text), repr(text)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_field_carries_labels_to_repeats(spark):
    rng = random.Random(3)
    texts = [f"{prose(rng, 9)} +1 (555) 867-5{k:03d} {prose(rng, 5)} box {k} of v{k % 9}.0" for k in range(120)]
    repeat = "Call +1 (555) 867-5309 today. No answer at 867-5309 again."
    texts += [repeat, repeat, None, "", "9" * 5000, "x@" * 2000]
    df = documents(spark, *texts)
    field = pii.train(df)
    got = {r.doc_id: r for r in pii.scan(df, field).collect()}
    base, spans = got[120].base_sha256, got[120].spans
    assert base == hashlib.sha256(pii.joined(pii_brute(repeat)).encode()).hexdigest() and got[120].n_phone == 1
    at = repeat.rindex("867-5309")
    assert f"phone:{at}:{at + 8}" in spans.split(",") and "phone:5:22" in spans.split(",")
    assert got[121].spans == spans and got[122].spans == "" and got[123].spans == ""
    assert rows_of(pii.scan(df.limit(0), field)) == []


@pytest.mark.parametrize("odds", [-1.0, -2.0, -4.0])
@pytest.mark.parametrize("n", [1, 2, 5, 30, 300])
def test_field_reaches_every_repeat(n, odds):
    field = pii.Field({"": np.array([0.0] + [odds] * 4)}, np.zeros((5, 5)))
    for full, bare, kind in (("john.doe@example.com", "johndoe", "email"), ("+1-555-867-5309", "867-5309", "phone")):
        text = f"Ask {full} today. " + f"No answer from {bare} again. " * n
        base, spans = pii.find(text, field)
        assert len(base) == 1 and len(spans) == n + 1 and {s[2] for s in spans} == {kind}
        text = f"No answer from {bare} again. " * n + f"Ask {full} today."
        assert len(pii.find(text, field)[1]) == n + 1
    assert pii.find("No answer from 867-5309 again. " * n, field) == ([], [])


def test_messages_settle():
    rng = np.random.default_rng(2)
    chain = rng.uniform(-1, 1, (5, 5))
    field = pii.Field({"": np.array([0.0, -1.0, -1.0, -1.0, -1.0])}, chain)
    words = ["867-5309", "+1-555-867-5309", "555-867-5309", "12", "a@b.com", "4111111111111111", "1111111"]
    for n in (3, 40, 400):
        text = " ".join(rng.choice(words, n))
        tokens = pii.Tokens(text, pii.base_spans(text))
        p = field.label(tokens)
        assert np.isfinite(p).all() and np.allclose(p.sum(1), 1)
        for k in range(len(tokens.places)):
            assert not tokens.touched[k] or p[k, tokens.observed[k]] == 1


# --- mixing, benchmarks, neighbours -------------------------------------------


def test_mixing(spark):
    texts = ["abc" * (1 + k % 7) for k in range(900)] + [None, "", "x"]
    sources = ["big"] * 700 + ["small"] * 100 + [None] * 100 + ["small", "small", "empty"]
    df = documents(spark, *texts, sources=sources).withColumn("mix_key", F.lit("clash"))
    out = mixing.replicate(df, {"big": 1, "small": 3})
    assert set(out.columns) == {*df.columns, "mix_copy"}
    copies = {r.doc_id: r for r in out.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("mix_copy").alias("top")).collect()}
    assert all(r.n == r.top for r in copies.values())
    share = {r.source: r.n for r in out.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert set(share) == {"big", "small"} and 2.2 < share["small"] / share["big"] < 4.1
    keys = [r.mix_key for r in out.collect()]
    assert keys == sorted(keys)
    assert rows_of(out) == rows_of(mixing.replicate(df, {"big": 1, "small": 3}))
    twice = documents(spark, "a", "a", "b", ids=[3, 3, None])
    counts = {}
    for r in mixing.replicate(twice, epochs=40.0).collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert counts[3] % 2 == 0 and counts[None] > 0
    assert rows_of(mixing.replicate(df.limit(0))) == []


def test_contaminated(spark):
    rng = random.Random(6)
    items = [prose(rng, 30) for _ in range(6)]
    edited = items[1].split()
    edited[4], edited[11] = "other", "words"
    del edited[20]
    texts = [f"{prose(rng, 200)} {items[0]} {prose(rng, 50)}", f"{prose(rng, 40)} {' '.join(edited).upper()}!", " ".join(items[2].split()[:8]), None, "", prose(rng, 3000)]
    texts += [texts[0]]
    benchmark = spark.createDataFrame([*enumerate(items), (6, None), (None, "a b c d"), (7, "two words")], "item_id long, text string")
    df = documents(spark, *texts)
    for block in (1 << 20, 100):
        got = sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(df, benchmark, block).collect())
        assert got == [(0, 0), (1, 1), (6, 0)]
        kept = decontaminate.keep_uncontaminated(df, benchmark, block)
        assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5]
    assert rows_of(decontaminate.contaminated(df, benchmark.limit(0))) == []
    assert rows_of(decontaminate.contaminated(df.limit(0), benchmark)) == []


def test_contaminated_does_not_depend_on_the_number_of_copies(spark):
    rng = random.Random(8)
    item = [f"w{k}" for k in range(38)]
    for edits in (6, 10):
        edited = list(item)
        for k in range(edits):
            edited[3 + k * (6 if edits == 6 else 3)] = "x"
        copy = " ".join(edited)
        texts = [f"{prose(rng, 20)} {copy}" if k % 3 == 0 else prose(rng, 40) for k in range(3000)]
        df = documents(spark, *texts)
        benchmark = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
        got = decontaminate.contaminated(df, benchmark).collect()
        assert sorted(r.doc_id for r in got) == list(range(0, 3000, 3))
        assert all(abs(r.score - (76 - 3 * edits) / 76) < 1e-9 for r in got)
        assert decontaminate.keep_uncontaminated(df, benchmark).count() == 2000
    one = documents(spark, " ".join(item[:20]) + " x" * 5 + " " + item[-1])
    assert decontaminate.contaminated(one, benchmark).first().score == 40 / 76


def test_reach_is_never_less_than_the_alignment():
    rng = random.Random(12)
    for _ in range(3000):
        a, b = ([b"%d" % rng.randint(0, 9) for _ in range(rng.randint(0, 12))] for _ in range(2))
        assert min(decontaminate.reach(a, b), decontaminate.reach(b, a)) >= decontaminate.align(a, b)[0]


def test_alignment_score():
    item = b"a b c d e f".split()
    assert decontaminate.align(item, b"x a b c d e f y".split())[:2] == (12, 6)
    assert decontaminate.align(item, b"a b x c d e f".split())[:2] == (11, 6)
    assert decontaminate.align(item, b"p q r".split())[0] == 0


def test_nearest(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(1500, 8)).round(3)
    vectors[700:900] = vectors[3]
    rows = [(int(k), [float(x) for x in v], "x") for k, v in enumerate(vectors)]
    rows += [(2000, None, "x"), (2020, [0.0] * 8, "x"), (2040, [float("nan")] * 8, "x"), (2060, [None] * 8, "x"), (None, [1.0] * 8, "x"), (5, rows[5][1], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 20 = 0"), shard_rows=400, query_rows=30).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == {k for k in range(0, 1500, 20)}
    hits = 0
    for q, found in got.items():
        assert sorted(found) == list(range(1, 21)) and q not in {v for v, _ in found.values()}
        scores = vectors @ vectors[q]
        order = sorted((k for k in range(1500) if k != q), key=lambda k: (-scores[k], k))[:20]
        hits += len({v for v, _ in found.values()} & set(order))
        assert all(abs(s - scores[v]) < 1e-9 for v, s in found.values())
        if q in range(700, 900, 20):
            assert [found[k][0] for k in range(1, 21)] == [3, *[k for k in range(700, 721) if k != q]][:20]
    assert hits / (20 * len(got)) >= 0.9
    few = df.where("vec_id in (1, 2, 20)")
    assert sorted(r.rank for r in ann.nearest(few, few.where("vec_id = 20")).collect()) == [1, 2]
    assert rows_of(ann.nearest(df.limit(0), df)) == []


def test_nearest_counts_ids_not_rows(spark):
    same, other = [1.0, 2.0], [-1.0, 0.5]
    rows = [(0, same)] * 30 + [(k, same) for k in range(1, 6)] + [(9, other)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.nearest(df, df.where("vec_id = 9"), k=4).collect()
    assert sorted((r.rank, r.vec_id) for r in got) == [(1, 0), (2, 1), (3, 2), (4, 3)]
    got = ann.nearest(df, df.where("vec_id = 0"), k=5).collect()
    assert sorted((r.rank, r.vec_id) for r in got) == [(k, k) for k in range(1, 6)]
