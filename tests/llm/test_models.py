"""Operators of this round: tokenizer alignment, whitening, language identification."""

import bisect
import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripkit.llm import alignment, language_id, whitening
from tripkit.llm.common import table

from hard_rows import ROWS, SF

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    return tok, sentencepiece.SentencePieceProcessor(model_file=B), alignment.byte_level_tokens(A), alignment.piece_tokens(B)


def plain_groups(libraries, text):
    """Groups of a text as (A ids, B ids), by walking both token lists."""
    tok, sp, a_bytes, b_bytes = libraries
    if not text:
        return []
    a, b = tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)
    if not b"".join(a_bytes[i] for i in a) == b"".join(b_bytes[i] for i in b) == b" " + text.encode():
        return []
    ends_a, ends_b = (list(np.cumsum([len(t[i]) for i in x])) for x, t in ((a, a_bytes), (b, b_bytes)))
    out, at_a, at_b = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        to_a, to_b = bisect.bisect_right(ends_a, cut), bisect.bisect_right(ends_b, cut)
        out.append((a[at_a:to_a], b[at_b:to_b]))
        at_a, at_b = to_a, to_b
    return out


def plain_alignment(libraries, rows):
    groups = [plain_groups(libraries, t) for _, t in rows]
    linked = [collections.Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    held = collections.Counter(p for links in linked for p in links)
    high = collections.defaultdict(int)
    for (x, _), n in held.items():
        high[x] = max(high[x], n)
    out = []
    for (i, _), g, links in zip(rows, groups, linked):
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(links.values()),
                    sum(n for p, n in links.items() if held[p] == high[p[0]]), sum(n * held[p] for p, n in links.items()),
                    hashlib.sha256(shown.encode()).hexdigest() if g else ""))
    return out


def test_alignment_equals_walk_over_tokens(spark, docs, empty, libraries, monkeypatch):
    want = sorted(plain_alignment(libraries, [r[:2] for r in ROWS]), key=str)
    for pack_bytes in (1 << 20, 3000):
        got = alignment.align_documents(docs, A, B, pack_bytes)
        assert sorted(map(tuple, got.collect()), key=str) == want
    assert alignment.align_documents(empty, A, B).count() == 0


def test_alignment_query_on_a_whole_table(spark, sample, libraries):
    rows = [tuple(r) for r in sample.select("doc_id", "text").collect()]
    got = alignment.op11_alignment(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(plain_alignment(libraries, rows))


def test_aligner_on_odd_texts_in_small_parts(libraries, monkeypatch):
    rnd = random.Random(5)
    parts = ["a", "bc", " ", " ", "\n", "\t", "'s", "12", "é", "日本", "🎉", "!", "<|endoftext|>", "</s>", "\x85", "the", "　", "▁", "====", "\x00", "ﬁ"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(1500)] + [None, "", " ", "  ", "x" * 3000]
    want = plain_alignment(libraries, list(enumerate(texts)))
    for size, wide in ((1 << 19, 4096), (7, 2)):
        monkeypatch.setattr(alignment, "PART_CHARS", size)
        monkeypatch.setattr(alignment, "WIDE_GROUP", wide)
        counts, sha, key, links = alignment.Aligner(A, B).texts(texts)
        assert [(i, *c, s) for i, (c, s) in enumerate(zip(counts.tolist(), sha))] == [(*w[:5], w[7]) for w in want]
        assert links.sum() == sum(w[4] for w in want) and len(np.unique(key)) == len(key)


# ------------------------------------------------------------------ whitening

def plain_whitening(vectors):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    v = np.cov(x.T, bias=True).reshape(x.shape[1], -1)
    e, q = np.linalg.eigh(v)
    return n, [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x], e[::-1], ((x - s / n) @ q)[:, ::-1], v


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_whitening_equals_dense_eigenvectors(spark, name):
    folder = f"/root/testdata/{name}"
    rows = [r for r in table(spark, folder, "embeddings").select("vec_id", "embedding").collect()
            if r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1])]
    n, deviation, e, projected, v = plain_whitening([r[1] for r in rows])
    got = whitening.op12_whitening(spark, folder).collect()
    assert len(got) == 8 * len(rows)
    place = {r[0]: k for k, r in enumerate(rows)}
    assert {(r["vec_id"], r["component"]) for r in got} == {(i, c) for i in place for c in range(1, 9)}
    sign = {}
    for r in got:
        k, c = place[r["vec_id"]], r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, deviation[k])
        assert abs(r["explained"] - e[c] / v.trace()) < 1e-10 and r["identity_error"] < 1e-9
        want = projected[k, c] / np.sqrt(e[c])
        sign.setdefault(c, np.sign(want * r["whitened"]))
        assert abs(r["whitened"] - sign[c] * want) < 1e-8


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(0, 10 ** 6), st.sampled_from(["plain", "low", "equal", "near", "zero"]))
def test_slices_of_any_spectrum(dim, seed, kind):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    e = {"plain": rng.random(dim) * 100, "low": np.where(np.arange(dim) < 2, 5.0, 0), "equal": rng.integers(0, 3, dim) * 1.0,
         "near": 1 + 1e-9 * np.arange(dim), "zero": np.zeros(dim)}[kind]
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    shifts = rng.random(3) * 4
    assert all(whitening.count_above(v, s) == (np.linalg.eigvalsh(v) > s).sum() for s in shifts)
    got = whitening.leading(v, 8)
    top = max(1.0, e.max())
    assert np.allclose([g[0] for g in got], np.sort(e)[::-1][:8], atol=1e-12 * top, rtol=1e-12)
    x = np.array([g[1] for g in got])
    assert np.abs(x @ x.T - np.eye(len(x))).max() < 1e-6
    assert np.abs(v @ x.T - x.T * [g[0] for g in got]).max() < 1e-11 * top


def test_whitening_of_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [3.0, -1.0]), (2, [3.0, -1.0]), (None, [0.5, 0.25]), (3, None), (4, []), (5, [1.0, None]), (6, [nan, 1.0]),
            (7, [1.0, inf]), (8, [1.0, 2.0, 3.0]), (9, [1e300, 0.0]), (10, [-7.0, 0.1])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, n int, component string").repartition(3)
    got = whitening.whiten(df).collect()
    used = [r for r in rows if r[0] in (1, 2, None, 10)]
    assert len(got) == 2 * len(used) and {r["n"] for r in got} == {5}
    assert sorted(str(r["vec_id"]) for r in got) == sorted([str(r[0]) for r in used] * 2)
    n, deviation, *_ = plain_whitening([r[1] for r in used])
    assert sorted(int(r["deviation"]) for r in got if r["component"] == 1) == sorted(deviation)
    same = whitening.whiten(df.where("vec_id = 2")).collect()  # no variance at all
    assert len(same) == 4 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None for r in same)
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], "vec_id long, embedding array<double>")
    flat = whitening.whiten(line).collect()  # variance in one direction only
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in flat) and flat[0]["identity_error"] < 1e-9
    assert whitening.whiten(df.where("false")).count() == 0 == whitening.whiten(df.where("vec_id = 3")).count()
    far = spark.createDataFrame([(1, [1e10, 1.0]), (2, [-1e10, 3.0]), (3, [5.0, 6.0])], "vec_id long, embedding array<double>")
    want = plain_whitening([[1e10, 1.0], [-1e10, 3.0], [5.0, 6.0]])[1]
    assert sorted(int(r["deviation"]) for r in whitening.whiten(far).where("component = 1").collect()) == sorted(want)


# ------------------------------------------------------------------ languages

def segmentations(word: bytes, number):
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        if word[:k] in number:
            for rest in segmentations(word[k:], number):
                yield [number[word[:k]], *rest]


def test_forward_and_expected_counts_over_all_segmentations():
    pieces = language_id.Pieces(B)
    rng = np.random.default_rng(1)
    p = np.vstack([rng.random((pieces.size, 3)) / pieces.size, np.zeros(3)])
    words, count = ["the", "über", "aaaa", "日本", "x", "the"], rng.integers(1, 9, (6, 3)).astype(float)
    logs, uses = language_id.log_words(words, pieces, language_id._lifted(p, pieces.lengths)), np.zeros((pieces.size, 3))
    for some, ids in pieces.blocks(words, 3):
        language_id.expected(ids, language_id._lifted(p, pieces.lengths), count[some], uses)
    want = np.zeros_like(uses)
    for w, n, got in zip(words, count, logs):
        ways = [(s, p[s].prod(axis=0)) for s in segmentations(b" " + w.encode(), pieces.number)]
        z = sum(x for _, x in ways)
        assert np.allclose(got, np.log(z), rtol=1e-10)
        for s, x in ways:
            for k in s:
                want[k] += n * x / z
    assert np.allclose(uses, want, rtol=1e-8, atol=1e-12)


def test_words_and_pieces_as_looked_up_one_by_one():
    import regex
    rnd = random.Random(8)
    texts = ["".join(map(chr, range(0x250)))] + ["".join(rnd.choices("aB é ÷×ªñß1_.\ń日ǅ", k=rnd.randint(0, 90))) for _ in range(400)]
    for t in texts:
        assert language_id._words(t) == regex.findall(r"\p{L}[\p{L}\p{M}]{0,31}", t.lower())
    pieces = language_id.Pieces(B)
    words = sorted({w for t in texts for w in language_id._words(t)} | {"international", "administration", "é" * 32, "unsupported"})
    seen = 0
    for some, ids in pieces.blocks(words, 2):
        for i, found in zip(some.tolist(), ids):
            c = b" " + words[i].encode()
            assert found.shape[0] == len(c)
            for at in range(len(c)):
                for k in range(1, found.shape[1] + 1):
                    assert found[at, k - 1] == (pieces.number.get(c[at:at + k], pieces.size) if at + k <= len(c) else pieces.size)
            seen += 1
    assert seen == len(words) and any(len(p) > 8 for p in pieces.number)


def test_language_accuracy_held_out(spark):
    folder = "/root/testdata/sf0.01"
    docs = table(spark, folder, "documents")
    got = language_id.op13_language_id(spark, folder)
    rows = got.join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    test = [r for r in rows if r["held_out"] and r["lang_pred"] != "und" and r["lang"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in test]) > 0.97


def test_language_of_hard_rows(spark, docs, empty):
    extra = spark.createDataFrame([(900 + i, t, l) for i, (t, l) in enumerate([
        ("straße übung " * 20, "de"), ("日本語 " * 30, "ja"), ("z" * 5000, "en"), ("123 !?", "en"), ("ǆ" + "́" * 100, None), (None, "fr"), ("Мир " * 9, "ru")])],
        "doc_id long, text string, lang string")
    all_rows = docs.select("doc_id", "text", "lang", "gone", "size").unionByName(extra, allowMissingColumns=True)
    model = language_id.fit(all_rows, B)
    got = {(r["doc_id"], r["lang_pred"]): r["score"] for r in language_id.predict(all_rows, model).collect()}
    assert {k for k, _ in got} == {r[0] for r in ROWS} | set(range(900, 907))
    assert {(901, "ja"), (906, "ru"), (903, "und"), (905, "und"), (10, "und"), (11, "und"), (13, "und")} <= set(got)
    assert all((s == 0) == (lang == "und") for (_, lang), s in got.items())
    assert model.langs == sorted({r[2] for r in ROWS if r[2]} | {"de", "ja", "en", "ru"})  # fr has no text
    assert np.allclose(model.p.sum(axis=0), 1)
    assert language_id.predict(empty, model).count() == 0
    nothing = language_id.fit(empty, B)
    assert {(r["lang_pred"], r["score"]) for r in language_id.predict(docs, nothing).collect()} == {("und", 0.0)}


def test_repeated_labels_do_not_reach_the_prediction(spark, sample):
    model = language_id.fit(sample, B)
    swapped = sample.selectExpr("doc_id", "text", "'xx' AS lang", "'q' AS source")
    a, b = (sorted(map(tuple, language_id.predict(d, model).collect())) for d in (sample, swapped))
    assert a == b
