"""Operators over the whole corpus: near-duplicates, substrings, language model, mixing, packing."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tripkit.llm import best_fit, fair_mix, ngram_score, simhash, substrings
from tripkit.llm.common import word_count
from tripkit.llm.elias_fano import EliasFano, Trie, expand
from tripkit.llm.near_classes import near_classes
from tripkit.llm.packs import distinct, order_of, token_numbers
from pyspark.sql import functions as F

from hard_rows import ROWS, SF, WORDS


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def groups(pairs, items):
    up = {i: i for i in items}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in items}


# ---- SimHash

def plain_simhash(text):
    import xxhash
    words = re.findall(WORDS, lower(text))
    parts = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_components_brute_force(docs, empty):
    few = [(i, t) for i, t, _, _ in ROWS if i not in (14, 15, 16)]
    prints = [plain_simhash(t) for _, t in few]
    n = len(few)
    comp = groups([(a, b) for a in range(n) for b in range(a) if bin(prints[a] ^ prints[b]).count("1") <= 3], range(n))
    least = {r: min((few[j][0] for j in range(n) if comp[j] == r and few[j][0] is not None), default=None) for r in set(comp.values())}
    want = sorted(((few[j][0], prints[j], least[comp[j]]) for j in range(n)), key=str)
    sub = docs.where("doc_id is null or doc_id not in (14, 15, 16)")
    got = sorted(((r[0], r[1] & (1 << 64) - 1, r[2]) for r in simhash.near_duplicates(sub).collect()), key=str)
    assert got == want
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and 14 in ids and 15 not in ids and 16 not in ids and 22 not in ids and None in ids
    assert simhash.keep_one(empty).count() == 0


def test_keep_one_decides_by_row(spark):
    texts = {c: " ".join(f"{c}{i * i}" for i in range(200)) for c in "pqrst"}
    rows = [(1, texts["p"]), (1, texts["q"]), (1, texts["p"]),  # one id, two clean texts
            (2, texts["r"]), (3, texts["r"]), (3, texts["s"]), (4, texts["s"]),  # 3 is smallest only with s
            (None, texts["t"]), (None, texts["t"]), (None, texts["t"]), (None, texts["r"])]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, texts["p"]), (1, texts["q"]), (2, texts["r"]), (3, texts["s"]), (None, texts["t"])], key=str)


@pytest.mark.parametrize("posting", [20_000, 40])
def test_links_keep_every_component(spark, posting):
    rng = np.random.default_rng(3)
    fps = set()
    for centre in rng.integers(-2**63, 2**63 - 1, 3).tolist():
        for _ in range(400):
            v = centre
            for b in rng.choice(64, rng.integers(0, 6), replace=False).tolist():
                v ^= 1 << b
            v &= 2**64 - 1
            fps.add(v - 2**64 if v >= 2**63 else v)
    x = np.array(sorted(fps), np.int64)
    u = x.view(np.uint64)
    pairs = [(int(x[i]), int(x[j])) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(u[i] ^ u[:i]) <= 3)]
    got = simhash.links(spark.createDataFrame([(int(v),) for v in x], "fp long"), 3, posting)
    comp = {r["node"]: r["root"] for r in simhash.components(got).collect()}
    want = groups(pairs, x.tolist())
    assert {i: comp.get(i, i) for i in want} == want


def test_large_group_by_differences_equals_pairs():
    rng = np.random.default_rng(5)
    x = np.unique(rng.integers(0, 2**14, 1500)).astype(np.int64)  # all equal but for two bytes
    a, b = simhash._posting_links(x, [0, 1, 2, 3, 4], 2)
    u = x.view(np.uint64)
    pairs = [(int(x[i]), int(x[j])) for i in range(len(x)) for j in np.flatnonzero(np.bitwise_count(u[i] ^ u[:i]) <= 2)]
    assert groups(zip(a.tolist(), b.tolist()), x.tolist()) == groups(pairs, x.tolist())


# ---- substrings

def plain_dedupe(rows, size):
    first = {}
    words = [re.findall(WORDS, t or "") for _, t in rows]
    big = float("inf")
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - size + 1):
            key = tuple(w[k:k + size])
            first[key] = min(first.get(key, big), big if i is None else i)
    out = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < (big if i is None else i):
                gone[k:k + size] = [True] * size
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("size,pack", [(50, 8 << 20), (5, 3000)])
def test_substrings_brute_force(docs, empty, size, pack):
    rows = [(i, t) for i, t, _, _ in ROWS]
    got = substrings.digests(docs, size, shard_bits=12, pack_bytes=pack).collect()
    assert sorted(map(tuple, got), key=str) == plain_dedupe(rows, size)
    assert substrings.digests(empty, size).count() == 0


def test_substring_filter_keeps_columns(docs, empty):
    out = substrings.dedupe(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    rows = {(r["doc_id"], r["n_chars"]): r for r in out.collect()}
    by_id = {r["doc_id"]: r for r in rows.values()}
    assert 15 not in by_id  # all of it is in document 14
    assert by_id[18]["text"] == "Other start" and by_id[18]["n_chars"] == 11
    assert by_id[13]["text"] == "\t \n" and by_id[11]["text"] is None
    assert substrings.dedupe(empty).count() == 0


# ---- language model

@pytest.mark.parametrize("n,top", [(0, 5), (1, 1), (1, 10**15), (700, 40), (700, 10**6), (3000, 2**60)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, top, n)).astype(np.uint64)
    e = EliasFano.build(v)
    assert (e.access(np.arange(n)) == v).all()
    if n:
        q = np.concatenate([v, rng.integers(0, top + 5, 500).astype(np.uint64), np.array([0, top, 2**63], np.uint64)])
        a = rng.integers(0, n + 1, len(q))
        b = np.maximum(a, rng.integers(0, n + 1, len(q)))
        assert (e.successor(q, a, b) == np.clip(np.searchsorted(v, q), a, b)).all()


def test_elias_fano_halves_crowded_buckets(monkeypatch):
    v = np.append(2 * np.arange(20_000), 2**50).astype(np.uint64)  # all but one value in one bucket
    e, low, looks = EliasFano.build(v), EliasFano._low, []
    monkeypatch.setattr(EliasFano, "_low", lambda self, i: looks.append(len(i)) or low(self, i))
    q = np.append(np.arange(40_001), 2**50).astype(np.uint64)
    a, b = np.zeros(len(q), np.int64), np.full(len(q), len(v))
    assert (e.successor(q, a, b) == np.searchsorted(v, q)).all()
    at = e.find(q, a, b)
    assert (at[at >= 0] == np.flatnonzero(np.isin(v, q))).all() and (q[at >= 0] == v[at[at >= 0]]).all() and (at >= 0).sum() == len(v)
    assert len(looks) <= 40  # by halves, not one value after the other


@pytest.mark.parametrize("n", [0, 1, 2, 700, 5000])
@pytest.mark.parametrize("top", [1, 40, 2**40, 2**64 - 1])
def test_distinct_numbers(n, top):
    x = np.random.default_rng(n).integers(0, top, n, np.uint64)
    x[::3] = x[:1]
    x[5:300] -= np.minimum(x[5:300], np.arange(len(x[5:300]), dtype=np.uint64))
    if top > 2**63:  # values that differ in their last bits only, falling
        x[300:600] = np.uint64(2**63) + np.arange(len(x[300:600]), dtype=np.uint64)[::-1]
    assert (order_of(x) == np.argsort(x, kind="stable")).all()
    for got, want in zip(distinct(x), np.unique(x, return_inverse=True)):
        assert (got == want).all()


@pytest.mark.parametrize("low", [False, True])
def test_token_numbers_split_as_bytes_do(low):
    texts = [None, "", " ", "Ab ab\tAB\n", "\x1c\x85a\xa0b \x0b\x0cÉ É\rİ\x00 K", "no", "  two  \r\n spaces", "\x1f"]
    want = [(w.lower() if low else w).split() for w in ((t or "").encode() for t in texts)]
    for a, b in ((0, 8), (0, 3), (3, 4), (0, 0), (5, 6)):
        numbers, sizes, words = token_numbers(pa.array(texts, pa.string())[a:b], low)
        flat = [w for x in want[a:b] for w in x]
        assert [words[i] for i in numbers] == flat and sizes.tolist() == [len(x) for x in want[a:b]]
        assert words == list(dict.fromkeys(flat))


def test_trie_holds_smoothed_probabilities():
    rng = np.random.default_rng(1)
    pairs = sorted({(int(c), int(f)) for c, f in zip(rng.integers(0, 2**63, 60).repeat(30), rng.integers(0, 2**40, 400)[rng.integers(0, 400, 1800)])})
    c, f = (np.array(x, np.uint64) for x in zip(*pairs))
    count = rng.integers(1, 9, len(c))
    trie = Trie.build(c, f, count, 0.75).mapped()
    total, types = defaultdict(int), Counter(c.tolist())
    for x, n in zip(c.tolist(), count.tolist()):
        total[x] += n
    own, ci = np.unique(c, return_inverse=True)
    words, fi = np.unique(f, return_inverse=True)
    p, rest = trie.query(own, words, ci, fi)
    assert np.allclose(expand(p), [(n - 0.75) / total[x] for x, n in zip(c.tolist(), count.tolist())], rtol=3e-4)  # half a step of 1/4096 decade
    assert np.allclose(expand(rest), [0.75 * types[x] / total[x] for x in own.tolist()], rtol=3e-4)
    p, rest = trie.query(np.array([own[0], 1], np.uint64), np.array([2**41, f[0]], np.uint64), np.array([0, 0, 1]), np.array([0, 1, 1]))
    assert p[0] == p[2] == 0xFFFF and p[1] != 0xFFFF and rest[1] == 0xFFFF
    assert trie.n_bytes < 16 * len(c)


def plain_scores(rows, order):
    toks = [re.findall(WORDS, lower(t)) + ["</s>"] for _, t in rows]
    train = [zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2 for i, _ in rows]
    c1 = Counter(w for t, ok in zip(toks, train) if ok for w in t)
    n, v = sum(c1.values()), len(c1)
    levels = {}
    for m in range(2, order + 1):
        levels[m] = defaultdict(Counter)
        for t, ok in zip(toks, train):
            full = ["<s>"] * (m - 1) + t
            for k in range(m - 1, len(full)) if ok else ():
                levels[m][tuple(full[k - m + 1:k])][full[k]] += 1
    sums = {m: {c: sum(f.values()) for c, f in x.items()} for m, x in levels.items()}
    out = []
    for (i, _), t, ok in zip(rows, toks, train):
        base = model = 0.0
        full = ["<s>"] * (order - 1) + t
        for k in range(order - 1, len(full)):
            w = full[k]
            p = (c1[w] + 1) / (n + v + 1)
            base += math.log10(p)
            for m in range(2, order + 1):
                ctx = tuple(full[k - m + 1:k])
                if ctx in sums[m]:
                    f, s = levels[m][ctx], sums[m][ctx]
                    p = max(f[w] - 0.75, 0) / s + 0.75 * len(f) / s * p
            model += math.log10(p)
        out.append((i, not ok, len(t), sum(c1[w] > 0 for w in t), n, base, model))
    return sorted(out, key=str)


@pytest.mark.parametrize("order,pack,entries", [(2, 24 << 20, 1_500_000), (2, 4000, 3000), (3, 4000, 3000)])
def test_scores_brute_force(docs, empty, order, pack, entries):
    want = plain_scores([(i, t) for i, t, _, _ in ROWS], order)
    got = sorted(map(tuple, ngram_score.score(docs, order, pack_bytes=pack, shard_entries=entries).collect()), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert math.isclose(g[5], w[5], rel_tol=1e-9) and abs(g[6] - w[6]) <= 2e-4 * w[2]
    assert ngram_score.score(empty, order).count() == 0


def test_query_scores_with_trigrams(spark, sample):
    rows = [(r["doc_id"], r["text"]) for r in sample.select("doc_id", "text").collect()]
    want = plain_scores(rows, 3)
    got = sorted(map(tuple, ngram_score.op1_ngram_trie(spark, SF).collect()), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[6] - w[6]) <= 3e-4 * w[2] for g, w in zip(got, want))


# ---- mixing

def test_mix_targets_and_copies(docs, empty, sample):
    for d in (docs.select("doc_id", "source", word_count(F.col("text")).alias("size")),
              sample.select("doc_id", "source", word_count(F.col("text")).alias("size"))):
        mix = fair_mix.FairMix(d, rows_per_bucket=50)
        taken = sum((F.when(t, F.col("q_size")).otherwise(0) for t in mix.copies_taken()), F.lit(0))
        rows = mix.queue(mix.rows, F.col("size")).select("q_key", "size", "source_size", "target", taken.alias("taken")).collect()
        by = defaultdict(list)
        for r in rows:
            by[r["q_key"]].append(r)
            assert r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"]
        total = sum(r["size"] for r in rows)
        assert math.isclose(sum(x[0]["target"] for x in by.values()), 1.5 * total)
        assert sum(r["taken"] for r in rows) <= 1.5 * total
        for x in by.values():
            assert abs(sum(r["taken"] for r in x) - x[0]["target"]) <= 2 * max(r["size"] for r in x) + 1
    again = fair_mix.FairMix(d, rows_per_bucket=50)
    assert again.cut == mix.cut
    out = fair_mix.FairMix(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))).mixed(docs, word_count(F.col("text")))
    assert out.columns == docs.columns and max(Counter(r["doc_id"] for r in out.collect()).values()) <= 4
    none = fair_mix.FairMix(empty.select("doc_id", "source", F.lit(0).alias("size")))
    assert none.mixed(empty, F.lit(0)).count() == 0


# ---- packing

def check_bins(rows, capacity, per_source):
    bins = defaultdict(list)
    for r in rows:
        bins[r["bin_id"]].append(r)
    for x in bins.values():
        x.sort(key=lambda r: r["slot"])
        assert [r["slot"] for r in x] == list(range(len(x)))
        assert [r["bin_start"] for r in x] == [sum(y["n_words"] for y in x[:k]) for k in range(len(x))]
        assert sum(r["n_words"] for r in x) <= capacity
        clusters = [r["cluster"] for r in x if r["cluster"] is not None]
        assert len(clusters) == len(set(clusters))
        assert max(Counter(r["source"] for r in x).values()) <= per_source
    return bins


def test_packing_whole_and_without_conflicts(docs, empty, sample):
    for d, cap in ((docs, 100), (sample, 2048)):
        rows = best_fit.pack_documents(d, cap).collect()
        check_bins(rows, cap, best_fit.MAX_PER_SOURCE)
        words = sum(len(re.findall(WORDS, r["text"] or "")) for r in d.select("text").collect())
        assert sum(r["n_words"] for r in rows) == words
        assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter(r["doc_id"] for r in d.select("doc_id").collect())
    assert best_fit.pack_documents(empty).count() == 0


def test_near_copies_never_share_a_bin(spark):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(40):
        words = [f"w{x}" for x in rng.integers(0, 5000, 60 + g)]
        changed = words[:20] + ["changed"] + words[21:]
        for k, t in enumerate((" ".join(words), "  ".join(words), " ".join(words).title(), " ".join(changed))):
            rows.append((4 * g + k, t, f"s{k}"))
    rows += [(900 + i, " \t", "e") for i in range(3)] + [(910, "", "e"), (911, None, None)]
    got = best_fit.pack_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    bins = {r["doc_id"]: r["bin_id"] for r in got}
    assert all(len({bins[4 * g + k] for k in range(4)}) == 4 for g in range(40))
    cluster = {r["doc_id"]: r["cluster"] for r in got}
    assert len({cluster[4 * g] for g in range(40)}) == 40 and cluster[900] == cluster[902] and cluster[910] is cluster[911] is None


def test_near_classes_find_the_pairs_of_an_all_pairs_search(spark):
    """Five-word shingles, Jaccard 0.8 or more, over every text of a table; and the hard rows."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    near = {r["doc_id"]: r["near_class"] for r in near_classes(docs).select("doc_id", "near_class").collect()}
    texts = {r["doc_id"]: (r["text"] or "").lower().split() for r in docs.select("doc_id", "text").collect()}
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} for i, w in texts.items() if w}
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    shared = Counter((a, b) for ids in holders.values() if 1 < len(ids) <= 200 for k, a in enumerate(ids) for b in ids[:k])
    pairs = [(a, b) for (a, b), n in shared.items() if texts[a] != texts[b] and n >= 0.8 * (len(sets[a]) + len(sets[b]) - n)]
    assert len(pairs) >= 10 and np.mean([near[a] == near[b] for a, b in pairs]) >= 0.9
    equal = defaultdict(set)
    for i, w in texts.items():
        if w:
            equal[tuple(w)].add(near[i])
    assert all(len(c) == 1 for c in equal.values())


def test_near_classes_of_hard_rows(docs, empty):
    got = [(r["doc_id"], r["near_class"]) for r in near_classes(docs).collect()]
    assert Counter(i for i, _ in got) == Counter(r[0] for r in ROWS)
    by = defaultdict(set)
    for i, c in got:
        by[i].add(c)
    assert by[14] == by[15] == by[16]  # one word more
    assert len(by[23]) == 1 and by[21] == by[22] and by[10] == by[11] == {None} and by[17] != by[20]
    assert near_classes(empty).count() == 0


def plain_best_fit(items, capacity, most):
    bins, out = [], []
    repeats = Counter(c for _, c, _ in items)
    for size, c, s in items:
        fits = [(b["left"], b["at"], k) for k, b in enumerate(bins)
                if b["left"] >= size and not (repeats[c] > 1 and c in b["c"]) and b["s"].count(s) < most]
        if not fits:
            bins.append({"left": capacity, "c": [], "s": [], "at": 0})
        k = min(fits)[2] if fits else len(bins) - 1
        b = bins[k]
        b["left"] -= size
        b["at"] = len(out)
        b["c"].append(c)
        b["s"].append(s)
        out.append(b["left"])
    return out, len(bins)


def test_bins_take_the_tightest_compatible():
    rng = np.random.default_rng(9)
    for _ in range(30):
        items = sorted(((int(a), int(b), str(c)) for a, b, c in zip(rng.integers(1, 60, 300), rng.integers(0, 80, 300), rng.integers(0, 6, 300))),
                       key=lambda x: (-x[0], x[1], x[2]))
        got = best_fit.pack_group(items, 100, 2)
        want, n = plain_best_fit(items, 100, 2)
        assert [100 - start - it[0] for (_, _, start), it in zip(got, items)] == want and len({g[0] for g in got}) == n
    copies = [(30, 1, "s")] * 500
    assert len({b for b, _, _ in best_fit.pack_group(copies, 100, 2)}) == 500


def test_mix_repeats_whatever_the_partitioning(spark):
    """Rows of one id and size but different texts, a third of all under one id."""
    rows = [(1, f"word{i} other{i * i}", "en", "a", 9) for i in range(40)] + [(None, f"lost{i} x", "en", "a", 9) for i in range(20)] + [
        (i, f"b{i} c d", "de", "b", 9) for i in range(60)] + [(7, "same text", lang, "a", 9) for lang in ("en", "de", "fr", None)]
    outs = []
    for parts in (1, 7):
        d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").repartition(parts)
        size, mark = word_count(F.col("text")), fair_mix.text_mark(F.col("text"))
        mix = fair_mix.FairMix(d.select("doc_id", "source", size.alias("size"), mark.alias("mark")), share=0.5, rows_per_bucket=10)
        outs.append([tuple(r) for r in mix.mixed(d, size, mark).collect()])
        buckets = mix.queue(mix.rows, F.col("size")).groupBy("q_key", "q_bucket").count().agg(F.max("count")).first()[0]
        assert buckets <= 12  # the rows of one id are dealt over many buckets
    assert outs[0] == outs[1] and len(outs[0]) < len(rows)


def test_keep_one_of_equal_rows_and_of_other_columns(spark):
    rows = [(5, "some text of a few words", x) for x in ("b", "a", "a", None)] + [(None, None, "z")] * 3 + [(None, "", "z")] * 2 + [(9, "other words entirely here", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, place string").repartition(4)
    a, b = (sorted(map(tuple, simhash.keep_one(d).collect()), key=str) for d in (df, df.repartition(2)))
    assert a == b and len(a) == 3 and [r[0] for r in a] == [5, 9, None]
    plan = simhash.keep_one(df.where("doc_id = 9"))._jdf.queryExecution().toString()
    assert "ShuffledHashJoin" in plan or "BroadcastHashJoin" in plan or "shuffle_hash" in plan
