"""Operators that judge or encode single texts: quality rules, token files, fingerprints."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripkit.llm import ctph, decision_list, orc_tokens
from tripkit.llm.common import table, work_path

from hard_rows import ROWS, SF, WORDS

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def plain_stats(text):
    text = text or ""
    words = re.findall(WORDS, text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w in set(windows) if windows.count(w) > 1} if len(windows) < 3000 else None
    if often is None:
        from collections import Counter
        often = {w for w, n in Counter(windows).items() if n > 1}
    hit = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(WORDS, line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_stats_match_plain_rules(docs):
    got = decision_list.judge(docs.select("doc_id", "text"), [], "q").select("doc_id", "text", "q.*", "base_failed", "kept").collect()
    assert len(got) == len(ROWS)
    for r in got:
        want = plain_stats(r["text"])
        assert tuple(r[c] for c in decision_list.STATS[:5]) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert (r["base_failed"], r["kept"]) == (failed, not failed)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n\t#é ", max_size=60))
def test_text_stats_property(text):
    assert decision_list.text_stats(text)[:5] == plain_stats(text)


def test_list_learns_planted_rule_and_filters(spark, docs, empty):
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(decision_list.FEATURES)))
    bad = (x[:, 2] > 0.8) | ((x[:, 4] > 0.5) & (x[:, 6] > 0.7))
    rules = decision_list.learn(x, bad)
    names = list(decision_list.FEATURES)
    hit = np.zeros(len(x), bool)
    for rule in rules:
        ok = np.ones(len(x), bool)
        for f, op, t in rule.tests:
            ok &= (x[:, names.index(f)] > t) if op == ">" else (x[:, names.index(f)] <= t)
        hit |= ok
    assert (hit == bad).mean() > 0.97
    assert decision_list.learn(x[:0], bad[:0]) == [] and decision_list.learn(x, bad & False) == []
    out = decision_list.filter_documents(docs, rules)
    assert out.columns == docs.columns and out.count() <= docs.count()
    assert decision_list.filter_documents(empty, rules).count() == 0


def test_held_out_accuracy(spark, sample):
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    big = table(spark, "/root/testdata/sf0.01", "documents")
    rules = decision_list.fit(big, labels.where("doc_id % 2 = 0"))
    got = decision_list.judge(big, rules, "q").join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").select("kept", "quality").collect()
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in got]) > 0.95
    assert decision_list.fit(big, labels.where("false")) == []


def test_token_files_round_trip(spark, docs, empty):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(TOKENIZER)
    tok.encode_special_tokens = True
    path = work_path(spark, "tokens")
    orc_tokens.write_tokens(docs, path, TOKENIZER)
    rows = orc_tokens.read_tokens(spark, path)
    ordered = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    ids = [tok.encode(t or "", add_special_tokens=False).ids + [0] for _, t, _, _ in ordered]
    got = [r["ids"] for r in rows.orderBy("part", "pos").collect()]
    assert got == ids
    want, start = [], 0
    for (i, *_), x in zip(ordered, ids):
        want.append((i, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    assert sorted(map(tuple, orc_tokens.token_digests(rows).collect()), key=str) == sorted(want, key=str)
    found = orc_tokens.read_tokens(spark, path, [17, 999])
    assert [r["doc_id"] for r in found.collect()] == [17]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    none = work_path(spark, "tokens")
    orc_tokens.write_tokens(empty, none, TOKENIZER)
    assert orc_tokens.token_digests(orc_tokens.read_tokens(spark, none)).count() == 0


def test_encoder_equals_whole_texts():
    enc = orc_tokens.Encoder(TOKENIZER)
    rnd = random.Random(2)
    parts = ["a", "b", " ", "\n", "\t", "'s", "1", "é", "!", "<|endoftext|>", "\x85", "\x1c", "the", "　", "\r", "Ġ"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 14))) for _ in range(5000)] + [None, ""]
    for _ in range(2):  # the second time from memory
        ids, n = enc.encode(pa.array(texts))
        for t, got in zip(texts, np.split(ids, np.cumsum(n)[:-1])):
            assert got.tolist() == enc.tok.encode(t or "", add_special_tokens=False).ids


def test_encoder_with_special_tokens_as_the_library():
    from tokenizers import Tokenizer
    plain, enc = Tokenizer.from_file(TOKENIZER), orc_tokens.Encoder(TOKENIZER, plain_special=False)
    rnd = random.Random(3)
    parts = ["a", "b", " ", " ", "\n", "the", "é", "!", "<|endoftext|>", "<|endoftext", "|>"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 12))) for _ in range(3000)] + ["x <|endoftext|> y", None]
    for _ in range(2):
        ids, n = enc.encode(pa.array(texts))
        for t, got in zip(texts, np.split(ids, np.cumsum(n)[:-1])):
            assert got.tolist() == plain.encode(t or "", add_special_tokens=False).ids
    assert 50256 in plain.encode("x <|endoftext|> y", add_special_tokens=False).ids


def test_query_encodes_as_the_library(spark, monkeypatch):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(TOKENIZER)
    docs = spark.createDataFrame([(1, "x <|endoftext|> y")], "doc_id long, text string")
    monkeypatch.setattr(orc_tokens, "table", lambda *_: docs)
    ids = tok.encode("x <|endoftext|> y", add_special_tokens=False).ids + [0]
    assert [tuple(r) for r in orc_tokens.op5_orc_tokens(spark, SF).collect()] == [(1, 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))]


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc", max_size=70), st.text(alphabet="abc", max_size=70))
def test_edit_distance(a, b):
    assert ctph.edit_distance(a, b) == plain_distance(a, b)


def test_fingerprints_follow_content(sample):
    texts = [r["text"] for r in sample.select("text").collect() if r["text"] and len(r["text"]) > 400]
    near = [ctph.likeness(ctph.fingerprint(t), ctph.fingerprint(t[:len(t) // 2] + " edit " + t[len(t) // 2:])) for t in texts]
    far = [ctph.likeness(ctph.fingerprint(a), ctph.fingerprint(b)) for a, b in zip(texts, texts[1:]) if a != b]
    assert np.median(near) > 0.85 and np.percentile(far, 95) < 0.3
    assert ctph.fingerprint("") == ctph.fingerprint(None) and ctph.likeness("2::", "2::") == 1.0
    assert max(len(s) for t in texts for s in ctph.fingerprint(t).split(":")[1:]) <= ctph.MAX_CHUNKS + 1


def test_fingerprints_of_repetitive_texts():
    passage = " ".join(f"part{i}" for i in range(40))
    for unit in ("Retionly ", "ab", "x", "A line that repeats.\n", passage + "\n"):
        text = "An opening line. " + unit * (12_000 // len(unit))
        other = " ".join(f"other{i}" for i in range(2000))
        print_ = ctph.fingerprint(text)
        assert all(len(s) >= 20 for s in print_.split(":")[1:2]) and len(print_.split(":")[1]) <= ctph.MAX_CHUNKS
        assert ctph.likeness(print_, ctph.fingerprint(ctph.edited(text, other))) > 0.45  # two thirds are left
        half = len(text) // 2
        assert ctph.likeness(print_, ctph.fingerprint(text[:half] + " edit " + text[half:])) > 0.75
        assert ctph.likeness(print_, ctph.fingerprint(other)) < 0.3


def test_no_signature_of_one_character():
    prints = [ctph.fingerprint(chr(c)) for c in range(128)]
    assert len(set(prints)) == 128
    assert all(len(s) > 1 for n in range(1, 80) for s in ctph.fingerprint("z" * n).split(":")[1:])


@pytest.mark.parametrize("ranges", [1, 7])
def test_compare_next_brute_force(docs, empty, ranges):
    order = sorted(ROWS, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    want = []
    for k, (i, t, _, _) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        e = t[:len(t) - len(t) // 3] + nxt[:len(t) // 3]
        a, b = ctph.fingerprint(t), ctph.fingerprint(e)
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, ctph.likeness(a, b), ctph.likeness(a, ctph.fingerprint(nxt))))
    got = [tuple(r) for r in ctph.compare_next(docs, ranges).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert ctph.compare_next(empty, ranges).count() == 0
    one = docs.where("doc_id = 17")
    assert ctph.compare_next(one).first()["near_next"] == 1.0
    assert ctph.fingerprints(docs).count() == len(ROWS)


def test_small_table_whole_query(spark):
    assert table(spark, SF, "documents").count() == ctph.op2_ctph(spark, SF).count()
