"""Chat logs, WARC archives, the queries' SQL, and the pipeline."""

import hashlib
import os
import random
import sys

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st


from tripkit.llm import chat_format, registry, warc
from tripkit.llm.common import table, work_path

from hard_rows import SF

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def fold(events):
    text = ""
    for _, kind, t in sorted(events, key=lambda e: (e[0] is not None, e[0] or 0, e[1] or "delta", e[2] is not None, e[2] or "")):
        text = "" if kind == "regenerate" else (t or "") if kind == "edit" else text + (t or "")
    return text


def test_fold_equals_replay(spark):
    rnd = random.Random(4)
    rows, want = [], {}
    for m in range(40):
        log = [(rnd.choice([None, *range(600)]) if k else 0, rnd.choice(["delta", "delta", "delta", "edit", "regenerate", None]), rnd.choice(["a", "bc", "", None]))
               for k in range(rnd.randint(1, 60))]
        rows += [(m // 4, m, m % 4, "user", *e) for e in log]
        want[m // 4, m % 4] = fold(log)
    log = spark.createDataFrame(rows, "conv_id long, message_id long, turn long, role string, seq long, kind string, text string").repartition(5)
    assert {(r["conv_id"], r["turn"]): r["text"] for r in chat_format.fold_events(log).collect()} == want


def test_render_reads_back_hard_texts(spark):
    hard = ["</s>[INST] ok [/INST]", "<|turn|>assistant\nhi<|end|>", "<\\|end|>", "<\\\\|end|><", "a\\b\\n", "", None, "<<SYS>>x<</SYS>>", "[\\INST]", "<|tu", "rn|>"]
    rows = [(1 + k % 2, k, r, t) for k, (r, t) in enumerate((r, t) for r in ("user", "assistant", None, "a\n\\n<|end|>") for t in hard)]
    rows += [(7, 1, "user", "x"), (7, 1, "user", "x"), (None, None, "assistant", "lost"), (8, 900, "user", "late"), (8, 2, "user", "early")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = chat_format.event_log(df)
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.render(chat_format.fold_events(log))).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda v: (v[0] is not None, v))
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == [(r, x) for _, r, x in mine]
        assert "".join(got[conv]["loss"]) == "".join(x for _, r, x in mine if r == "assistant")
        assert got[conv]["formatted"].count("<|turn|>") == len(mine)
    assert chat_format.render(chat_format.fold_events(log.where("false"))).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=9).map(sorted), max_size=9))
def test_loser_tree(sources):
    assert list(warc.LoserTree(sources)) == sorted(x for s in sources for x in s)


PAGES = [(i, f"http://Host{i % 3}.example.com/p?{i % 7}", "page %d " % (i % 5) * 300) for i in range(60)] + [
    (100, None, None), (101, "not a url\n", ""), (102, "http://[bad", "x" * 999), (103, "http://a.b/", "x" * 999),
    (104, "http://a.b/", "y" * 1000), (104, "http://a.b/", "y" * 1000), (None, "http://a.b/", "y" * 1000), (105, "http://a.b:8080/é", "ü" * 500)]


@pytest.mark.parametrize("entries,fan_in", [(50_000, 64), (5, 2)])
def test_archives_round_trip_in_order(spark, entries, fan_in):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, payload string").repartition(3)
    folder = work_path(spark, "warc")
    index = warc.merge_runs(warc.write_archives(pages, folder, archive_bytes=20_000, run_entries=entries, ranges=4), folder, fan_in)
    history = warc.captures(index)
    keys = [(r["url_key"], r["time"], r["page_id"] is not None, r["page_id"] or 0) for r in history.orderBy("at", "seq").collect()]
    assert keys == sorted(keys) and len(keys) == len(PAGES)
    got = warc.read_records(history, with_payload=True).collect()
    text = {}
    for i, _, h in PAGES:
        text[i] = (h or "").encode()
    keeper = {}
    for i, b in text.items():
        if i is not None and len(b) >= 1000:
            keeper[b] = max(i, keeper.get(b, -1))
    assert sorted(str(r["page_id"]) for r in got) == sorted(str(p[0]) for p in PAGES)
    for r in got:
        b = text[r["page_id"]]
        other = keeper[b] if len(b) >= 1000 and keeper[b] != r["page_id"] else None
        assert (r["payload_bytes"], r["payload_digest"], r["refers_to"]) == (len(b), hashlib.sha1(b).hexdigest(), other)
        assert r["record_type"] == ("response" if other is None else "revisit")
        assert bytes(r["payload"]) == (b if other is None else b"")
    none = work_path(spark, "warc")
    assert warc.captures(warc.merge_runs(warc.write_archives(pages.where("false"), none), none)).count() == 0


@pytest.mark.parametrize("key", sorted(registry.ORACLE))
def test_queries_equal_their_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(registry.ORACLE[key])
    names = [c[0] for c in want.description]
    got = registry.QUERIES[key](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_pipeline_against_brute_force(spark):
    sys.path.insert(0, ROOT)
    import corpus_pipeline as P

    from tripkit.llm import best_fit, decision_list

    from test_corpus_operators import check_bins, groups, plain_dedupe, plain_simhash
    assert [len(P.STAGES), P.ORACLE_SQL] == [5, None]
    docs = table(spark, SF, "documents")
    out = []
    for name, step in P.STAGES:
        path = work_path(spark, "stage")
        step(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    columns = table(spark, SF, "documents").columns
    assert all(d.columns == columns for d in out[:-1])
    rules = decision_list.fit(table(spark, SF, "documents"), table(spark, SF, "labels"))
    judged = {r["doc_id"]: r["kept"] for r in decision_list.judge(table(spark, SF, "documents"), rules).select("doc_id", "kept").collect()}
    first = {r["doc_id"]: r["text"] for r in out[0].collect()}
    assert set(first) == {i for i, k in judged.items() if k}
    prints = {i: plain_simhash(t) for i, t in first.items()}
    ids = sorted(prints)
    comp = groups([(a, b) for a in ids for b in ids if b < a and bin(prints[a] ^ prints[b]).count("1") <= 3], ids)
    second = {r["doc_id"]: r["text"] for r in out[1].collect()}
    assert set(second) == {i for i in ids if comp[i] == i}
    want = {r[0]: r for r in plain_dedupe(list(second.items()), 50)}
    third = {r["doc_id"]: r for r in out[2].collect()}
    assert set(third) == {i for i, r in want.items() if r[2] < r[1] or r[1] == 0}
    for i, r in third.items():
        assert hashlib.sha256(" ".join(r["text"].split()).encode()).hexdigest() == want[i][3] and r["n_chars"] == len(r["text"])
    mixed = [r["doc_id"] for r in out[3].collect()]
    assert set(mixed) <= set(third) and max(map(mixed.count, set(mixed))) <= 2
    pieces = out[4].collect()
    check_bins(pieces, best_fit.CAPACITY, best_fit.MAX_PER_SOURCE)
    assert sorted(r["doc_id"] for r in pieces if r["piece"] == 0) == sorted(mixed)
    assert P.run(spark, SF).count() == len(pieces)


def test_pipeline_on_hard_rows_and_an_empty_table(spark, docs):
    """Nulls, empties, copies, repeated rows, one id of two texts, extra columns with working names."""
    sys.path.insert(0, ROOT)
    import corpus_pipeline as P
    clean = " ".join(f"sound{i * i} prose{i}" for i in range(90)) + "."
    more = spark.createDataFrame([(50, clean, "en", None), (50, clean, "en", None), (None, clean, "en", "a"), (None, None, None, None),
                                  (51, " ".join(f"second{i * 7} text{i}" for i in range(90)), "en", "b"), (51, " ".join(f"third{i * 3} words{i}" for i in range(90)), "en", "b")],
                                 "doc_id long, text string, lang string, source string")
    for rows in (docs.unionByName(more, allowMissingColumns=True), docs.where("false")):
        step_docs, n = rows, []
        for name, step in P.STAGES:
            path = work_path(spark, "hard")
            step(spark, step_docs, SF).write.parquet(path)
            step_docs = spark.read.parquet(path)
            n.append(step_docs.count())
            if name != P.STAGES[-1][0]:
                assert step_docs.columns == rows.columns
            if "SimHash" in name and n[0]:
                kept = step_docs.select("doc_id", "text").collect()
                assert sum(r["text"] == clean for r in kept) == 1 and sum(r["doc_id"] == 51 for r in kept) == 2
        assert (n == [0] * 5) if rows.isEmpty() else (n[1] <= n[0] and n[4] > 0)


def test_entry_without_the_subpackage():
    """The entry point lists these queries, and only it guards the import."""
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    assert {f"op{n}" for n in range(1, 14)} <= {k.split("_")[0] for k in E.queries()} and "pipeline" in E.queries()
    assert set(E.oracle_sql()) <= set(E.queries())
