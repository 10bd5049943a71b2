"""LM scoring with an Elias-Fano n-gram trie.

The model interpolates absolute-discounted n-grams: p(w | context) =
(c - D) / c(context) + rest(context) * p(w | shorter context), down to unigrams
(c + 1) / (N + V + 1). It is learned from the training documents of the whole
table and cut into shards by context, each an Elias-Fano trie (words, contexts,
monotone pointers, context-relative followers, quantised probabilities) that a
task builds, memory-maps and queries by successor search.

A pack of documents sends a shard its distinct n-grams with their training
counts, and gets the codes of the probabilities back; so an n-gram counts once
a pack however frequent it is, and every shard has about ``SHARD_ENTRIES``
n-grams, more shards for more text. A context that would outgrow a shard (found
from a bounded sample of texts, which decides on places only, never on counts)
is cut by follower: each part scales its probabilities by its own total, and
the few totals are combined at the end. Levels are sent one after the other from the
staged packs, so one level's messages are on disk at a time; their answers travel back in
one more shuffle. The driver sees N, V and the totals of the cut contexts.

Production order is 3: contexts are of one and of two words. ``order`` is a parameter.
Words are known by 64-bit hashes, inside a context by the first 40 bits.

Defined results: null and empty texts are the end token alone; a null id counts
as the empty string for the split and trains the model; repeated rows are
scored and counted each; an empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm.common import stage, table
from tripkit.llm.elias_fano import NONE, Trie, expand
from tripkit.llm.packs import (MESSAGE, apart, batched, by_group, deltas, distinct, grouped, messages, order_of, several, squeeze, token_numbers, undeltas,
                               unsqueeze)

ORDER = 3
DISCOUNT = 0.75
PACK_BYTES = 12 << 20
#: Distinct n-grams of all packs aimed at in one shard.
SHARD_ENTRIES = 750_000
#: Bound of the sample that finds large contexts: documents, and characters of each.
SAMPLE_DOCS, SAMPLE_CHARS = 2_000, 20_000
#: Hashes of the end and of the start token (no word is empty or a space).
_END, _START = 0xEF46DB3751D8E999, 0x9FB21C651E98DF25
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SELF, _WORDS = 0, 1  # message kinds: to its own pack; to a shard


def is_training(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 != 2


def _word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest
    return np.fromiter((xxh64_intdigest(w, 1) for w in words), np.uint64, len(words))


def _longer(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a context with one more word before it."""
    x = (context ^ (word * _MIX)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(29))


class _Sequence:
    """Token ranks of a pack: all documents in a row, each with its end token. Ranks follow the
    order of the word hashes."""

    def __init__(self, seq: np.ndarray, lens: np.ndarray, start: int, n_words: int, hashes: np.ndarray):
        self.seq, self.lens, self.start, self.n_words, self.hashes = seq, lens, start, n_words, hashes
        self.first = np.cumsum(lens) - lens
        self.bits = np.int64(n_words.bit_length())

    def back(self, k: int) -> np.ndarray:
        """Rank of the token k places before each, the start token beyond a document's beginning."""
        out = np.full(len(self.seq), self.start, self.seq.dtype)
        out[k:] = self.seq[:-k]
        for j in range(k):
            out[(self.first + j)[j < self.lens]] = self.start
        return out

    def contexts(self, order: int):
        """For n = 2 to ``order``: (sorted context hashes, number of each token's context)."""
        h = None
        for n in range(2, order + 1):
            before = self.back(n - 1)
            if n == 2:
                h = self.hashes[before]
                yield self.hashes, before.astype(np.int64)
            else:
                h = _longer(h, self.hashes[before])
                yield distinct(h)

    def keys(self, mine: np.ndarray) -> np.ndarray:
        """Key of each token's n-gram in the pack: context number, then word rank in ``bits`` bits."""
        return mine << self.bits | self.seq


def _plan(docs: DataFrame, order: int, shard_entries: int) -> tuple[int, dict[tuple[int, int], tuple[int, int]]]:
    """Number of shards a level, and the contexts to cut: (level, hash) -> (number, parts)."""
    n = docs.count()
    few = docs.select(F.substring("text", 1, SAMPLE_CHARS).alias("t"), F.length("text").alias("n")).sample(min(1.0, SAMPLE_DOCS / max(1, n)), 5).limit(SAMPLE_DOCS).collect()
    counts: dict[tuple[int, int], int] = {}
    tokens = full = 0.0
    for row in few:
        words = (row["t"] or "").encode("utf-8", "surrogatepass").lower().split()
        hashes = np.append(np.full(order - 1, _START, np.uint64), _word_hashes(words))
        tokens += len(words) + 1
        full += (len(words) + 1) * max(1.0, (row["n"] or 0) / max(1, len(row["t"] or "")))
        for level in range(2, order + 1):
            m = len(words) + 1  # contexts of the words and of the end
            h = hashes[order - 2:order - 2 + m]
            for back in range(2, level):
                h = _longer(h, hashes[order - 1 - back:order - 1 - back + m])
            for x in h.tolist():
                counts[level, x] = counts.get((level, x), 0) + 1
    total = full / max(1, len(few)) * n
    shards = int(max(1, -(-total // shard_entries)))
    large = sorted(((c, k) for k, c in counts.items() if c / tokens > 0.5 / shards and c >= 20), reverse=True)
    return shards, {k: (i, int(2 * shards * c / tokens) + 1) for i, (c, k) in enumerate(large)}


def _home(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of a hash; follows the order of the hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _runs(a: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values, and the length."""
    return np.concatenate([[0], np.flatnonzero(a[1:] != a[:-1]) + 1, [len(a)]]) if len(a) else np.zeros(1, np.int64)


def _own_packs(docs: DataFrame, pack_bytes: int) -> DataFrame:
    """Staged (pack, shard, kind, data): every pack's documents as token ranks; kind 9 rows count training tokens."""
    def run(batches):
        for pack, _, whole in grouped(batches, 1, pack_bytes):
            ids, texts = whole.column(0).combine_chunks(), whole.column(1).combine_chunks()
            x, lens, words = token_numbers(texts, lower=True)
            n_words, hashes = len(words), np.append(_word_hashes(words), np.array([_END, _START], np.uint64))
            del texts, words
            by = order_of(hashes)
            rank = np.empty(len(by), np.uint32)
            rank[by] = np.arange(len(by), dtype=np.uint32)
            seq, lens = np.insert(rank[x], np.cumsum(lens), rank[n_words]), lens + 1
            del x
            train = np.array([is_training(i) for i in ids.to_pylist()], bool)
            learn = np.repeat(train, lens)
            yield messages([(int(learn.sum()), 0, 9, b""), (pack, -1 - pack, _SELF, several(
                squeeze(ids.fill_null(0).to_numpy(zero_copy_only=False)), squeeze(ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)),
                squeeze(train.astype(np.uint8)), squeeze(lens), squeeze(seq), squeeze(np.array([rank[-1], len(by)], np.int64)),
                squeeze(hashes[by])))])

    return stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, MESSAGE), "ngram-packs")


def _sequence(data: bytes) -> tuple[_Sequence, np.ndarray, list]:
    """(token ranks, whether each token trains, the other arrays) of a pack."""
    ids, null, train, lens, seq, (start, n_words), hashes = (unsqueeze(x) for x in apart(data))
    return _Sequence(seq, lens, int(start), int(n_words), hashes), np.repeat(train.astype(bool), lens), [ids, null, train]


def _send(packs: DataFrame, level: int, shards: int, large: dict) -> DataFrame:
    """Messages to the shards of one level: 1 for words, n for n-grams."""
    def rows(batches):
        for b in batches:
            for pack, data in zip(b.column("pack").to_pylist(), b.column("data")):
                s, learn, _ = _sequence(data.as_py())
                if level == 1:
                    count = np.bincount(s.seq[learn], minlength=s.n_words).astype(np.uint32)
                    home = _home(s.hashes, shards)
                    for i, j in zip((cut := _runs(home))[:-1].tolist(), cut[1:].tolist()):
                        yield pack, 1 << 40 | int(home[i]), 1, several(deltas(s.hashes[i:j]), squeeze(count[i:j]))
                else:
                    for contexts, mine in s.contexts(level):
                        pass  # the last is this level's
                    yield from _send_level(pack, level, contexts, mine, s, learn, shards, large)

    return packs.where(f"kind = {_SELF}").select("pack", "data").mapInArrow(lambda batches: batched(rows(batches)), MESSAGE)


def _blocks(level: int, contexts: np.ndarray, ctx: np.ndarray, w: np.ndarray, hashes: np.ndarray, shards: int, large: dict):
    """(shard, from, to) of distinct n-grams in key order: runs of one shard each."""
    home = level << 40 | _home(contexts, shards)[ctx]
    cuts = [(int(at), *large[level, h]) for h in [k[1] for k in large if k[0] == level]
            if (at := np.searchsorted(contexts, np.uint64(h))) < len(contexts) and contexts[at] == np.uint64(h)]
    for at, number, parts in cuts:
        a, b = np.searchsorted(ctx, [at, at + 1])
        home[a:b] = level << 40 | 1 << 39 | number << 20 | _home(hashes[w[a:b]], parts)
    cut = _runs(home)
    return [(int(home[a]), a, b) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]


def _send_level(pack, level, contexts, mine, s: _Sequence, learn, shards, large):
    key = np.sort(s.keys(mine) << 1 | ~learn)
    first = _runs(key >> 1)[:-1]
    count = np.add.reduceat(1 - (key & 1), first).astype(np.uint32) if len(key) else np.empty(0, np.uint32)
    key = key[first] >> 1
    ctx, w = key >> s.bits, key & (1 << s.bits) - 1
    place = np.empty(s.n_words, np.int32)
    for seq, (shard, a, b) in enumerate(_blocks(level, contexts, ctx, w, s.hashes, shards, large)):
        new = _runs(ctx[a:b])
        # Followers by their place among the message's own: most are common words.
        there = np.sort(w[a:b])
        there = there[_runs(there)[:-1]]
        place[there] = np.arange(len(there), dtype=np.int32)
        yield pack, shard, 1, several(
            seq.to_bytes(8, "little"), deltas(contexts[ctx[a:b][new[:-1]]]), squeeze(np.diff(new).astype(np.uint32)),
            deltas(s.hashes[there] >> np.uint64(24)), squeeze(place[w[a:b]]), squeeze(count[a:b]))


def _answer(sent: DataFrame, level: int, discount: float) -> DataFrame:
    """Shards of one level, staged: counts of words, codes of n-grams. Kind 9 rows carry (value in pack, what in shard)."""
    def answers(shard, rows):
        if shard >> 40 == 1:
            parts = [[f(x) for f, x in zip((undeltas, unsqueeze), apart(r[3]))] for r in rows]
            words, at = distinct(np.concatenate([p[0] for p in parts]))
            total = np.bincount(at, np.concatenate([p[1] for p in parts]), len(words)).astype(np.int64)
            yield int((total > 0).sum()), 1, 9, b""
            got = np.split(total[at], np.cumsum([len(p[0]) for p in parts])[:-1])
            for r, c in zip(rows, got):
                yield r[0], shard, 2, squeeze(c)
        else:
            seqs, parts = [], []
            for r in rows:
                seq, *rest = apart(r[3])
                seqs.append(seq)
                parts.append([f(x) for f, x in zip((undeltas, unsqueeze, undeltas, unsqueeze, unsqueeze), rest)])
            contexts, at = distinct(np.concatenate([p[0] for p in parts]))
            followers, to = distinct(np.concatenate([p[2] for p in parts]))
            begin = np.cumsum([0, *[len(p[2]) for p in parts[:-1]]])
            to = to[np.concatenate([p[3] + b for p, b in zip(parts, begin)])]
            entry = np.repeat(at, np.concatenate([p[1] for p in parts])) * len(followers) + to
            by = order_of(entry)
            first = _runs(entry[by])[:-1]
            c, f = np.divmod(entry[by][first], len(followers))
            count = np.add.reduceat(np.concatenate([p[4] for p in parts]).astype(np.int64)[by], first)
            number = np.empty(len(by), np.int32)
            number[by] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(by))))
            learned = count > 0
            trie = Trie.numbered(contexts, followers, c[learned], f[learned], count[learned], discount).mapped()
            code, rest = trie.query(contexts, followers, c, f)
            if shard >> 39 & 1:
                yield int(count.sum()), shard << 1, 9, b""
                yield int(learned.sum()), shard << 1 | 1, 9, b""
            code, at_entry, at_context = code[number], 0, 0
            for r, seq, p in zip(rows, seqs, parts):
                e, m = len(p[3]), len(p[0])
                yield r[0], shard, 2, several(seq, squeeze(code[at_entry:at_entry + e]), squeeze(rest[at[at_context:at_context + m]]))
                at_entry, at_context = at_entry + e, at_context + m

    return stage(by_group(sent, "shard", lambda shard, rows: batched(answers(shard, rows)), MESSAGE), f"ngram-answers-{level}")


_OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, order: int = ORDER, discount: float = DISCOUNT, pack_bytes: int = PACK_BYTES,
          shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """Every row's base and model score; see the module for the model."""
    shards, large = _plan(docs, order, shard_entries)
    packs = _own_packs(docs, pack_bytes)
    got = packs
    for level in range(1, order + 1):  # a level's messages are gone from the disks before the next is sent
        got = got.unionByName(_answer(_send(packs, level, shards, large), level, discount))
    stats = {r["shard"]: r["n"] for r in got.where("kind = 9").groupBy("shard").agg(F.sum("pack").alias("n")).collect()}
    tokens, types = stats.get(0, 0), stats.get(1, 0)
    #: per cut context: training total and followers; per part of one: its total
    whole: dict[tuple[int, int], list[int]] = {}
    part: dict[int, int] = {}
    for code, n in stats.items():
        if code > 1:
            shard = code >> 1
            whole.setdefault((shard >> 40, shard >> 20 & 0x7FFFF), [0, 0])[code & 1] += n
            if not code & 1:
                part[shard] = n

    def run(pack, rows):
        words, levels = [], [[] for _ in range(order - 1)]
        for _, shard, kind, data in rows:
            if kind == _SELF:
                s, _, (ids, null, train) = _sequence(data)
            elif shard >> 40 == 1:
                words.append(unsqueeze(data))
            else:
                levels[(shard >> 40) - 2].append((shard, apart(data)))
        seq, lens = s.seq, s.lens
        count = np.concatenate(words)
        base = (count + 1) / (tokens + types + 1)
        p = base[seq]
        for level, ((_, mine), answers) in enumerate(zip(s.contexts(order), levels), 2):
            p = _interpolate(s.keys(mine), s.bits, answers, p, lambda shard: whole.get((level, shard >> 20 & 0x7FFFF), (0, 0)), part, discount)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64(), mask=null.astype(bool)), pa.array(train == 0), pa.array(lens, pa.int64()),
             pa.array(np.add.reduceat((count[seq] > 0).astype(np.int64), s.first), pa.int64()), pa.array(np.full(len(ids), tokens), pa.int64()),
             pa.array(np.add.reduceat(np.log10(base)[seq], s.first)), pa.array(np.add.reduceat(np.log10(p), s.first))],
            names=[c.split()[0] for c in _OUT.split(", ")])

    return by_group(got.where("kind <> 9"), "pack", run, _OUT)


def _interpolate(key: np.ndarray, bits: int, answers: list, lower: np.ndarray, total_of, part: dict, discount: float) -> np.ndarray:
    """Each token's probability at this level, from the shards' codes and the lower order's."""
    by = order_of(key)
    key = key[by]
    first = _runs(key)[:-1]
    entry = np.empty(len(key), np.int32)
    entry[by] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(key))))
    context = key[first] >> bits
    del by, key
    at = np.cumsum(np.concatenate([[False], context[1:] != context[:-1]]))
    seen, rests, cut = [], [], None
    for shard, (_, code, rest) in sorted(answers, key=lambda a: int.from_bytes(a[1][0], "little")):
        code, rest = unsqueeze(code), unsqueeze(rest)
        if shard >> 39 & 1:  # a part of a cut context: its own share of the total
            total, followers = total_of(shard)
            seen.append(expand(code) * (part.get(shard, 0) / max(1, total)))
            if shard >> 20 != cut:
                rests.append(np.array([discount * followers / total if total else 1.0]))
            cut = shard >> 20
        else:
            seen.append(expand(code))
            rests.append(np.where(rest == NONE, 1.0, expand(rest)))
            cut = None
    return np.concatenate(seen)[entry] + np.concatenate(rests)[at[entry]] * lower


def op1_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
