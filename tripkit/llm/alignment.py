"""Cross-tokenizer alignment by as-of joins of token starts.

Two tokenizers cut the same bytes (a space, then the text). ``pandas.merge_asof``,
run per batch and keyed by document, finds for each token start the token of the
other side that covers it; the union of both directions is every overlapping
pair. Pairs that end at one byte close a group, so the running number of closed
groups says which group a token is in; all tokens of a group's two sides are
linked. A pack of documents counts each pair of ids once a document, Spark adds
the counts up, and every pack gets back the counts of its own distinct pairs:
a pair travels once a pack, however many documents hold it.

Both tokenizers split at a space that stands between two other characters, so
distinct words of a batch are encoded once, and very long texts are taken in
parts cut there; a text with other white space beside a space is encoded whole.

Defined results: a text that is null, empty, or not given back by a tokenizer's
bytes has no tokens (zeros, digest ''); a text counts as a document of its own
even if its id repeats; a null id stays null; an empty table gives no rows. Only
id and text are read, so other columns and their names do not matter.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm.common import shuffle_width, stage, table
from tripkit.llm.packs import Numbers, apart, grouped, several, squeeze, unsqueeze

PACK_BYTES = 6 << 20
#: Characters of a part of a long text, and of the parts aligned at once.
PART_CHARS = 1 << 19
#: Words an encoder remembers; only speed depends on it.
MAX_REMEMBERED = 400_000
#: Groups with more links than this are reduced to their distinct ids before they are paired.
WIDE_GROUP = 4096
#: Fixed value: how a byte-level vocabulary splits a text before it merges bytes.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CUT = re.compile(r"\S (?=\S)")


def byte_level_tokens(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary: printable bytes stand for themselves, the others in order from U+0100."""
    from tokenizers import Tokenizer
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown}
    byte |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    vocab = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    return out


def special_ids(path: str) -> set[int]:
    from tokenizers import Tokenizer
    return {i for i, t in Tokenizer.from_file(path).get_added_tokens_decoder().items() if t.special}


def piece_tokens(path: str) -> list[bytes]:
    """Bytes of each id of a piece vocabulary: U+2581 is a space, <0xHH> a byte."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
            for i in range(sp.get_piece_size())]


class WordEncoder:
    """Ids of a space and a text on both sides, through the distinct words of a batch, each encoded once.

    ``sides`` are (function from strings to lists of ids for a space and each, bytes of each id).
    """

    def __init__(self, *sides):
        self.sides = sides
        self._forget()

    def _forget(self) -> None:
        self.known, self.odd, self.same = Numbers(), np.empty(0, bool), np.empty(0, bool)
        self.memory = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in self.sides]

    def _encode(self, texts: list[str]):
        """Per side (ids in a row, ids per text); whether both give back a space and the text."""
        out, same = [], np.ones(len(texts), bool)
        for encode, shown in self.sides:
            ids = encode(texts) if texts else []
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            out.append((np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum())), n))
            same &= np.fromiter((b"".join(map(shown.__getitem__, x)) == b" " + t.encode() for x, t in zip(ids, texts)), bool, len(texts))
        return out, same

    def __call__(self, texts: list[str]):
        """Per side (ids in a row, ids per text); whether both give back a space and the text. No text is empty."""
        if len(self.known) > MAX_REMEMBERED:
            self._forget()
        before, words, n_words = len(self.known), [], []
        for t in texts:
            ws = t.split(" ")
            n_words.append(len(ws))
            words += ws
        item, n_words = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)), np.array(n_words)
        del words
        fresh = list(islice(self.known, before, None))
        # A word with white space at an end (or none between two spaces) may be cut otherwise in its text.
        odd = np.fromiter((not w or w[0].isspace() or w[-1].isspace() for w in fresh), bool, len(fresh))
        coded, same = self._encode(fresh)
        self.odd, self.same = np.concatenate([self.odd, odd]), np.concatenate([self.same, same])
        self.memory = [tuple(map(np.concatenate, zip(*pair))) for pair in zip(self.memory, coded)]
        first = np.cumsum(n_words) - n_words
        whole = np.logical_or.reduceat(self.odd[item], first)
        ok = np.logical_and.reduceat(self.same[item], first)
        apart_, ok[whole] = self._encode([texts[i] for i in np.flatnonzero(whole).tolist()])
        item[first[whole]] = len(self.same) + np.arange(whole.sum())
        keep = ~np.repeat(whole, n_words)
        keep[first[whole]] = True
        item, items = item[keep], np.where(whole, 1, n_words)
        out = []
        for pair in zip(self.memory, apart_):
            flat, sizes = map(np.concatenate, zip(*pair))
            n = sizes[item]
            begin = np.cumsum(sizes) - sizes
            out.append((flat[np.arange(n.sum()) + np.repeat(begin[item] - (np.cumsum(n) - n), n)], np.add.reduceat(n, np.cumsum(items) - items)))
        return out, ok


def word_encoder(tokenizer: str, pieces: str) -> WordEncoder:
    """Both sides; strings of special tokens are plain text. A byte-level vocabulary numbers its tokens in the
    order of their merges, which is all tiktoken needs to cut as the tokenizers library does, only faster."""
    import sentencepiece
    import tiktoken
    a_bytes, b_bytes = byte_level_tokens(tokenizer), piece_tokens(pieces)
    special = special_ids(tokenizer)
    ranks = {t: i for i, t in enumerate(a_bytes) if i not in special}
    tok = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces)
    return WordEncoder((lambda texts: [tok.encode_ordinary(" " + t) for t in texts], a_bytes),
                       (lambda texts: sp.encode(texts, num_threads=1), b_bytes))


def align(doc_a: np.ndarray, a_end: np.ndarray, a_start: np.ndarray, doc_b: np.ndarray, b_end: np.ndarray, b_start: np.ndarray):
    """(group of each A token, group of each B token, number of groups), groups numbered in byte order.

    Offsets run on over the documents of the batch, each of which has tokens on both sides.
    """
    import pandas as pd
    a = pd.DataFrame({"at": a_start, "doc": doc_a, "a": np.arange(len(a_start))})
    b = pd.DataFrame({"at": b_start, "doc": doc_b, "b": np.arange(len(b_start))})
    over = pd.concat([pd.merge_asof(a, b, on="at", by="doc"), pd.merge_asof(b, a, on="at", by="doc")])
    key = np.sort(over["a"].to_numpy(np.int64) * len(b) + over["b"].to_numpy(np.int64), kind="stable")  # two sorted runs
    i, j = np.divmod(key[np.diff(key, prepend=-1) > 0], max(1, len(b)))
    closes = a_end[i] == b_end[j]
    group = np.cumsum(closes) - closes
    of_a, of_b = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    of_a[i], of_b[j] = group, group
    return of_a, of_b, int(closes.sum())


def _within(n: np.ndarray) -> np.ndarray:
    """0, 1, ... n - 1 for each of the sizes, in a row."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _pairs(ga, gb, in_a, in_b, ids_a, ids_b, row_of_a, n_b_ids: int, n_a_ids: int):
    """(key of row and ids, links) of the linked pairs, keys may repeat."""
    wide = in_a * in_b > WIDE_GROUP
    first_b = np.cumsum(in_b) - in_b
    n = np.where(wide[ga], 0, in_b[ga])
    b = np.repeat(first_b[ga], n) + _within(n)
    key = (np.repeat(row_of_a * n_a_ids + ids_a, n)) * n_b_ids + ids_b[b]
    keys, links = [key], [np.ones(len(key), np.int64)]
    first_a = np.cumsum(in_a) - in_a
    for g in np.flatnonzero(wide).tolist():
        a, ca = np.unique(ids_a[first_a[g]:first_a[g] + in_a[g]], return_counts=True)
        b, cb = np.unique(ids_b[first_b[g]:first_b[g] + in_b[g]], return_counts=True)
        keys.append(((row_of_a[first_a[g]] * n_a_ids + a)[:, None] * n_b_ids + b).ravel())
        links.append((ca[:, None] * cb).ravel())
    return _summed(np.concatenate(keys), np.concatenate(links))


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their sums."""
    if not len(keys):
        return keys, n
    by = np.argsort(keys, kind="stable")
    keys = keys[by]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n[by], first)


def _parts(text: str):
    """A long text cut at spaces between other characters; each part stands for a space and itself."""
    at = 0
    while len(text) - at > PART_CHARS and (cut := _CUT.search(text, at + PART_CHARS)):
        yield text[at:cut.start() + 1], False
        at = cut.end()
    yield text[at:], True


class Aligner:
    """Token groups of whole texts."""

    def __init__(self, tokenizer: str, pieces: str):
        self.encode = word_encoder(tokenizer, pieces)
        self.a_len, self.b_len = (np.array([len(x) for x in shown], np.int64) for _, shown in self.encode.sides)
        self.n_a, self.n_b = len(self.a_len), len(self.b_len)
        #: Ids as written in a group: followed by another of its side, or the last of it.
        self.shown = [b"%d%s" % (i, e) for n, last in ((self.n_a, b"|"), (self.n_b, b";")) for i in range(n) for e in (b",", last)]

    def texts(self, texts: list):
        """(counts per row: n_a, n_b, n_groups, n_links; digests; distinct keys of row and ids, links each)."""
        counts, sha, bad = np.zeros((len(texts), 4), np.int64), [hashlib.sha256() for _ in texts], np.zeros(len(texts), bool)
        keys, links, held, size = [], [], [], 0
        for row, text in enumerate(texts):
            for part, last in _parts(text) if text else ():
                held.append((row, part, last))
                size += len(part)
                if size >= PART_CHARS:
                    self._batch(held, counts, sha, bad, keys, links)
                    held, size = [], 0
        self._batch(held, counts, sha, bad, keys, links)
        counts[bad] = 0
        key, n = _summed(np.concatenate([np.empty(0, np.int64), *keys]), np.concatenate([np.empty(0, np.int64), *links]))
        good = ~bad[key // (self.n_a * self.n_b)] if len(key) else np.empty(0, bool)
        return counts, [s.hexdigest() if n else "" for s, n in zip(sha, counts[:, 0].tolist())], key[good], n[good]

    def _batch(self, held, counts, sha, bad, keys, links) -> None:
        if not held:
            return
        ((ids_a, na), (ids_b, nb)), ok = self.encode([p for _, p, _ in held])
        bad[[row for (row, _, _), good in zip(held, ok.tolist()) if not good]] = True
        if not ok.all():
            ids_a, ids_b = ids_a[np.repeat(ok, na)], ids_b[np.repeat(ok, nb)]
            held, na, nb = [h for h, good in zip(held, ok.tolist()) if good], na[ok], nb[ok]
            if not held:
                return
        rows = np.array([r for r, _, _ in held], np.int64)
        doc_a, doc_b = np.repeat(rows, na), np.repeat(rows, nb)
        a_end, b_end = np.cumsum(self.a_len[ids_a]), np.cumsum(self.b_len[ids_b])
        ga, gb, n_groups = align(doc_a, a_end, a_end - self.a_len[ids_a], doc_b, b_end, b_end - self.b_len[ids_b])
        in_a, in_b = np.bincount(ga, minlength=n_groups), np.bincount(gb, minlength=n_groups)
        row_of_group = doc_a[np.cumsum(in_a) - 1]
        np.add.at(counts, (rows, 0), na)
        np.add.at(counts, (rows, 1), nb)
        counts[:, 2] += np.bincount(row_of_group, minlength=len(counts))
        np.add.at(counts, (row_of_group, 3), in_a * in_b)
        key, n = _pairs(ga, gb, in_a, in_b, ids_a, ids_b, doc_a, self.n_b, self.n_a)
        keys.append(key)
        links.append(n)
        # The groups as text: A ids, a bar, B ids, a semicolon.
        code = np.empty(len(ga) + len(gb), np.int64)
        code[np.arange(len(ga)) + (np.cumsum(in_b) - in_b)[ga]] = 2 * ids_a + (np.diff(ga, append=n_groups) > 0)
        code[np.arange(len(gb)) + np.cumsum(in_a)[gb]] = 2 * (self.n_a + ids_b) + (np.diff(gb, append=n_groups) > 0)
        code, upto = code.tolist(), np.cumsum(na + nb).tolist()
        for (row, _, last), s, e in zip(held, [0, *upto[:-1]], upto):
            shown = b"".join(map(self.shown.__getitem__, code[s:e]))
            sha[row].update(shown[:-1] if last else shown)


_ROWS = "pack long, a int, b int, n long, data binary"
_OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _align_packs(docs: DataFrame, tokenizer: str, pieces: str, pack_bytes: int) -> DataFrame:
    """Staged: per pack one row of its documents (a is -1), and a row for each of its distinct id pairs with its documents."""
    def run(batches):
        import sys
        memory = sys.__dict__.setdefault("_piece_aligners", {})  # a reused worker keeps its encoders
        if (tokenizer, pieces) not in memory:
            memory[tokenizer, pieces] = Aligner(tokenizer, pieces)
        aligner = memory[tokenizer, pieces]
        for pack, _, whole in grouped(batches, 1, pack_bytes):
            ids = whole.column(0).combine_chunks()
            counts, sha, key, links = aligner.texts(whole.column(1).to_pylist())
            row, pair = np.divmod(key, aligner.n_a * aligner.n_b)
            pairs, number, held = np.unique(pair, return_inverse=True, return_counts=True)
            data = several(squeeze(ids.fill_null(0).to_numpy(zero_copy_only=False)), squeeze(ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)),
                           squeeze(counts.ravel()), ",".join(sha).encode(), squeeze(np.bincount(row, minlength=len(ids))),
                           squeeze(number.astype(np.uint32)), squeeze(links))
            m = len(pairs)
            a, b = np.divmod(pairs, aligner.n_b)
            yield pa.RecordBatch.from_arrays([pa.array([pack], pa.int64()), pa.array([-1], pa.int32()), pa.array([-1], pa.int32()),
                                              pa.array([0], pa.int64()), pa.array([data], pa.binary())], names=["pack", "a", "b", "n", "data"])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, pack), pa.int64()), pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                                              pa.array(held, pa.int64()), pa.nulls(m, pa.binary())], names=["pack", "a", "b", "n", "data"])
            del whole, counts, key, links, row, pair, number
            pa.default_memory_pool().release_unused()

    return stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _ROWS), "aligned-packs")


def pair_counts(packs: DataFrame) -> DataFrame:
    """(a, b, n, best): documents that hold the pair, and whether no other pair of ``a`` is held by more."""
    counts = stage(packs.where("a >= 0").groupBy("a", "b").agg(F.sum("n").alias("n")), "pair-counts")
    high = counts.groupBy("a").agg(F.max("n").alias("high"))
    return counts.join(high, "a").select("a", "b", "n", (F.col("n") == F.col("high")).alias("best"))


def align_documents(docs: DataFrame, tokenizer: str, pieces: str, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """Every row's token groups, links and corpus-wide counts of its linked id pairs."""
    packs = _align_packs(docs, tokenizer, pieces, pack_bytes)
    got = packs.where("a >= 0").select("pack", "a", "b").join(pair_counts(packs), ["a", "b"])
    rows = (got.select("pack", "a", "b", "n", "best", F.lit(None).cast("binary").alias("data"))
            .unionByName(packs.where("a < 0").select("pack", "a", "b", "n", F.lit(False).alias("best"), "data")))

    def finish(data, n, best):
        ids, null, counts, sha, entries, number, links = (f(x) for f, x in zip(
            (unsqueeze, unsqueeze, unsqueeze, bytes.decode, unsqueeze, unsqueeze, unsqueeze), apart(data)))
        upto = np.concatenate([[0], np.cumsum(entries)])
        sums = [np.diff(np.concatenate([[0], np.cumsum(links * x[number])])[upto]) for x in (best, n)]
        cols = [pa.array(ids, pa.int64(), mask=null.astype(bool)), *map(pa.array, np.ascontiguousarray(counts.reshape(-1, 4).T)),
                *[pa.array(x.astype(np.int64)) for x in sums], pa.array(sha.split(","))]
        return pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in _OUT.split(", ")])

    def run(batches):
        pack, data, n, best = None, None, [], []
        for b in batches:
            numbers = b.column("pack").to_numpy()
            cut = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for s, e in zip(cut[:-1], cut[1:]):
                if e == s:
                    continue
                if numbers[s] != pack:
                    if data is not None:
                        yield finish(data, np.concatenate(n), np.concatenate(best))
                    pack, data, n, best = numbers[s], b.column("data")[s].as_py(), [], []
                    s += 1  # the pack's documents come before its pairs
                n.append(b.column("n").to_numpy()[s:e])
                best.append(b.column("best").to_numpy(zero_copy_only=False)[s:e].astype(np.int64))
        if data is not None:
            yield finish(data, np.concatenate(n), np.concatenate(best))

    return rows.repartition(shuffle_width(docs.sparkSession), "pack").sortWithinPartitions("pack", "a", "b").mapInArrow(run, _OUT)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
