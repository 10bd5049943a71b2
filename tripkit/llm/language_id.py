"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A
word's probability is the sum over all its segmentations into pieces of the
product of their probabilities, found by a forward algorithm over its bytes; a
text's is the product over its words. Probabilities are learned by expectation
maximisation from the distinct words of all training texts and their counts per
language: tasks sum expected piece counts (forward-backward), Spark adds them up,
and only those sums, pieces x languages, reach the driver. They are smoothed by
the pieces' frequency over all languages. Distinct words are looked up or scored
once a worker, all words of one length at a time.

A word is a letter and the letters and marks after it, lower-cased, after a
space; a run of more than ``WORD_LETTERS`` is several words. Single bytes are
pieces too, so every word has a segmentation.

Defined results: a text that is null or without a letter, or any text where
nothing could be learned, is ``und`` with score 0; ties fall to the first
language in code-point order; a null id counts as the empty string for the
split, hence trains; a language whose texts hold no letter is not learned;
repeated rows train and are judged each; an empty table gives no rows. Other columns do not matter. More than ``MAX_LANGUAGES`` labels
are an error, as every task holds the model.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm.alignment import piece_tokens
from tripkit.llm.common import stage, table

UNKNOWN = "und"
WORD_LETTERS = 32
ROUNDS = 3
#: Weight, in pieces, of the frequency over all languages in each language's probabilities.
SHARED_WEIGHT = 500.0
#: The model is at most this many languages x the vocabulary, 8 bytes each.
MAX_LANGUAGES = 400
#: Words a worker remembers, and distinct words a task holds before it passes their counts on.
MAX_REMEMBERED, MAX_COUNTED = 500_000, 200_000
#: Factor a byte, the same for every segmentation of a word; keeps products in range.
_LIFT = float(np.exp(2.0))
_LEAST = 1e-300
#: Cells (word, start, piece length or language) of one block of words.
_CELLS = 1 << 20


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


#: Letters below U+0250, where no mark occurs; most texts of European languages hold no other.
_NEAR = "a-zA-Z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"


def _words(text: str) -> list[str]:
    import re
    text = text.lower()
    if text.isascii() or not re.search("[^\x00-\u024f]", text):
        return re.findall(f"[{_NEAR}]{{1,{WORD_LETTERS}}}", text)
    import regex
    return regex.findall(rf"\p{{L}}[\p{{L}}\p{{M}}]{{0,{WORD_LETTERS - 1}}}", text)


class Pieces:
    """The vocabulary as byte strings; single bytes are pieces, controls are not."""

    def __init__(self, path: str):
        self.number: dict[bytes, int] = {}
        for piece in piece_tokens(path):
            if piece and piece not in (b"<s>", b"</s>", b"<unk>"):
                self.number.setdefault(piece, len(self.number))
        for b in range(256):
            self.number.setdefault(bytes([b]), len(self.number))
        self.size, self.longest = len(self.number), max(map(len, self.number))
        self.lengths = np.zeros(self.size + 1, np.int64)
        self.lengths[list(self.number.values())] = [len(p) for p in self.number]
        #: Pieces of 1 to 8 bytes as sorted integers with their numbers; the first 8 bytes of longer ones.
        self.short = []
        for k in range(1, 9):
            mine = sorted((int.from_bytes(p, "big"), i) for p, i in self.number.items() if len(p) == k)
            self.short.append((np.array([x for x, _ in mine], np.uint64), np.array([i for _, i in mine], np.int32)))
        self.heads = np.unique(np.array([int.from_bytes(p[:8], "big") for p in self.number if len(p) > 8], np.uint64))

    def blocks(self, words: list[str], n_langs: int):
        """(indexes of words of one length, piece numbers by word, start and length - 1; ``size`` for none)."""
        coded = [b" " + w.encode() for w in words]
        by_length: dict[int, list[int]] = {}
        for i, c in enumerate(coded):
            by_length.setdefault(len(c), []).append(i)
        for m, mine in by_length.items():
            wide = min(m, self.longest)
            step = max(1, _CELLS // (m * max(wide, n_langs)))
            for at in range(0, len(mine), step):
                some = mine[at:at + step]
                yield np.array(some), self._found([coded[j] for j in some], m, wide)

    def _found(self, coded: list[bytes], m: int, wide: int) -> np.ndarray:
        letters = np.frombuffer(b"".join(coded), np.uint8).reshape(len(coded), m)
        ids = np.full((len(coded), m, wide), self.size, np.int32)
        key = np.zeros((len(coded), m + 1), np.uint64)
        for k, (known, number) in enumerate(self.short[:wide], 1):
            key = key[:, :-1] << np.uint64(8) | letters[:, k - 1:]
            if len(known):
                at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                ids[:, :m - k + 1, k - 1] = np.where(known[at] == key, number[at], self.size)
        if wide > 8 and len(self.heads):
            at = np.minimum(np.searchsorted(self.heads, key), len(self.heads) - 1)
            for r, i in zip(*(x.tolist() for x in np.nonzero(self.heads[at] == key))):
                for k in range(9, min(wide, m - i) + 1):
                    ids[r, i, k - 1] = self.number.get(coded[r][i:i + k], self.size)
        return ids


def forward(ids: np.ndarray, lifted: np.ndarray) -> np.ndarray:
    """Lifted probability that each word begins with its first j bytes: (word, j, language).

    ``lifted`` holds each piece's probabilities times ``_LIFT`` a byte, and zeros for no piece.
    """
    n, m, wide = ids.shape
    alpha = np.zeros((n, m + 1, lifted.shape[1]))
    alpha[:, 0] = 1
    for j in range(1, m + 1):
        for k in range(1, min(j, wide) + 1):
            piece = ids[:, j - k, k - 1]
            if (piece < len(lifted) - 1).any():
                alpha[:, j] += alpha[:, j - k] * lifted[piece]
    return alpha


def expected(ids: np.ndarray, lifted: np.ndarray, count: np.ndarray, out: np.ndarray) -> None:
    """Add to ``out`` (piece, language) the expected uses of each piece in words that occur ``count`` times."""
    alpha = forward(ids, lifted)
    n, m, wide = ids.shape
    beta = np.zeros_like(alpha)
    beta[:, m] = np.where(alpha[:, m] > _LEAST, count / np.maximum(alpha[:, m], _LEAST), 0)
    for i in range(m - 1, -1, -1):
        for k in range(1, min(m - i, wide) + 1):
            piece = ids[:, i, k - 1]
            hit = np.flatnonzero(piece < len(lifted) - 1)
            if len(hit):
                p = piece[hit]
                tail = beta[hit, i + k] * lifted[p]
                np.add.at(out, p, alpha[hit, i] * tail)
                beta[hit, i] += tail


def log_words(words: list[str], pieces: Pieces, lifted: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language, over all segmentations."""
    out = np.empty((len(words), lifted.shape[1]))
    for some, ids in pieces.blocks(words, lifted.shape[1]):
        out[some] = np.log(np.maximum(forward(ids, lifted)[:, -1], _LEAST)) - ids.shape[1] * np.log(_LIFT)
    return out


def word_counts(texts: DataFrame, langs: list[str]) -> DataFrame:
    """Staged (word, langs, counts) of all rows (text, lang): every distinct word once."""
    number = {name: i for i, name in enumerate(langs)}

    def run(batches):
        held: dict[tuple[str, int], int] = {}

        def rows():
            words, lang, n = [k[0] for k in held], [k[1] for k in held], list(held.values())
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(lang, pa.int32()), pa.array(n, pa.int64())], names=["word", "lang", "n"])

        for b in batches:
            for text, lang in zip(b.column("text"), b.column("lang").to_pylist()):
                at = number[lang]
                for w in _words(text.as_py() or ""):
                    held[w, at] = held.get((w, at), 0) + 1
                if len(held) > MAX_COUNTED:
                    yield rows()
                    held = {}
        yield rows()

    counts = texts.select("text", "lang").mapInArrow(run, "word string, lang int, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    return stage(counts.groupBy("word").agg(F.collect_list("lang").alias("langs"), F.collect_list("n").alias("counts")), "word-counts")


class Model:
    """Languages in order, their prior, and the piece probabilities (piece, language) with a last row of zeros."""

    def __init__(self, path: str, langs: list[str], prior: np.ndarray, p: np.ndarray):
        self.path, self.langs, self.prior, self.p, self.key = path, langs, prior, p, uuid.uuid4().hex


def _lifted(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return p * (_LIFT ** lengths)[:, None]


def _round(counts: DataFrame, path: str, p: np.ndarray) -> np.ndarray:
    """Expected uses (piece, language) over all words under ``p``."""
    n_langs = p.shape[1]

    def run(batches):
        pieces = Pieces(path)
        lifted, out = _lifted(p, pieces.lengths), np.zeros((pieces.size, n_langs))
        for b in batches:
            words = b.column("word").to_pylist()
            count = np.zeros((len(words), n_langs))
            lists = b.column("langs")
            row = np.repeat(np.arange(len(words)), lists.value_lengths().to_numpy())
            count[row, lists.flatten().to_numpy()] = b.column("counts").flatten().to_numpy()
            for some, ids in pieces.blocks(words, n_langs):
                expected(ids, lifted, count[some], out)
        at, lang = np.nonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(lang, pa.int32()), pa.array(out[at, lang])], names=["piece", "lang", "n"])

    total = np.zeros((len(p) - 1, n_langs))
    for r in counts.mapInArrow(run, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).collect():
        total[r["piece"], r["lang"]] = r["n"]
    return total


def _probabilities(uses: np.ndarray) -> np.ndarray:
    """Smoothed probabilities with the last row of zeros."""
    shared = uses.sum(axis=1, keepdims=True) + 0.01
    shared /= shared.sum()
    p = (uses + SHARED_WEIGHT * shared) / (uses.sum(axis=0) + SHARED_WEIGHT)
    return np.vstack([p, np.zeros(p.shape[1])])


def fit(docs: DataFrame, path: str, rounds: int = ROUNDS) -> Model:
    """Learn from all rows (text, lang) with a language; ``path`` is the piece vocabulary."""
    docs = docs.select("text", "lang").where("lang IS NOT NULL")
    found = sorted((r["lang"], r["n"]) for r in docs.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect())
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs, pieces = [name for name, _ in found], Pieces(path)
    p = np.vstack([np.full((pieces.size, len(langs)), 1 / pieces.size), np.zeros(len(langs))])
    if langs:
        counts = word_counts(docs, langs)
        for _ in range(rounds):
            uses = _round(counts, path, p)
            p = _probabilities(uses)
        learned = uses.sum(axis=0) > 0  # a language of texts without a letter taught nothing
        found, langs, p = [f for f, ok in zip(found, learned) if ok], [x for x, ok in zip(langs, learned) if ok], p[:, learned]
    prior = np.array([n for _, n in found], float)
    return Model(path, langs, np.log(prior / prior.sum()) if langs else prior, p)


class Scorer:
    """A worker's memory of words and their log probabilities."""

    def __init__(self, model: Model):
        self.model, self.pieces = model, Pieces(model.path)
        self.lifted = _lifted(model.p, self.pieces.lengths)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.logs = np.empty((0, len(self.model.langs)))

    def __call__(self, texts: list) -> tuple[list[str], list[float]]:
        if not self.model.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        if len(self.number) > MAX_REMEMBERED:
            self._forget()
        total, some = np.tile(self.model.prior, (len(texts), 1)), np.zeros(len(texts), bool)
        words = [_words(t) if t else [] for t in texts]
        fresh = list(dict.fromkeys(w for ws in words for w in ws if w not in self.number))
        self.number.update((w, i) for i, w in enumerate(fresh, len(self.number)))
        self.logs = np.concatenate([self.logs, log_words(fresh, self.pieces, self.lifted)])
        for i, ws in enumerate(words):
            if ws:
                total[i] += self.logs[np.fromiter(map(self.number.__getitem__, ws), np.int64, len(ws))].sum(axis=0)
                some[i] = True
        best = total.argmax(axis=1)
        score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        return ([self.model.langs[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), some.tolist())], np.where(some, score, 0.0).tolist())


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row, from its text alone."""
    def run(batches):
        import sys
        memory = sys.__dict__.setdefault("_language_scorer", {})  # a reused worker keeps its words
        if model.key not in memory:
            memory.clear()
            memory[model.key] = Scorer(model)
        for b in batches:
            for at in range(0, len(b), 500):
                part = b.slice(at, 500)
                lang, score = memory[model.key](part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out(F.col("doc_id"))), public_tokenizers.path("piece_bpe_32k.model"))
    return predict(docs, model)
