"""Token ids in ORC files.

Documents are range-partitioned and sorted by id, encoded in Arrow batches and
written as ORC ``array<int>`` (integer run-length encoding), with row indexes
and a Bloom filter on the id: a lookup prunes files and stripes by metadata, a
scan reads stripes in parallel.

Encoding goes by space-separated words, which the tokenizer's own splitting
never joins where each space stands between two other characters. Each distinct
word is encoded once by the tokenizers library and remembered, apart from marks
that follow its letters; a text with other white space beside a space is
encoded whole. So is one that holds an added token's string; special tokens are
ordinary text only with ``plain_special``, which the query leaves off as the
library does.

Defined results: null and empty texts give just the end id; equal ids are
ordered by text, null ids come last; repeated rows are separate documents; an
empty table writes no rows. Only id and text are read, so other columns and
their names do not matter.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripkit.llm.common import shuffle_width, stage, table, work_path

END_ID = 0
#: Words a worker remembers; only speed depends on it.
MAX_REMEMBERED = 1_500_000
_SPACE = r"[\s\v\x1c-\x1f\x{85}\p{Z}]"
#: Marks that may follow the letters of a word.
MARKS = ".,;:!?"
CROWDED = rf"^{_SPACE}|{_SPACE}{_SPACE}|{_SPACE}$"


class Encoder:
    """Whole texts to token ids, through the distinct words of a batch.

    ``words``, ``sizes`` and ``flat`` remember words (each with a space before
    it) and their ids, one after the other, as plain arrays.
    """

    def __init__(self, path: str, plain_special: bool = True):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = plain_special  # their strings in a text are ordinary text
        #: Strings that the tokenizer takes out of a text before it splits the rest.
        self.apart = [t.content for t in self.tok.get_added_tokens_decoder().values() if not (t.special and plain_special)]
        vocab = self.tok.get_vocab(with_added_tokens=True)
        #: Ids whose token begins with a space (shown as U+0120 by byte-level vocabularies).
        self.spaced = np.zeros(max(vocab.values()) + 1, bool)
        self.spaced[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True
        self._forget()

    def _forget(self) -> None:
        self.words, self.flat = pa.array([], pa.large_string()), np.empty(0, np.int32)
        self.sizes = np.empty(0, np.int32)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids in a row, ids per text)."""
        got = [np.array(e.ids, np.int32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.empty(0, np.int32), *got]), np.array([len(x) for x in got], np.int64)

    def _learn(self, words: pa.Array) -> None:
        """Remember words: many are encoded as one line, which is cut where a token begins with a space."""
        plain = words.to_pylist()
        flat, _ = self._whole([" " + " ".join(plain[i:i + 500]) for i in range(0, len(plain), 500)])
        cut = np.flatnonzero(self.spaced[flat])
        if len(cut) == len(plain):
            sizes = np.diff(np.append(cut, len(flat)))
        else:
            flat, sizes = self._whole([" " + w for w in plain])
        self.words = pa.concat_arrays([self.words, words])
        self.sizes, self.flat = np.concatenate([self.sizes, sizes.astype(np.int32)]), np.concatenate([self.flat, flat])

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, ids per text), each text followed by ``end_id`` if there is one."""
        import pyarrow.compute as pc
        if not len(texts):
            return np.empty(0, np.int32), np.empty(0, np.int64)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lists = pc.split_pattern(texts, " ")
        first = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        at, words = coded.indices.to_numpy(), coded.dictionary
        n_words = np.diff(np.append(first, len(at)))
        # A text with white space at an end of a word, or in a row, is encoded whole; so is an empty one.
        odd = pc.or_(pc.match_substring_regex(words, CROWDED), pc.equal(pc.binary_length(words), 0)).to_numpy(zero_copy_only=False)
        for token in self.apart:
            if " " not in token:
                odd = odd | pc.match_substring(words, token).to_numpy(zero_copy_only=False)
        bad = np.logical_or.reduceat(odd[at], first)
        for token in self.apart:
            if " " in token:
                bad = bad | pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        keep = np.repeat(~bad, n_words)
        keep[first] = False
        used = np.zeros(len(words), bool)
        used[at[keep]] = True
        # Letters and the marks after them are split by the tokenizer: remembered apart.
        core = pc.utf8_rtrim(words, MARKS)
        split = pc.and_(pc.utf8_is_alpha(core), pc.not_equal(core, words))
        parts = pc.if_else(split, core, words).dictionary_encode()
        part, parts = parts.indices.to_numpy(), parts.dictionary
        needed = np.zeros(len(parts), bool)
        needed[part[used]] = True
        if len(self.words) > MAX_REMEMBERED:
            self._forget()
        place = pc.fill_null(pc.index_in(parts, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int32)
        fresh = needed & (place < 0)
        place[fresh] = len(self.words) + np.arange(fresh.sum())
        if fresh.any():
            self._learn(parts.filter(pa.array(fresh)))
        # The first word of a text has no space before it; it, or the whole text, is encoded as it stands.
        plain = [texts[i].as_py() if b else w for i, (b, w) in enumerate(zip(bad.tolist(), words.take(pa.array(at[first])).to_pylist()))]
        tailed = np.flatnonzero(split.to_numpy(zero_copy_only=False) & used)
        tails = [w[len(c):] for w, c in zip(words.take(pa.array(tailed)).to_pylist(), core.take(pa.array(tailed)).to_pylist())]
        number = {t: len(self.words) + 1 + i for i, t in enumerate(dict.fromkeys([*plain, *tails]))}
        more, more_sizes = self._whole(list(number))
        end = np.array([] if end_id is None else [end_id], np.int32)
        flat = np.concatenate([self.flat, end, more])
        sizes = np.concatenate([self.sizes, [len(end)], more_sizes]).astype(np.int32)
        begin = (np.cumsum(sizes, dtype=np.int64) - sizes).astype(np.int32 if len(flat) < 1 << 31 else np.int64)
        tail = np.full(len(words), -1, np.int32)
        tail[tailed] = [number[t] for t in tails]
        # Pieces in order: the first word or whole text, words and their marks, the end.
        word = place[part][at]
        word[first] = [number[t] for t in plain]
        marks = tail[at]
        marks[first] = -1
        last = np.zeros(len(at), bool)
        last[np.where(bad, first, first + n_words - 1)] = True
        keep[first] = True
        word, marks, last = word[keep], marks[keep], last[keep]
        n = 1 + (marks >= 0) + last
        upto = np.cumsum(n)
        piece = np.empty(upto[-1], np.int32)
        piece[upto - n] = word
        piece[(upto - n + 1)[marks >= 0]] = marks[marks >= 0]
        piece[(upto - 1)[last]] = len(self.words)
        n = sizes[piece]
        step = begin[piece]
        ends = np.cumsum(n)
        step -= (ends - n).astype(step.dtype)
        step = np.repeat(step, n)
        step += np.arange(len(step), dtype=step.dtype)
        return flat[step], np.diff(ends[upto[last] - 1], prepend=0)


def _slices(batch: pa.RecordBatch, most: int):
    """Parts of a batch with about ``most`` bytes of text, at least one row each."""
    import pyarrow.compute as pc
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cut = np.flatnonzero(np.diff(size // most, prepend=0))
    for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(batch)]):
        if e > s:
            yield batch.slice(s, e - s)


_ROWS = "doc_id long, part int, pos long, ids array<int>"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, files: int | None = None,
                 plain_special: bool = True) -> None:
    """Write (doc_id, part, pos, ids) in ascending doc_id order; (part, pos) is the order."""
    def run(batches):
        import sys
        memory = sys.__dict__.setdefault("_piece_encoders", {})  # a reused worker keeps its memory
        key = tokenizer, plain_special
        if key not in memory:
            memory[key] = Encoder(tokenizer, plain_special)
        part, pos = TaskContext.get().partitionId(), 0
        for big in batches:
            for batch in _slices(big, 4 << 20):
                ids, lens = memory[key].encode(batch.column("text"), end_id)
                n = len(lens)
                rows = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]), pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").cast(pa.int64()), pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(pos, pos + n), pa.int64()), rows],
                    names=["doc_id", "part", "pos", "ids"])
                pos += n
                pa.default_memory_pool().release_unused()

    order = [F.col("doc_id").asc_nulls_last(), F.col("text")]
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .repartitionByRange(files or shuffle_width(docs.sparkSession), order[0]).sortWithinPartitions(*order))
    (rows.mapInArrow(run, _ROWS).write.option("compression", "zstd").option("orc.row.index.stride", "1000")
     .option("orc.stripe.size", str(16 << 20)).option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", "0.01").orc(path))


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The rows of ``write_tokens``; with ``doc_ids`` only theirs, pruned by index and Bloom filter."""
    out = spark.read.schema(_ROWS).orc(path)
    return out if doc_ids is None else out.where(F.col("doc_id").isin(list(doc_ids)))


def token_digests(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of written rows."""
    def run(batches):
        for b in batches:
            ids = b.column("ids")
            values, off = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4"), ids.offsets.to_numpy()
            crc = [zlib.crc32(values[s:e].tobytes()) for s, e in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), b.column("pos"), pa.array(np.diff(off), pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "part", "pos", "n_tokens", "ids_crc32"])

    got = stage(rows.mapInArrow(run, "doc_id long, part int, pos long, n_tokens long, ids_crc32 long"), "token-digests")
    parts = got.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return (got.join(parts, "part")
            .select("doc_id", (F.col("before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"), "n_tokens", "ids_crc32"))


def op5_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = work_path(spark, "tokens.orc")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), plain_special=False)
    return token_digests(read_tokens(spark, path))
