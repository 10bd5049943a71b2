"""Substring dedup behind a count-min prefilter.

Every window of 50 words has a 128-bit polynomial hash of its words. First,
each pack of documents adds its windows to a count-min sketch of two rows (a
window counts once a document): the sketch is cut into shards by cell, a pack
sends each shard its cells, the shard merges them in one dense counter array and
answers which of the pack's cells reached two. The sketch overestimates, so
every repeated window passes. Second, only windows whose cells all reached two
are grouped exactly by hash, and the smallest document id of each goes back to
the packs, which remove the words of windows that a smaller id has too.

The sketch grows with the text (a cell a byte), its shards and a pack are of
fixed size, and a window counts once a pack however many documents share it.

Defined results: null and empty texts have no words; a text under 50 words has
no window and loses nothing; rows of equal id do not remove each other's words,
a null id is larger than any; repeated rows are judged separately; an empty
table gives no rows; other columns pass through ``dedupe`` (``n_chars``, where
there is one, follows the text), and a document left without words goes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm.common import stage, table
from tripkit.llm.packs import (MESSAGE, apart, as_messages, by_group, deltas, make_packs, messages, open_pack, over_packs,
                               several, squeeze, token_numbers, undeltas, unsqueeze)

WINDOW = 50
#: Cells of one sketch shard as a power of two: its counters are as many bytes.
SHARD_BITS = 24
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_CELLS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_NO_ID = np.iinfo(np.int64).max


def _rolling(values: np.ndarray, base: int, size: int) -> np.ndarray:
    """Polynomial hash modulo 2**64 of every ``size`` values in a row."""
    n = len(values)
    power, back = np.full(n + 1, base, np.uint64), np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
    power[0] = back[0] = 1
    power, back = np.cumprod(power), np.cumprod(back)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * back[:n])])
    return (total[size:] - total[:-size]) * power[:n - size + 1]


def windows(texts: pa.Array, size: int = WINDOW):
    """(h1, h2, start word, row) of every window of the texts of a pack, in order."""
    from xxhash import xxh64_intdigest
    x, lens, words = token_numbers(texts)
    if len(x) < size:
        none = np.empty(0, np.uint64)
        return none, none, none.astype(np.int64), none.astype(np.int64)
    row = np.repeat(np.arange(len(lens)), lens)
    start = np.flatnonzero(row[size - 1:] == row[:len(row) - size + 1])
    out = []
    for seed in _SEEDS:
        value = np.fromiter((xxh64_intdigest(w, seed & 0xFFFF) for w in words), np.uint64, len(words))
        out.append(_rolling(value[x], seed, size)[start])
    return out[0], out[1], start, row[start]


def _cells(h1: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (h1 ^ (h1 >> np.uint64(29))) * np.uint64(_CELLS[row]) >> np.uint64(64 - bits)


def _split(sorted_values: np.ndarray, shift: int):
    """(shard, from, to) of runs of equal high bits."""
    high = (sorted_values >> np.uint64(shift)).astype(np.int64)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(high)) + 1, [len(high)]])
    return [(int(high[s]), s, e) for s, e in zip(cut[:-1].tolist(), cut[1:].tolist()) if e > s]


def _sketch(packs: DataFrame, at: int, bits: int, shard_bits: int, size: int) -> DataFrame:
    """What each pack adds to each shard: its cells, and a bit for those it has from two documents."""
    def run(pack, rows):
        h1, _, _, row = windows(rows.column(at), size)
        order = np.argsort(h1, kind="stable")
        h, d = h1[order], row[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
        last = np.concatenate([first[1:], [len(h)]]) - 1 if len(h) else first
        several_docs = d[first] != d[last]
        for r in range(len(_CELLS)):
            cell = _cells(h[first], r, bits)
            by = np.argsort(cell, kind="stable")
            cell, twice = cell[by], several_docs[by]
            new = np.concatenate([[True], cell[1:] != cell[:-1]]) if len(cell) else np.empty(0, bool)
            at_new = np.flatnonzero(new)
            if not len(at_new):
                continue
            count = np.add.reduceat(1 + twice.astype(np.int64), at_new)
            cell, two = cell[at_new], count > 1
            out = [(pack, s << 1 | r, 1, several(deltas(cell[a:b]), squeeze(np.packbits(two[a:b])))) for s, a, b in _split(cell, shard_bits)]
            yield messages(out)

    return over_packs(packs, run, MESSAGE)


def _merge(sketches: DataFrame, shard_bits: int) -> DataFrame:
    """Merge a shard's partial sketches; answer every pack with its cells that reached two."""
    def run(shard, rows):
        count, low = np.zeros(1 << shard_bits, np.uint8), np.uint64((1 << shard_bits) - 1)
        for _, _, _, data in rows:
            cells, two = apart(data)
            cells = (undeltas(cells) & low).astype(np.int64)
            more = np.unpackbits(unsqueeze(two), count=len(cells))
            count[cells] = np.minimum(count[cells] + 1 + more, 2)
        for pack, _, _, data in rows:
            cells = undeltas(apart(data)[0])
            hot = cells[count[(cells & low).astype(np.int64)] >= 2]
            if len(hot):
                yield messages([(pack, shard, 1, deltas(hot))])

    return by_group(sketches, "shard", run, MESSAGE)


def _candidates(packs: DataFrame, hot: DataFrame, at: int, id_at: int, bits: int, shard_bits: int, size: int) -> DataFrame:
    """Per pack: kind 1, to each exact shard its distinct candidate windows with their smallest id;
    kind 2, where those windows are (word, number of the window)."""
    def run(pack, rows):
        data, got = None, [[] for _ in _CELLS]
        for _, shard, kind, value in rows:
            if kind == 0:
                data = value
            else:
                got[shard & 1].append(undeltas(value))
        if not all(got):
            return
        batch = open_pack(data)
        h1, h2, start, row = windows(batch.column(at), size)
        ok = np.ones(len(h1), bool)
        for r, part in enumerate(got):
            hot_cells = np.concatenate(part)  # shards in order, so sorted
            cell = _cells(h1, r, bits)
            ok &= hot_cells[np.minimum(np.searchsorted(hot_cells, cell), len(hot_cells) - 1)] == cell
        if not ok.any():
            return
        h1, h2, start, row = h1[ok], h2[ok], start[ok], row[ok]
        ids = batch.column(id_at).cast(pa.int64()).fill_null(_NO_ID).to_numpy()[row]
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        first = np.flatnonzero(new)
        least = np.minimum.reduceat(ids[order], first)
        number = np.empty(len(order), np.uint32)
        number[order] = np.cumsum(new) - 1
        a, b = a[first], b[first]
        for shard, s, e in _split(a, 64 - max(1, bits - shard_bits)):
            yield messages([(pack, shard, 1, several(deltas(a[s:e]), squeeze(b[s:e]), squeeze(least[s:e])))])
        yield messages([(pack, -1, 2, several(deltas(start.astype(np.uint32)), squeeze(number)))])

    return by_group(as_messages(packs).unionByName(hot), "pack", run, MESSAGE)


def _smallest(candidates: DataFrame) -> DataFrame:
    """Exact groups of a shard: for every pack's windows the smallest id anywhere."""
    def run(shard, rows):
        parts = [[f(x) for f, x in zip((undeltas, unsqueeze, unsqueeze), apart(data))] for _, _, _, data in rows]
        a, b, least = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((b, a))
        new = np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])
        low = np.minimum.reduceat(least[order], np.flatnonzero(new))
        out = np.empty(len(order), np.int64)
        out[order] = low[np.cumsum(new) - 1]
        at = 0
        for (pack, _, _, _), part in zip(rows, parts):
            yield messages([(pack, shard, 3, squeeze(out[at:at + len(part[0])]))])
            at += len(part[0])

    return by_group(candidates, "shard", run, MESSAGE)


def _removed(rows: list[tuple], id_at: int, size: int):
    """A pack's rows and, for each word of the pack, whether it goes; None if none does."""
    data = places = None
    least = []
    for _, _, kind, value in rows:
        if kind == 0:
            data = value
        elif kind == 2:
            places = value
        else:
            least.append(unsqueeze(value))
    batch = open_pack(data)
    if places is None:
        return batch, None, None
    start, number = (f(x) for f, x in zip((undeltas, unsqueeze), apart(places)))
    return batch, start.astype(np.int64), np.concatenate(least)[number]


def dedupe_packs(docs: DataFrame, size: int = WINDOW, shard_bits: int = SHARD_BITS, pack_bytes: int | None = None):
    """Messages by pack: kind 0 the pack, 2 places of candidate windows, 3 their smallest ids."""
    at, id_at = docs.columns.index("text"), docs.columns.index("doc_id")
    packs = make_packs(docs, **({"pack_bytes": pack_bytes} if pack_bytes else {}))
    total = packs.agg(F.sum("n_bytes")).first()[0] or 1
    bits = max(int(total - 1).bit_length(), shard_bits)
    hot = stage(_merge(_sketch(packs, at, bits, shard_bits, size), shard_bits), "hot-cells")
    found = stage(_candidates(packs, hot, at, id_at, bits, shard_bits, size), "candidates")
    least = _smallest(found.where("kind = 1"))
    return as_messages(packs).unionByName(found.where("kind = 2")).unionByName(least), at, id_at


def _judge(rows, at: int, id_at: int, size: int):
    """(batch, words per row as lists, per row a mask of removed words or None)."""
    batch, start, least = _removed(rows, id_at, size)
    words = [(v.as_py() or b"").split() for v in batch.column(at).cast(pa.binary())]
    ends = np.cumsum([len(w) for w in words])
    masks: list[np.ndarray | None] = [None] * len(words)
    if start is not None:
        ids = batch.column(id_at).cast(pa.int64()).fill_null(_NO_ID).to_numpy()
        row = np.searchsorted(ends, start, side="right")
        start = start[least < ids[row]]
        if len(start):
            edge = np.zeros(int(ends[-1]) + 1, np.int64)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + size, -1)
            gone = np.cumsum(edge[:-1]) > 0
            for r in np.unique(np.searchsorted(ends, start, side="right")).tolist():
                masks[r] = gone[ends[r] - len(words[r]):ends[r]]
    return batch, words, masks


def _kept(words: list[bytes], mask) -> bytes:
    return b" ".join(words if mask is None else [w for w, m in zip(words, mask.tolist()) if not m])


def digests(docs: DataFrame, size: int = WINDOW, shard_bits: int = SHARD_BITS, pack_bytes: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    rows, at, id_at = dedupe_packs(docs.select("doc_id", "text"), size, shard_bits, pack_bytes)

    def run(pack, mine):
        batch, words, masks = _judge(mine, at, id_at, size)
        gone = [0 if m is None else int(m.sum()) for m in masks]
        sha = [hashlib.sha256(_kept(w, m)).hexdigest() for w, m in zip(words, masks)]
        yield pa.RecordBatch.from_arrays([batch.column(id_at).cast(pa.int64()), pa.array([len(w) for w in words], pa.int64()),
                                          pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
                                         names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return by_group(rows, "pack", run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def dedupe(docs: DataFrame, size: int = WINDOW, shard_bits: int = SHARD_BITS) -> DataFrame:
    """``docs`` without the repeated words; texts that lose none stay as they are."""
    rows, at, id_at = dedupe_packs(docs, size, shard_bits)
    chars_at, names = (docs.columns.index("n_chars") if "n_chars" in docs.columns else -1), docs.columns

    def run(pack, mine):
        batch, words, masks = _judge(mine, at, id_at, size)
        texts, sizes = batch.column(at).to_pylist(), batch.column(chars_at).to_pylist() if chars_at >= 0 else []
        keep = []
        for r, mask in enumerate(masks):
            if mask is not None:
                texts[r] = _kept(words[r], mask).decode("utf-8", "surrogatepass")
                if chars_at >= 0:
                    sizes[r] = len(texts[r])
            if mask is None or texts[r]:
                keep.append(r)
        cols = list(batch.columns)
        cols[at] = pa.array(texts, cols[at].type)
        if chars_at >= 0:
            cols[chars_at] = pa.array(sizes, cols[chars_at].type)
        yield pa.RecordBatch.from_arrays(cols, names=[f"c{i}" for i in range(len(cols))]).take(pa.array(keep, pa.int64()))

    plain = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    return by_group(rows, "pack", run, plain).toDF(*names)


def op7_count_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


OP7_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS ws FROM documents),
win AS (SELECT r, doc_id, i, md5(array_to_string(ws[i:i + {WINDOW - 1}], ' ')) AS h
        FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM d)),
low AS (SELECT h, min(doc_id) AS least FROM win GROUP BY h),
gone AS (SELECT DISTINCT r, i + k AS p
         FROM (SELECT win.r, win.i FROM win JOIN low USING (h) WHERE low.least < win.doc_id), range(0, {WINDOW}) t(k)),
words AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, (len(d.ws) - coalesce(kept.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
