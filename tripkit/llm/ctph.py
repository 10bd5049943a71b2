"""Document fingerprints by context-triggered piecewise hashing.

A hash of the last 7 bytes is taken at every byte; where its trailing zero bits
reach k a chunk of block size 2**k ends, so boundaries follow content. A chunk
has half to one and a half block sizes: in that range it ends at the first byte
that reaches k, else at the first of those that come nearest. So repeats, which
all trigger at the same few levels, are cut as finely as other text. k is the
smallest level with at most 64 chunks in the whole text, which leaves at least
11 to a text of more than 64 bytes (32 or more as a rule), and a chunk a byte to
a shorter one. A fingerprint is ``k:signature at k:signature at k + 1``, one
character (6 bits of a CRC) per chunk, two for a single chunk. Fingerprints
compare by edit distance at block sizes both have.

``compare_next`` compares every document with its edited form and its successor
in descending id. Rows are routed once to id ranges; the first row of a range
is sent also to the range before it, so that neighbours always meet and no
global window is needed.

Defined results: null text is empty, with signature ``2::``; equal texts have
equal fingerprints and likeness 1; rows of equal id follow each other by text;
null ids come last; a single row is its own successor; an empty table gives no
rows. Only id and text are read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm.common import shuffle_width, table

MAX_CHUNKS = 64
EMPTY = "2::"
WINDOW = 7
_MUL = [pow(0x01000193, k + 1, 1 << 32) * 2 + 1 & 0xFFFFFFFF for k in range(WINDOW)]
_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def _reached(data: bytes) -> np.ndarray:
    """The lowest bit set in the hash that ends at each byte: 2**(trailing zero bits)."""
    a = np.frombuffer(data, np.uint8).astype(np.uint32)
    h = a * np.uint32(_MUL[0])
    for k in range(1, min(WINDOW, len(a))):
        h[k:] += a[:-k] * np.uint32(_MUL[k])
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(12)
    h *= np.uint32(0x297A2D39)
    h ^= h >> np.uint32(15)
    h[h == 0] = 1 << 31
    return h & (~h + np.uint32(1))


def _cuts(reached: np.ndarray, level: int) -> list[int]:
    """Ends of the chunks of block size 2**level."""
    block, n = 1 << level, len(reached)
    low, high = (block + 1) // 2, 3 * block // 2
    reached = np.minimum(reached, np.uint32(block))
    ends, s = [], 0
    while n - s > low:
        s += low + int(reached[s + low - 1:s + high].argmax())
        ends.append(s)
    if s < n:
        ends.append(n)
    return ends


def _signature(view: memoryview, ends: list[int]) -> str:
    crc, out, s = zlib.crc32, [], 0
    for e in ends:
        out.append(_CHARS[crc(view[s:e]) & 63])
        s = e
    if len(out) == 1:
        out.append(_CHARS[crc(view) >> 6 & 63])
    return "".join(out)


def fingerprint(text: str | None) -> str:
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return EMPTY
    reached = _reached(data)
    k = max(0, (2 * len(data) // (3 * MAX_CHUNKS)).bit_length() - 1)  # chunks of 3/2 blocks would be too many below
    while len(ends := _cuts(reached, k)) > MAX_CHUNKS:
        k += 1
    view = memoryview(data)
    return f"{k}:{_signature(view, ends)}:{_signature(view, _cuts(reached, k + 1))}"


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, bit-parallel over one machine integer per character of b."""
    if not a or not b:
        return max(len(a), len(b))
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    plus, minus, dist = full, 0, len(a)
    for c in b:
        eq = masks.get(c, 0)
        zero = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | ~(zero | plus), plus & zero
        dist += bool(up & top) - bool(down & top)
        up = up << 1 | 1
        plus = (down << 1 | ~(zero | up)) & full
        minus = zero & up & full
    return dist


def likeness(x: str, y: str) -> float:
    """0 to 1: 1 - edit distance / longer length, the best over block sizes both fingerprints have."""
    if x == y:
        return 1.0
    kx, *sx = x.split(":")
    ky, *sy = y.split(":")
    best = 0.0
    for i in range(2):
        j = int(kx) + i - int(ky)
        if j in (0, 1) and (n := max(len(sx[i]), len(sy[j]))):
            best = max(best, 1 - edit_distance(sx[i], sy[j]) / n)
    return best


def edited(text: str, after: str) -> str:
    """The last floor(n/3) code points replaced by the first as many of the next text."""
    m = len(text) // 3
    return text[:len(text) - m] + after[:m]


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row; no shuffle."""
    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").cast(pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([fingerprint(t) for t in texts], pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Every document with its edited form and its successor in descending id.

    On the driver: one split point and one largest id per range.
    """
    spark = docs.sparkSession
    width = shuffle_width(spark)
    ranges = ranges or 3 * width
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    low = -(2 ** 63)
    splits = np.array(rows.stat.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.2 / ranges) if ranges > 1 else [], float)

    def keys(batch):
        return batch.column("doc_id").fill_null(low).to_numpy(zero_copy_only=False)

    def heads_of(batches):
        top: dict[int, int] = {}
        for b in batches:
            k = keys(b)
            for r in np.unique(at := np.searchsorted(splits, k, side="right")).tolist():
                top[r] = max(top.get(r, low), int(k[at == r].max()))
        yield pa.RecordBatch.from_arrays([pa.array(list(top), pa.int32()), pa.array(list(top.values()), pa.int64())], names=["r", "top"])

    tops = rows.select("doc_id").mapInArrow(heads_of, "r int, top long").groupBy("r").agg(F.max("top").alias("top")).collect()
    order = sorted(((t["r"], t["top"]) for t in tops), reverse=True)
    #: range -> (its largest id, the range in which that row is the successor of the last one)
    head = {r: (top, order[i - 1][0]) for i, (r, top) in enumerate(order)}

    def route(batches):
        for b in batches:
            k = keys(b)
            at = np.searchsorted(splits, k, side="right")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32()), pa.array(np.zeros(len(at), bool))],
                                             names=["doc_id", "text", "r", "guest"])
            first = np.flatnonzero([head[r][0] == i for r, i in zip(at.tolist(), k.tolist())])
            if len(first):
                few = b.take(pa.array(first))
                to = [head[r][1] for r in at[first].tolist()]
                yield pa.RecordBatch.from_arrays([*few.columns, pa.array(to, pa.int32()), pa.array(np.ones(len(to), bool))],
                                                 names=["doc_id", "text", "r", "guest"])

    def compare(batches):
        last = None  # (range, id, text, fingerprint) still without its successor
        for big in batches:
            for start in range(0, len(big), 1024):
                out = []
                for row in big.slice(start, 1024).to_pylist():
                    r, text = row["r"], row["text"] or ""
                    if last and last[0] != r:
                        raise RuntimeError("a range lacks its successor row")
                    if not last and row["guest"]:
                        continue  # further rows of the id that follows this range
                    print_ = fingerprint(text)
                    if last:
                        changed = edited(last[2], text)
                        other = fingerprint(changed)
                        out.append((last[1], len(last[2]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                                    last[3], other, likeness(last[3], other), likeness(last[3], print_)))
                    last = None if row["guest"] else (r, row["doc_id"], text, print_)
                if out:
                    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                     names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    routed = rows.mapInArrow(route, "doc_id long, text string, r int, guest boolean")
    met = routed.repartition(width, "r").sortWithinPartitions("r", "guest", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())
    return met.mapInArrow(compare, _OUT)


def op2_ctph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_next(table(spark, sf_dir, "documents"))
