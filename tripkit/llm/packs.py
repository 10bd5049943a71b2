"""Packs of documents and compact arrays, exchanged between tasks as binary rows.

A pack is some megabytes of rows as one compressed Arrow batch, staged once in
the shared folder under a fixed number. Steps send arrays from packs to shards
(sorted, delta-coded, compressed) and get answers back by pack number, so what
crosses the network is a few bytes a value and a hot value counts once a pack.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkit.llm.common import shuffle_width, stage

#: Raw text bytes after which a pack is closed.
PACK_BYTES = 8 << 20
MESSAGE = "pack long, shard long, kind int, data binary"


def squeeze(a: np.ndarray) -> bytes:
    """Compress an integer array, byte plane by byte plane."""
    a = np.ascontiguousarray(a)
    head = f"{a.dtype.str}:".encode()
    planes = a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T if len(a) else np.empty(0, np.uint8)
    return head + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unsqueeze(data: bytes) -> np.ndarray:
    kind, _, body = data.partition(b":")
    dtype = np.dtype(kind.decode())
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)
    return np.ascontiguousarray(planes.reshape(dtype.itemsize, -1).T).view(dtype).reshape(-1)


def deltas(a: np.ndarray) -> bytes:
    """``squeeze`` of a sorted unsigned array as steps."""
    return squeeze(np.diff(a, prepend=a.dtype.type(0)))


def undeltas(data: bytes) -> np.ndarray:
    steps = unsqueeze(data)
    return np.cumsum(steps, dtype=steps.dtype)


def order_of(x: np.ndarray) -> np.ndarray:
    """Stable order of integers from 0 up: places ride in the low bits of one plain sort, which is
    several times faster than an argsort. If bits had to give way for them, the order is checked."""
    n = len(x)
    if n < 2:
        return np.arange(n)
    x = x.astype(np.uint64, copy=False)
    key = x - x.min()
    bits = (n - 1).bit_length()
    drop = max(0, int(key.max()).bit_length() + bits - 64)
    key >>= np.uint64(drop)
    key <<= np.uint64(bits)
    key |= np.arange(n, dtype=np.uint64)
    key.sort()
    key &= np.uint64((1 << bits) - 1)
    by = key.view(np.int64)
    if drop and ((y := x[by])[1:] < y[:-1]).any():
        by = np.argsort(x, kind="stable")
    return by


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of integers from 0 up, and each one's number among them."""
    by = order_of(x)
    y = x[by]
    new = np.ones(len(x), bool)
    new[1:] = y[1:] != y[:-1]
    number = np.empty(len(x), np.int64)
    number[by] = np.cumsum(new) - 1
    return y[new], number


def several(*parts: bytes) -> bytes:
    """Join binary values into one."""
    return b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def apart(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at:at + 8], "little")
        out.append(data[at + 8:at + 8 + n])
        at += 8 + n
    return out


def messages(rows: list[tuple]) -> pa.RecordBatch:
    """Rows (pack, shard, kind, data) as a batch."""
    cols = list(zip(*rows)) or [[], [], [], []]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["pack", "shard", "kind", "data"])


def batched(rows, n_bytes: int = 1 << 18):
    """``messages`` of rows in batches of about ``n_bytes``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3])
        if size >= n_bytes:
            yield messages(held)
            held, size = [], 0
    if held:
        yield messages(held)


def grouped(batches, text_at: int, pack_bytes: int):
    """(number, text bytes, table) for successive rows with about ``pack_bytes`` of text; one row at least.

    Numbers are fixed by the partition and the order in it, so a repeated task repeats them.
    """
    import pyarrow.compute as pc
    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        lens = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
        start = 0
        for i, n in enumerate(lens.tolist()):
            size += n
            if size >= pack_bytes:
                held.append(batch.slice(start, i + 1 - start))
                yield number, size, pa.Table.from_batches(held)
                number, held, size, start = number + 1, [], 0, i + 1
        if start < len(batch):
            held.append(batch.slice(start))
    if held:
        yield number, size, pa.Table.from_batches(held)


def make_packs(docs: DataFrame, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """Staged rows (pack, n_bytes, n_rows, data); every column of ``docs`` is inside."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index("text")

    def run(batches):
        for number, size, whole in grouped(batches, at, pack_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, whole.schema) as out:
                out.write_table(whole.combine_chunks())
            data = zstandard.ZstdCompressor(level=3).compress(sink.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([size], pa.int64()), pa.array([whole.num_rows], pa.int64()),
                                              pa.array([data], pa.binary())], names=["pack", "n_bytes", "n_rows", "data"])

    return stage(docs.toDF(*names).mapInArrow(run, "pack long, n_bytes long, n_rows long, data binary"), "packs")


def open_pack(data: bytes) -> pa.RecordBatch:
    """The rows of a pack, columns c0, c1, ... in their order."""
    with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)) as got:
        table = got.read_all().combine_chunks()
    return table.to_batches()[0]


def over_packs(packs: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(pack, RecordBatch)`` yields batches for every pack."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                yield from fn(row["pack"], open_pack(row["data"]))
    return packs.select("pack", "data").mapInArrow(run, schema)


def by_group(rows: DataFrame, key: str, fn, schema: str) -> DataFrame:
    """``fn(key, rows)`` yields batches for the (pack, shard, kind, data) rows of each value of ``key``,
    in the order (kind, shard, pack)."""
    at = {"pack": 0, "shard": 1}[key]

    def run(batches):
        held: list[tuple] = []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and held[0][at] != row[at]:
                    yield from fn(held[0][at], held)
                    held = []
                held.append(row)
        if held:
            yield from fn(held[0][at], held)

    width = shuffle_width(rows.sparkSession)
    rows = rows.select("pack", "shard", "kind", "data")
    return rows.repartition(width, key).sortWithinPartitions(key, "kind", "shard", "pack").mapInArrow(run, schema)


def as_messages(packs: DataFrame) -> DataFrame:
    return packs.select("pack", F.lit(0).cast("long").alias("shard"), F.lit(0).alias("kind"), "data")


class Numbers(dict):
    """Consecutive numbers for distinct keys as they are looked up."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def token_numbers(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(word numbers of all texts in a row, words per text, the distinct words)."""
    import pyarrow.compute as pc
    texts = pc.fill_null(texts, "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    sizes = pc.list_value_length(split).to_numpy().astype(np.int64)
    coded = split.flatten().dictionary_encode()
    del split
    numbers, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.binary()).to_pylist()
    if b"" in words:  # outer whitespace leaves an empty word
        empty = words.index(b"")
        word = numbers != empty
        sizes -= np.bincount(np.repeat(np.arange(len(sizes)), sizes)[~word], minlength=len(sizes))
        numbers = numbers[word]
        numbers -= numbers > empty
        del words[empty]
    return numbers, sizes, words
