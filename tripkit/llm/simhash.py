"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Fingerprints within 3 bits of each other differ in at most 3 of their 8 bytes,
so they share at least 5 positional bytes. The index posts each distinct
fingerprint under eight triples of positional bytes, chosen so that any 5
positions contain one; a pair's shared bytes are tallied only inside a posting,
pairs reaching 5 are verified by their bits. A posting that outgrows
``MAX_POSTING`` is not cut: its fingerprints move on to postings with one more
byte (each pair under its first further shared byte), at most to 5 bytes, where
the rest is searched by the possible differences, in time linear in its size.

A posting yields a forest of its links (size - 1 edges at most), which keeps
every component; components come from alternating star contractions in the
shared folder. Copies count once per distinct fingerprint throughout.

Defined results: null, empty and word-free texts have fingerprint zero, linked
like any other; repeated rows and copies share a component; a component's id is
its smallest id, null if it has none; ``keep_one`` keeps one row of each
component, of null id only where no other id is in it; an empty table gives no rows. Columns of the input pass through ``keep_one``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkit.llm.common import free_name, shuffle_width, stage, table

SHINGLE = 3
MAX_BITS = 3
SEED = 42
MIN_SHARED = 5
#: Fingerprints one posting may hold before it is split by a further byte.
MAX_POSTING = 20_000
#: Any 5 of 8 positions have 3 in one half, hence contain one of these.
TRIPLES = [t for half in (range(0, 4), range(4, 8)) for t in combinations(half, 3)]


def text_simhash(text: str | None, k: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint: bit set if set in over half of the shingles' XXH64."""
    from xxhash import xxh64_digest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= k:
        digests = [xxh64_digest(joined, SEED)]
    else:
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.concatenate([[0], np.cumsum(size[:-1] + 1)])
        digests = [xxh64_digest(joined[s:e], SEED) for s, e in zip(start[:len(words) - k + 1].tolist(), (start + size)[k - 1:].tolist())]
    n, ones = len(digests), np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        part = np.frombuffer(b"".join(digests[at:at + 65_536]), np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def simhashes(docs: DataFrame, k: int = SHINGLE, keep: str | None = None) -> DataFrame:
    """(doc_id, fp) of every row; no shuffle. With ``keep`` that column as it is for the id."""
    def run(batches):
        for b in batches:
            fps = [text_simhash(t.as_py(), k) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column(keep) if keep else b.column("doc_id").cast(pa.int64()), pa.array(fps, pa.int64())],
                                             names=["doc_id", "fp"])

    kind = docs.schema[keep].dataType.simpleString() if keep else "bigint"
    return docs.select(keep or "doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp bigint")


def _bytes(fp: np.ndarray) -> np.ndarray:
    return fp.astype(">i8").view(np.uint8).reshape(-1, 8)


def _key(octets: np.ndarray, positions) -> np.ndarray:
    """Posting key: the position set in the top bits, then the bytes there."""
    key = np.full(len(octets), sum(1 << p for p in positions), np.int64)
    for p in positions:
        key = key << 8 | octets[:, p]
    return key


def _positions(key: int) -> list[int]:
    for n in (3, 4, 5):
        mask = key >> (8 * n)
        if 0 < mask < 256 and bin(mask).count("1") == n:
            return [p for p in range(8) if mask >> p & 1]
    raise ValueError(key)


class _Forest:
    """Union-find over the members of one posting."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def link(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def _by_differences(fp: np.ndarray, free: list[int], max_bits: int, forest: _Forest) -> None:
    """Links among fingerprints equal outside the byte positions ``free``: look up every difference."""
    order = np.argsort(fp)
    known = fp[order]
    bits = [np.uint64(1) << np.uint64(8 * (7 - p) + b) for p in free for b in range(8)]
    for n in range(1, max_bits + 1):
        for some in combinations(bits, n):
            want = (fp.view(np.uint64) ^ np.bitwise_or.reduce(np.array(some, np.uint64))).view(np.int64)
            at = np.minimum(np.searchsorted(known, want), len(known) - 1)
            for i in np.flatnonzero((known[at] == want) & (want > fp)).tolist():
                forest.link(i, int(order[at[i]]))


def _tally(fp: np.ndarray, octets: np.ndarray, members: np.ndarray, free: list[int], need: int, max_bits: int, forest: _Forest,
           later: int = 0) -> None:
    """Link the members that share ``need`` more of the byte positions ``free`` and pass the bit check.

    A larger group is posted by one more byte: a pair under the first position
    it shares, hence only positions from index ``later`` on are left to it.
    """
    m = len(members)
    if m < 2:
        return
    if m <= 512:
        o = octets[members]
        shared = np.zeros((m, m), np.uint8)
        for p in free:
            shared += o[:, p][:, None] == o[:, p][None, :]
        i, j = np.nonzero(np.triu(shared >= need, 1))
        x = fp[members].view(np.uint64)
        ok = np.bitwise_count(x[i] ^ x[j]) <= max_bits
        for a, b in zip(members[i[ok]].tolist(), members[j[ok]].tolist()):
            forest.link(a, b)
    elif need <= 0:
        local = _Forest(m)
        _by_differences(fp[members], free, max_bits, local)
        for a in range(m):
            if (r := local.root(a)) != a:
                forest.link(int(members[a]), int(members[r]))
    else:
        for at in range(later, len(free) - need + 1):
            column = octets[members, free[at]]
            order = np.argsort(column, kind="stable")
            rest = free[:at] + free[at + 1:]
            for sub in np.split(members[order], np.flatnonzero(np.diff(column[order])) + 1):
                _tally(fp, octets, sub, rest, need - 1, max_bits, forest, at)


def _posting_links(fp: np.ndarray, used: list[int], max_bits: int):
    """Edges of a forest over one posting's links."""
    forest = _Forest(len(fp))
    _tally(fp, _bytes(fp), np.arange(len(fp)), [p for p in range(8) if p not in used], MIN_SHARED - len(used), max_bits, forest)
    root = np.array([forest.root(i) for i in range(len(fp))])
    own = np.flatnonzero(root != np.arange(len(fp)))
    return fp[own], fp[root[own]]


def _post(fps: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            fp = b.column("fp").to_numpy()
            o = _bytes(fp)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([_key(o, t) for t in TRIPLES])), pa.array(np.tile(fp, len(TRIPLES)))],
                                             names=["key", "fp"])
    return fps.select("fp").mapInArrow(run, "key long, fp long")


def _refine(rows: DataFrame) -> DataFrame:
    """Postings of one more byte for (key, fp) rows of large postings."""
    def run(batches):
        for b in batches:
            key, fp = b.column("key").to_numpy(), b.column("fp").to_numpy()
            keys, out = [], []
            for k in np.unique(key).tolist():
                mine, used = fp[key == k], _positions(k)
                o = _bytes(mine)
                for p in range(8):
                    if p not in used:
                        keys.append(_key(o, sorted([*used, p])))
                        out.append(mine)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(out))], names=["key", "fp"])
    return rows.mapInArrow(run, "key long, fp long").distinct()


def _match(posted: DataFrame, max_bits: int, max_posting: int, last: bool) -> DataFrame:
    """Rows (kind, a, b): kind 0 a link, kind 1 a (key, fp) row of a posting to be refined."""
    def run(batches):
        key, parts, held, moved = None, [], 0, False

        def rows(kind, a, b):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind), pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                              names=["kind", "a", "b"])

        def close():
            if key is not None and held > 1 and not moved:
                a, b = _posting_links(np.concatenate(parts), _positions(key), max_bits)
                if len(a):
                    yield rows(0, a, b)

        for batch in batches:
            ks, fs = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
            cut = np.concatenate([[0], np.flatnonzero(np.diff(ks)) + 1, [len(ks)]])
            size = np.diff(cut)
            if len(cut) > 3:  # postings of two that lie inside the batch, all at once
                two = 1 + np.flatnonzero(size[1:-1] == 2)
                x, y = fs[cut[two]], fs[cut[two] + 1]
                shared = (_bytes(x) == _bytes(y)).sum(axis=1)  # the tally, then the bits
                ok = (shared >= MIN_SHARED) & (np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)) <= max_bits)
                if ok.any():
                    yield rows(0, x[ok], y[ok])
            for g in np.flatnonzero((size > 2) | (np.arange(len(size)) == 0) | (np.arange(len(size)) == len(size) - 1)).tolist() if len(ks) else ():
                s, e = cut[g], cut[g + 1]
                if ks[s] != key:
                    yield from close()
                    key, parts, held, moved = int(ks[s]), [], 0, False
                parts.append(fs[s:e])
                held += e - s
                if not last and held > max_posting:
                    for p in parts:
                        yield rows(1, np.full(len(p), key), p)
                    parts, moved = [], True
        yield from close()

    width = shuffle_width(posted.sparkSession)
    return posted.repartition(width, "key").sortWithinPartitions("key").mapInArrow(run, "kind int, a long, b long")


def links(fps: DataFrame, max_bits: int = MAX_BITS, max_posting: int = MAX_POSTING) -> DataFrame:
    """Forest links (a, b) that join all distinct fingerprints ``fp`` within ``max_bits`` (at most 3)."""
    if max_bits > 8 - MIN_SHARED:
        raise ValueError("5 shared bytes are guaranteed for at most 3 bits")
    posted, found = _post(fps), []
    for level in (3, 4, 5):
        got = stage(_match(posted, max_bits, max_posting, level == MIN_SHARED), f"simhash-match-{level}")
        found.append(got.where("kind = 0").select("a", "b"))
        more = got.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"))
        if level == MIN_SHARED or more.isEmpty():
            break
        posted = _refine(more)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node reachable; nodes without a link do not appear.

    Alternating large-star and small-star steps; only two numbers per round reach the driver.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        joined = both.join(low, "a")
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    now, before = stage(edges.where("a <> b").select("a", "b"), "links"), None
    while True:
        now = stage(star(star(now, True), False), "stars")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == before:
            break
        before = tuple(mark)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _rooted(groups: DataFrame, max_bits: int) -> DataFrame:
    """``groups``, one row per fingerprint ``fp``, with ``root``: the smallest fingerprint of its component."""
    comp = components(links(groups.select("fp"), max_bits))
    return groups.join(comp, groups["fp"] == comp["node"], "left").select(groups["*"], F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``."""
    prints = stage(simhashes(docs, k), "simhash")
    groups = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-groups")
    rooted = _rooted(groups, max_bits)
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(ids, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def _place(docs: DataFrame) -> Column:
    """Order of rows inside a component: id with nulls last, hashes of the text and of the other columns."""
    text, rest = F.coalesce("text", F.lit("")), [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("doc_id", "text")]
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                    F.xxhash64(text).alias("h"), F.md5(text).alias("m"), F.col("text").isNull().alias("no_text"),
                    (F.md5(F.to_json(F.struct(*rest))) if rest else F.lit("")).alias("r"))


def keep_one(docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component: the smallest id, nulls last, then the smallest text hash.

    Rows are chosen by what they hold, never by id alone: the smallest place (id
    and hashes, no text) per fingerprint, then per component, are aggregates, and
    whole rows are only streamed past the chosen places. Rows of one place are
    equal; where a chosen place has several, a second pass keeps one of them.
    """
    place, times = free_name(docs, "place"), free_name(docs, "times")
    prints = simhashes(docs.select(_place(docs).alias("doc_id"), "text"), k, keep="doc_id")
    counted = prints.groupBy("fp", "doc_id").agg(F.count("*").alias("n"))
    groups = stage(counted.groupBy("fp").agg(F.min(F.struct("doc_id", "n")).alias("least")), "simhash-groups")
    best = _rooted(groups, max_bits).groupBy("root").agg(F.min("least").alias("d"))
    best = stage(best.select(F.col("d.doc_id").alias(place), F.col("d.n").alias(times)), "simhash-kept")
    placed = docs.withColumn(place, _place(docs))

    def chosen(rows: str) -> DataFrame:
        # The hash table is of places; a sort of the documents would hold their texts in memory.
        return placed.join(best.where(f"`{times}` {rows}").select(place).hint("shuffle_hash"), place, "left_semi")

    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = chosen("= 1").select(*columns)
    if best.where(f"`{times}` > 1").isEmpty():
        return out
    return out.unionByName(chosen("> 1").dropDuplicates([place]).select(*columns))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
