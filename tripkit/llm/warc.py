"""WARC archives with a globally ordered capture index.

Write: payloads of at least 1000 bytes that recur are stored once, in the record
with the largest page id; the others become revisit records. Each task writes
gzip-per-record archives into the shared folder and, besides, locally sorted
index runs, cut at range splits of (URL key, time, page id).

Index: the runs of a range are merged by a loser tree, at most ``FAN_IN`` at a
time and reading block by block, in as many passes as their number needs; the
range files in order are the history of every URL. A URL captured very often
spreads over ranges by time.

Read: captures from the merged index are dealt by archive and read by offset.

Files carry a fresh name per attempt and count only through rows that Spark has
committed, so lost tasks leave at most unused files. Sample keys for the splits
(a few hundred per range) and the number of runs reach the driver.

Defined results: null html is an empty payload, null URLs have an empty key,
null page ids rank below any and have no refers_to; equal rows are separate
captures, and all rows of the winning page id are responses; an empty table
gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import bisect
import hashlib
import uuid
import zlib
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripkit.llm.common import shuffle_width, stage, table, work_path

MIN_SHARED_BYTES = 1000
ARCHIVE_BYTES = 64 << 20
RUN_ENTRIES = 50_000
BLOCK_ENTRIES = 512
FAN_IN = 64
#: Keys sampled per range to place the splits.
SAMPLE_PER_RANGE = 200

_RUNS = "at int, path string, offset long, length long, entries long"


def url_key(url: str | None) -> str:
    """Sort-friendly form: host labels reversed, then port, path and query; no scheme, lower case host."""
    if not url:
        return ""
    try:
        u = urlsplit(url)
        host, port = (u.hostname or ""), u.port
    except ValueError:
        return "".join(c if c > " " else "%%%02X" % ord(c) for c in url)
    if not host:
        return "".join(c if c > " " else "%%%02X" % ord(c) for c in url)
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "") + ")" + (u.path or "/")
    key += f"?{u.query}" if u.query else ""
    return "".join(c if c > " " else "%%%02X" % ord(c) for c in key)


def _header(value: str) -> str:
    return "".join(c if c >= " " else "%%%02X" % ord(c) for c in value)


def make_record(page_id, url, date: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One gzip member holding one WARC record."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}",
             "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {refers_to}"]
    squash = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squash.compress("\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n") + squash.flush()


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload stored in the record) of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


class LoserTree:
    """Merge sorted iterators: each inner node keeps the loser of its match, the winner moves up."""

    def __init__(self, sources):
        self.sources = [iter(s) for s in sources]
        self.heads = [next(s, None) for s in self.sources]
        k = self.k = len(self.sources)
        self.tree = [-1] * max(1, k)
        for i in range(k):
            self._play(i)

    def _beats(self, i: int, j: int) -> bool:
        a, b = self.heads[i], self.heads[j]
        return a is not None and (b is None or (a, i) < (b, j))

    def _play(self, i: int) -> None:
        """Carry leaf i upward; an empty node keeps it until its opponent arrives."""
        node = (i + self.k) // 2
        while node:
            other = self.tree[node]
            if other < 0:
                self.tree[node] = i
                return
            if self._beats(other, i):
                self.tree[node], i = i, other
            node //= 2
        self.tree[0] = i

    def __iter__(self):
        while self.k and self.heads[w := self.tree[0]] is not None:
            yield self.heads[w]
            self.heads[w] = next(self.sources[w], None)
            self._play(w)


def _fs(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("/") else fs.FileSystem.from_uri("file://" + path.removeprefix("file:"))


def _create(folder: str, kind: str):
    """(path, open file) of a fresh file in the shared folder."""
    path = f"{folder}/{kind}-{uuid.uuid4().hex}"
    files, inner = _fs(path)
    files.create_dir(inner.rpartition("/")[0], recursive=True)
    return path, files.open_output_stream(inner, compression=None)


def _write_slice(out, entries: list[bytes]) -> int:
    """Append sorted entries as blocks; the length written."""
    done = 0
    for s in range(0, len(entries), BLOCK_ENTRIES):
        body = zlib.compress(b"\n".join(entries[s:s + BLOCK_ENTRIES]), 1)
        out.write(len(body).to_bytes(4, "little") + body)
        done += 4 + len(body)
    return done


def _read_slice(path: str, offset: int, length: int):
    """Entries of a slice, one block in memory at a time."""
    files, inner = _fs(path)
    with files.open_input_file(inner) as f:
        end = offset + length
        while offset < end:
            n = int.from_bytes(f.read_at(4, offset), "little")
            yield from zlib.decompress(f.read_at(n, offset + 4)).split(b"\n")
            offset += 4 + n


def _entry(key: str, time: str, page_id, archive: str, offset: int, length: int) -> bytes:
    """Index line; bytes sort by key, time, page id (a fixed-width field, null lowest)."""
    order = "0" if page_id is None else f"1{page_id + (1 << 63):020d}"
    return f"{key} {time} {order} {archive} {offset} {length}".encode("utf-8", "surrogatepass")


def _run_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    cols = list(zip(*rows)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["at", "path", "offset", "length", "entries"])


def _prepared(pages: DataFrame, time) -> DataFrame:
    """Pages with payload, digest, capture time and the page that a revisit refers to."""
    payload = F.coalesce("html", F.lit(""))
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
                        F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n_bytes"), time.alias("time"))
    shared = (base.where(F.col("n_bytes") >= MIN_SHARED_BYTES).groupBy("digest")
              .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").select("digest", "keeper"))
    # A digest with a third of all rows: few digests are shared, which Spark then broadcasts by
    # their measured size; else the join is a shuffle whose skewed partitions it splits.
    return (base.join(shared, "digest", "left")
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))).drop("keeper"))


def _splits(pages: DataFrame, time, ranges: int) -> list[bytes]:
    n = pages.count()
    few = pages.select("page_id", "url", time.alias("time")).sample(min(1.0, SAMPLE_PER_RANGE * ranges / max(1, n)), 11).collect()
    keys = sorted(_entry(url_key(r["url"]), r["time"], r["page_id"], "", 0, 0) for r in few)
    return sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)}) if keys else []


def write_archives(pages: DataFrame, folder: str, time=None, archive_bytes: int = ARCHIVE_BYTES, run_entries: int = RUN_ENTRIES,
                   ranges: int | None = None) -> DataFrame:
    """Write every row as a record under ``folder``; staged rows name the sorted index runs by range.

    ``time`` is a column of capture times (``yyyy-MM-dd'T'HH:mm:ss'Z'`` text); without
    one the capture time is 2020-01-01 plus the page id in seconds.
    """
    if time is None:
        time = F.date_format(F.timestamp_seconds(F.lit(1577836800) + F.coalesce(F.col("page_id"), F.lit(0)) % 10 ** 9), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    splits = _splits(pages, time, ranges or shuffle_width(pages.sparkSession))

    def run(batches):
        archive, name, size, held = None, "", 0, []

        def close_run():
            held.sort()
            cut = [0, *(bisect.bisect_left(held, s) for s in splits), len(held)]
            path, out = _create(folder, "run")
            rows, at = [], 0
            with out:
                for i, (s, e) in enumerate(zip(cut[:-1], cut[1:])):
                    if e > s:
                        n = _write_slice(out, held[s:e])
                        rows.append((i, path, at, n, e - s))
                        at += n
            held.clear()
            return _run_rows(rows)

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "time", "payload", "digest", "refers_to"))):
                page_id, url, date, payload, digest, refers_to = (v.as_py() for v in row)
                if archive is None:
                    (name, archive), size = _create(folder, "archive"), 0
                record = make_record(page_id, url, date, payload.encode("utf-8", "surrogatepass"), digest, refers_to)
                archive.write(record)
                held.append(_entry(url_key(url), date, page_id, name, size, len(record)))
                size += len(record)
                if size >= archive_bytes:
                    archive.close()
                    archive = None
                if len(held) >= run_entries:
                    yield close_run()
        if archive is not None:
            archive.close()
        if held:
            yield close_run()

    columns = ["page_id", "url", "time", "payload", "digest", "refers_to"]
    return stage(_prepared(pages, time).select(*columns).mapInArrow(run, _RUNS), "warc-runs")


def merge_runs(runs: DataFrame, folder: str, fan_in: int = FAN_IN) -> DataFrame:
    """One sorted index file per range, by passes of k-way merges; staged rows as from ``write_archives``."""
    def run(batches):
        held: list[dict] = []

        def close():
            path, out = _create(folder, "index")
            done = n = 0
            block: list[bytes] = []
            with out:
                for entry in LoserTree(_read_slice(r["path"], r["offset"], r["length"]) for r in held):
                    block.append(entry)
                    if len(block) == BLOCK_ENTRIES:
                        done += _write_slice(out, block)
                        n += len(block)
                        block = []
                done += _write_slice(out, block)
            return _run_rows([(held[0]["at"], path, 0, done, n + len(block))])

        for batch in batches:
            for row in batch.to_pylist():
                if held and (held[0]["at"], held[0]["team"]) != (row["at"], row["team"]):
                    yield close()
                    held = []
                held.append(row)
        if held:
            yield close()

    width = shuffle_width(runs.sparkSession)
    first = True
    while True:
        most = runs.groupBy("at").count().agg(F.max("count")).first()[0] or 0
        if most <= 1 and not first:
            return runs
        order = Window.partitionBy("at").orderBy("path", "offset")
        teams = runs.withColumn("team", F.floor((F.row_number().over(order) - 1) / fan_in))
        dealt = teams.repartition(width, "at", "team").sortWithinPartitions("at", "team", "path", "offset")
        runs, first = stage(dealt.mapInArrow(run, _RUNS), "warc-index"), False


def captures(index: DataFrame) -> DataFrame:
    """The history from the merged index: (at, seq) is the global order of (key, time, page_id);
    with the place of each record."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                rows, seq = [], 0
                for line in _read_slice(r["path"], r["offset"], r["length"]):
                    key, time, order, archive, offset, length = line.decode("utf-8", "surrogatepass").split(" ")
                    rows.append((r["at"], seq, key, time, None if order == "0" else int(order[1:]) - (1 << 63), archive, int(offset), int(length)))
                    seq += 1
                    if len(rows) == 4096:
                        yield batch_of(rows)
                        rows = []
                if rows:
                    yield batch_of(rows)

    kinds = [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["at", "seq", "url_key", "time", "page_id", "archive", "offset", "length"]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return index.repartition(shuffle_width(index.sparkSession), "at").mapInArrow(
        run, "at int, seq long, url_key string, time string, page_id long, archive string, offset long, length long")


def read_records(history: DataFrame, with_payload: bool = False) -> DataFrame:
    """Read every capture's record: page_id, payload_bytes, payload_digest, record_type, refers_to, url_key,
    time (and the stored payload). A stored payload that does not fit its digest is an error."""
    def run(batches):
        path, file = None, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["archive"] != path:
                    if file is not None:
                        file.close()
                    path = r["archive"]
                    files, inner = _fs(path)
                    file = files.open_input_file(inner)
                headers, payload = parse_record(file.read_at(r["length"], r["offset"]))
                digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
                n = int(headers["X-Payload-Length"])
                if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != n):
                    raise ValueError(f"damaged record in {path} at {r['offset']}")
                page, other = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page")
                out.append((None if page is None else int(page), n, digest, kind, None if other is None else int(other),
                            r["url_key"], r["time"], *([payload] if with_payload else [])))
                if len(out) == 1024:
                    yield rows_of(out)
                    out = []
            if out:
                yield rows_of(out)
        if file is not None:
            file.close()

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "time", "payload"]

    def rows_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names[:len(rows[0])])

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url_key string, time string"
    dealt = history.select("archive", "offset", "length", "url_key", "time").repartition(shuffle_width(history.sparkSession), "archive")
    return dealt.sortWithinPartitions("archive", "offset").mapInArrow(run, schema + (", payload binary" if with_payload else ""))


def op3_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_path(spark, "warc")
    runs = write_archives(table(spark, sf_dir, "pages"), folder)
    return (read_records(captures(merge_runs(runs, folder)))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


OP3_SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
k AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {MIN_SHARED_BYTES} AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {MIN_SHARED_BYTES} AND page_id <> keeper THEN keeper END AS refers_to
FROM k
"""
