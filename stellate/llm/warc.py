"""Operator 8: WARC archives with a two-level capture index.

Tasks write WARC files (one gzip member a record) and report each record's
place. A payload seen before is written as a revisit that names the record
with the smallest page id. The index sorts captures by reversed-host keys
(``com,example)/path``) into compressed blocks of lines, index files in key
order; beside them a sparse directory has each block's first key and place.
A lookup finds the index files by their key ranges, the block by binary
search in the file's directory, the line by binary search in the block, and
reads the record's bytes from the archive; nothing reads whole files.

Files go through the file system of the shared scratch folder (any that
Arrow reaches). Each task attempt writes files of its own name; only those
of finished tasks get into the tables of places, so retries do no harm.

Defined cases: a NULL html is an empty payload; a NULL or odd url has the
key its characters give after escaping; equal payloads: rows that carry the
smallest page id are responses, also if repeated, rows with a NULL id
revisit it, and without any id all are responses; an empty table writes no
record. Other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellate.llm.common import bounded, materialise
from stellate.session import new_scratch_dir

_KEEP = "/:?#[]@!$&'()*+,;=%-._~"
CAPTURE_SQL = ("page_id bigint, surt string, url string, payload_digest string, payload_bytes bigint, record_type string, "
               "refers_to bigint, file string, offset bigint, length bigint")
_CAPTURE = pa.schema([("page_id", pa.int64()), ("surt", pa.string()), ("url", pa.string()), ("payload_digest", pa.string()),
                      ("payload_bytes", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()),
                      ("offset", pa.int64()), ("length", pa.int64())])
RECORD_SQL = ("page_id bigint, url string, payload_digest string, payload_bytes bigint, record_type string, refers_to bigint, "
              "payload binary")


def surt(url: str | None) -> str:
    """The reversed-host key of a url, without blanks."""
    text = quote((url or "").strip(), safe=_KEEP)
    try:
        parts = urlsplit(text)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return text.lower()
    if not host:
        return text.lower()
    key = ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "")
    return key + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def _fs(path: str):
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return fs.LocalFileSystem(), path


def _qualified(spark, path: str) -> str:
    """The path with the scheme under which Spark's executors resolve it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


#: Records that a lookup holds at once.
AT_ONCE = 64


def _record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, captured_at: str) -> bytes:
    """One gzip member: a response with the payload or a revisit without."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: {_record_id(page_id) if page_id is not None else f'<urn:uuid:{uuid.uuid4()}>'}",
            f"WARC-Date: {captured_at}", f"WARC-Target-URI: {quote(url or '', safe=_KEEP)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    head += [f"X-Payload-Bytes: {len(payload)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse_record(member: bytes) -> tuple[dict, bytes]:
    """(headers, payload) of one gzip member."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def write_archives(pages: DataFrame, root: str, min_revisit_bytes: int = 0, roll_bytes: int = 1 << 30,
                   captured_at: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write every row of (page_id, url, html); the captures with their places."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    again = rows.where(F.octet_length("payload") >= min_revisit_bytes).groupBy("sha").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL").select("sha", "first")
    rows = rows.join(bounded(again, "warc-again"), "sha", "left").withColumn(
        "refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.col("first")))

    def write(batches):
        fs, base = _fs(root)
        fs.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                found = []
                for page_id, url, payload, sha, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "sha", "refers_to"))):
                    if out is None or at >= roll_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    digest = base64.b32encode(sha).decode()
                    member = record_bytes(page_id, url, payload, digest, refers, captured_at)
                    out.write(member)
                    found.append((page_id, surt(url), url, digest, len(payload), "response" if refers is None else "revisit", refers, name, at, len(member)))
                    at += len(member)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), _CAPTURE)], schema=_CAPTURE)
        finally:
            if out is not None:
                out.close()

    return materialise(rows.select("page_id", "url", "payload", "sha", "refers_to").mapInArrow(write, CAPTURE_SQL), "warc-captures")


def write_index(captures: DataFrame, root: str, block_lines: int = 1000) -> DataFrame:
    """Write the sorted capture lines in compressed blocks; the sparse
    directory (file, first, last, offset, length, lines), one row per block."""
    order = ["surt", "page_id", "file", "offset"]  # a hot url may spread over index files
    rows = captures.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(batches):
        fs, base = _fs(root)
        fs.create_dir(base, recursive=True)
        name, at, out, lines, keys = f"{uuid.uuid4().hex}.cdx.gz", 0, None, [], []

        def flush():
            nonlocal out, at, lines, keys
            if out is None:
                out = fs.open_output_stream(f"{base}/{name}", compression=None)
            member = zlib.compress(b"\n".join(lines), 4)
            out.write(member)
            row = {"file": name, "first": keys[0], "last": keys[-1], "offset": at, "length": len(member), "lines": len(lines)}
            at, lines, keys = at + len(member), [], []
            return pa.RecordBatch.from_pylist([row], pa.schema([("file", pa.string()), ("first", pa.string()), ("last", pa.string()),
                                                                ("offset", pa.int64()), ("length", pa.int64()), ("lines", pa.int64())]))

        try:
            for batch in batches:
                for r in batch.to_pylist():
                    keys.append(r.pop("surt"))
                    lines.append(f"{keys[-1]} {json.dumps(r)}".encode())
                    if len(lines) >= block_lines:
                        yield flush()
            if lines:
                yield flush()
        finally:
            if out is not None:
                out.close()

    return materialise(rows.mapInArrow(write, "file string, first string, last string, offset bigint, length bigint, lines bigint"), "warc-directory")


class _Reader:
    """Range reads from files of a folder, each opened once."""

    def __init__(self, root: str):
        self.fs, self.base = _fs(root)
        self.open: dict = {}

    def __call__(self, name: str, offset: int, length: int) -> bytes:
        if name not in self.open:
            if len(self.open) >= 64:
                self.open.pop(next(iter(self.open))).close()
            self.open[name] = self.fs.open_input_file(f"{self.base}/{name}")
        return self.open[name].read_at(length, offset)


def _block(read: _Reader, row: dict) -> list[tuple[str, dict]]:
    lines = zlib.decompress(read(row["file"], row["offset"], row["length"])).decode().split("\n")
    return [(k, json.loads(v)) for k, _, v in (line.partition(" ") for line in lines)]


def _records(read: _Reader, entries: list[dict], payloads: bool):
    """Rows of RECORD_SQL read from the archives; a response's payload must match its digest."""
    out = []
    for e in sorted(entries, key=lambda e: (e["file"], e["offset"])):
        headers, payload = parse_record(read(e["file"], e["offset"], e["length"]))
        digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
        if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"damaged record at {e['file']}:{e['offset']}")
        page, refers = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page")
        out.append((int(page) if page else None, headers["WARC-Target-URI"], digest, int(headers["X-Payload-Bytes"]), kind,
                    int(refers) if refers else None, payload if payloads and kind == "response" else None))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * 7, schema)], schema=schema)


def lookup(urls: DataFrame, directory: DataFrame, archives: str, index: str, payloads: bool = True) -> DataFrame:
    """Records of the captures of each distinct ``url``. The files' key ranges
    (one row per index file, so bounded by the partitions of the sort) tell a
    key's files, the directory of a file its blocks, both by binary search;
    then every block that holds a key is read and searched on its own, so the
    captures of a hot url are read by many tasks."""
    files = directory.groupBy("file").agg(F.min("first").alias("low"), F.max("last").alias("high"),
                                          F.sort_array(F.collect_list(F.struct("offset", "first", "last", "length"))).alias("blocks"))
    ranges = sorted(tuple(r) for r in files.select("low", "high", "file").collect())
    lows = [low for low, _, _ in ranges]

    def keys(batches):
        for batch in batches:
            found = []
            for key in map(surt, batch.column("url").to_pylist()):
                k = bisect.bisect_right(lows, key) - 1
                while k >= 0 and ranges[k][1] >= key:  # files share at most the keys at their edges
                    found.append((ranges[k][2], key))
                    k -= 1
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.string()) for i in (0, 1)], names=["f", "key"])

    asked = urls.select("url").mapInArrow(keys, "f string, key string").groupBy("f").agg(F.sort_array(F.collect_set("key")).alias("keys"))

    def search(batches):
        for batch in batches:
            for row in batch.to_pylist():
                lasts, found = [b["last"] for b in row["blocks"]], []
                for key in row["keys"]:
                    k = bisect.bisect_left(lasts, key)
                    while k < len(lasts) and row["blocks"][k]["first"] <= key:
                        found.append((row["file"], row["blocks"][k]["offset"], row["blocks"][k]["length"], key))
                        k += 1
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                                 names=["file", "offset", "length", "key"])

    def read(batches):
        blocks, records = _Reader(index), _Reader(archives)
        for batch in batches:
            for row in batch.to_pylist():
                lines, found = _block(blocks, row), []
                for key in row["keys"]:
                    at = bisect.bisect_left(lines, key, key=lambda x: x[0])
                    while at < len(lines) and lines[at][0] == key:
                        found.append(lines[at][1])
                        at += 1
                        if len(found) == AT_ONCE:
                            yield _records(records, found, payloads)
                            found = []
                if found:
                    yield _records(records, found, payloads)

    spark = urls.sparkSession
    places = files.join(asked, F.col("file") == F.col("f")).select("file", "blocks", "keys").mapInArrow(search, "file string, offset bigint, length bigint, key string")
    places = materialise(places.groupBy("file", "offset", "length").agg(F.sort_array(F.collect_set("key")).alias("keys")), "warc-places")
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return places.repartition(n).mapInArrow(read, RECORD_SQL)


def archive_round_trip(pages: DataFrame, min_revisit_bytes: int = 0, payloads: bool = False) -> DataFrame:
    """Write archives and index below the shared scratch folder, then look the
    captures of every page's url up in the index and read their records back."""
    root = _qualified(pages.sparkSession, new_scratch_dir(pages.sparkSession, "warc"))
    captures = write_archives(pages, f"{root}/archives", min_revisit_bytes)
    directory = write_index(captures, f"{root}/index")
    return lookup(pages.select("url").distinct(), directory, f"{root}/archives", f"{root}/index", payloads)
