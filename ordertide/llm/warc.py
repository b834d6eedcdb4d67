"""WARC archives with a two-level capture index.

Writing: each page becomes a gzip member of an archive file in the shared folder;
of pages with the same payload (of at least ``MIN_REVISIT`` bytes) the one with the
smallest id is a response record and the others are revisit records.

Index: captures, sorted by reversed-host URL key, are packed into compressed
blocks; a sparse directory keeps the first key and place of each block.  A lookup
binary-searches the parts and the directory of a part, range-reads the blocks
that may hold its key, and the captures found are range-read from the archives.

Files are written under names of their own by each task attempt; only names that a
finished task reported are used, so lost executors leave at most unused files.
The shared folder must be one that pyarrow's file systems can open.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.common import map_arrow, text_bytes, work_dir, written

MIN_REVISIT = 100
ARCHIVE_BYTES = 256 << 20
BLOCK_CAPTURES = 2_000
LEVEL = 3
DATE = "2000-01-01T00:00:00Z"      # pages carry no capture time
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ENTRY = "key string, file string, offset long, length long"


def open_store(folder: str):
    """(pyarrow file system, path) of a folder URI."""
    from pyarrow.fs import FileSystem
    if folder.startswith("file:/") and not folder.startswith("file:///"):
        folder = "file://" + folder[5:]
    return FileSystem.from_uri(folder)


def url_key(url: str | None) -> str:
    """Sort key: host labels reversed, then port, path and query; hosts in lower case.
    A URL that can't be parsed is its own key; null has the empty key."""
    if not url:
        return ""
    try:
        u = urlsplit(url.strip())
        host, port = u.hostname, u.port
    except ValueError:
        return url
    if not host:
        return url
    tail = (u.path or "/") + (f"?{u.query}" if u.query else "")
    at = f":{port}" if port and (u.scheme, port) not in (("http", 80), ("https", 443)) else ""
    return ",".join(reversed(host.split("."))) + at + ")" + tail


# ---- records -----------------------------------------------------------------------

def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{digest}')}>"


def make_record(page: int | None, url: str | None, digest: str, payload: bytes, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    fields = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": _record_id(page, digest),
              "WARC-Date": DATE, "WARC-Payload-Digest": f"sha256:{digest}", "Content-Type": "application/http;msgtype=response"}
    if url is not None:
        fields["WARC-Target-URI"] = quote(url, safe="%/:?#[]@!$&'()*+,;=~")
    if refers_to is not None:
        fields |= {"WARC-Profile": _PROFILE, "WARC-Refers-To": _record_id(refers_to, digest), "X-Refers-To-Page": str(refers_to)}
    if page is not None:
        fields["X-Page"] = str(page)
    fields["Content-Length"] = str(len(block))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Header fields (lower-case names), ``http`` fields and ``payload`` of a record."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
    block = rest[:int(fields["content-length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    fields["http"] = {k.lower(): v for k, v in (x.split(": ", 1) for x in http.decode().split("\r\n")[1:])}
    return fields | {"payload": payload}


def _gzip(data: bytes, level: int = LEVEL) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


# ---- writing -------------------------------------------------------------------------

def _with_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    src = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"),
                       text_bytes(F.col(html_col)).alias("payload")).withColumn("digest", F.sha2("payload", 256))
    row = F.xxhash64("page", "url", "digest").alias("row")
    big = src.where((F.length("payload") >= MIN_REVISIT) & F.col("page").isNotNull()).select(row, "page", "digest")
    first = big.groupBy("digest").agg(F.min("page").alias("first"), F.max("page").alias("last")).where("first < last").drop("last")
    again = big.join(first, "digest").where("page <> first").select(
        F.col("row").alias("r"), F.col("page").alias("p"), F.col("digest").alias("d"), "first").distinct()
    return src.withColumn("row", row).join(
        again, (F.col("row") == F.col("r")) & (F.col("page") == F.col("p")) & (F.col("digest") == F.col("d")), "left").select(
        "page", "url", "digest", "payload", F.col("first").alias("refers_to"))


@dataclass
class Archive:
    """Archive files below ``folder`` and their capture index."""

    folder: str
    captures: DataFrame        # key, file, offset, length of each record
    parts: list[tuple]         # (first key, last key, block file, directory file), sorted; one per index partition


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> Archive:
    """Write all pages and build the capture index.

    A null html is an empty payload.  Pages with a null id are responses and are
    referred to by none; repeated rows are records of their own (rows of the first
    page's id all stay responses); a null URL has no target field and the empty key.
    An empty table gives an archive without captures."""
    folder = work_dir(pages.sparkSession, "warc")

    def write(batches):
        fs, root = open_store(folder)
        out, name, at, rows = None, "", 0, []

        def report():
            rows_now = rows[:]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows_now), (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                              names=["key", "file", "offset", "length"])

        for b in batches:
            for page, url, digest, payload, refers in zip(*(b.column(i).to_pylist() for i in range(5))):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    head = _gzip(f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {DATE}\r\nContent-Length: 0\r\n\r\n\r\n\r\n".encode())
                    out.write(head)
                    at = len(head)
                data = _gzip(make_record(page, url, digest, payload, refers))
                out.write(data)
                rows.append((url_key(url), name, at, len(data)))
                at += len(data)
                if at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
            if rows and out is None:
                yield report()
        if out is not None:
            out.close()
        if rows:
            yield report()

    captures = written(map_arrow(_with_revisits(pages, id_col, url_col, html_col), write, _ENTRY), "warc-captures")
    return Archive(folder, captures, _build_index(folder, captures))


def _build_index(folder: str, captures: DataFrame) -> list[tuple]:
    def pack(batches):
        fs, root = open_store(folder)
        name, out, at, directory, held, last = "", None, 0, [], [], None

        def block():
            nonlocal at
            data = zlib.compress("\n".join(map(json.dumps, held)).encode(), 6)
            out.write(data)
            directory.append((held[0][0], at, len(data)))
            at += len(data)
            held.clear()

        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(4))):
                if out is None:
                    name = f"index-{uuid.uuid4().hex}"
                    out = fs.open_output_stream(f"{root}/{name}.blocks", compression=None)
                held.append(row)
                last = row[0]
                if len(held) >= BLOCK_CAPTURES:
                    block()
        if out is None:
            return
        if held:
            block()
        out.close()
        with fs.open_output_stream(f"{root}/{name}.directory", compression=None) as f:
            f.write("\n".join(map(json.dumps, directory)).encode())
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (directory[0][0], last, name)], names=["first", "last", "name"])

    ranged = captures.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    parts = written(map_arrow(ranged, pack, "first string, last string, name string"), "warc-index")
    return sorted(tuple(r) for r in parts.collect())          # one row per index partition


# ---- reading -------------------------------------------------------------------------

class _Part:
    """Directory of one index part: first keys and places of its blocks."""

    def __init__(self, fs, root: str, name: str):
        with fs.open_input_stream(f"{root}/{name}.directory", compression=None) as f:
            rows = [json.loads(x) for x in f.read().decode().split("\n")]
        self.first, self.place = [r[0] for r in rows], [(r[1], r[2]) for r in rows]

    def blocks(self, key: str) -> list[tuple[int, int]]:
        """Places of the blocks that may hold the key."""
        lo = max(0, bisect_left(self.first, key) - 1)
        return self.place[lo:max(lo + 1, bisect_right(self.first, key))]


def find_captures(archive: Archive, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """(key, file, offset, length): all captures of the URLs (each distinct key once).

    Keys become the places of blocks; each block is then read once, whoever asks for
    it, so a URL with very many captures is spread over its blocks."""
    folder, parts = archive.folder, archive.parts
    firsts, lasts = [p[0] for p in parts], [p[1] for p in parts]

    def place(batches):
        fs, root = open_store(folder)
        cache: dict[str, _Part] = {}
        for b in batches:
            rows = []
            for key in dict.fromkeys(url_key(u) for u in b.column(0).to_pylist()):
                for i in range(bisect_left(lasts, key), bisect_right(firsts, key)):
                    name = parts[i][2]
                    if name not in cache:
                        if len(cache) >= 64:
                            cache.clear()
                        cache[name] = _Part(fs, root, name)
                    rows += [(name, *at, key) for at in cache[name].blocks(key)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["name", "at", "size", "key"])

    def read(batches):
        fs, root = open_store(folder)
        for b in batches:
            for name, at, size, keys in zip(*(b.column(i).to_pylist() for i in range(4))):
                with fs.open_input_file(f"{root}/{name}.blocks") as f:
                    raw = f.read_at(size, at)
                wanted = set(keys)
                rows = [r for r in map(json.loads, zlib.decompress(raw).decode().split("\n")) if r[0] in wanted]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                                     names=["key", "file", "offset", "length"])

    asked = map_arrow(urls.select(F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("u")).distinct(), place,
                      "name string, at long, size long, key string")
    blocks = asked.groupBy("name", "at", "size").agg(F.collect_set("key").alias("keys"))  # at most the keys around one block
    return map_arrow(blocks, read, _ENTRY)


def read_captures(archive: Archive, captures: DataFrame) -> DataFrame:
    """(page, url, record_type, payload_bytes, payload_digest, refers_to, payload) of each
    capture, range-read in order of place.  The payload of a response is checked
    against its digest; a revisit's payload is null, its size and digest those of the
    full payload."""
    folder = archive.folder

    def read(batches):
        fs, root = open_store(folder)
        name, f = None, None
        for b in batches:
            for s in range(0, b.num_rows, 500):
                rows = []
                for file, offset, length in zip(*(b.column(i).slice(s, 500).to_pylist() for i in range(3))):
                    if file != name:
                        name, f = file, fs.open_input_file(f"{root}/{file}")
                    r = parse_record(zlib.decompress(f.read_at(length, offset), 31))
                    digest = r["warc-payload-digest"].split(":", 1)[1]
                    response = r["warc-type"] == "response"
                    if response and hashlib.sha256(r["payload"]).hexdigest() != digest:
                        raise ValueError(f"damaged record in {file} at {offset}")
                    number = lambda k: int(r[k]) if k in r else None  # noqa: E731, B023
                    rows.append((number("x-page"), r.get("warc-target-uri"), r["warc-type"], int(r["http"]["content-length"]), digest,
                                 number("x-refers-to-page"), r["payload"] if response else None))
                kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["page", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"])

    placed = captures.select("file", "offset", "length").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return map_arrow(placed, read, "page long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def lookup(archive: Archive, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """The records captured under the URLs, see ``read_captures``."""
    return read_captures(archive, find_captures(archive, urls, url_col))


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive the pages and read every one back through the index by its URL:
    (page_id, payload_bytes, payload_digest, record_type, refers_to), one row per page."""
    back = lookup(write_archive(pages), pages)
    return back.select(F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
