"""WARC archives with a two-level capture index.

Archives are files of gzip members, one WARC record each.  Payloads of ``least`` bytes or more that are equal are
stored once: by the page with the largest id; the others are revisit records that refer to it.  The index has one line per
capture, sorted by URL key (the host's labels reversed), in compressed blocks; a sparse directory has each block's
first key and place.  A lookup searches the directory by bisection, reads one block (or the few that a key
spans) by range, and then the record by range.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .store import NewFile, new_dir, opened, written
from .text import pieces

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An archive file is closed once it has so many bytes.
ARCHIVE = 64 << 20
#: Captures in a block of the index.
BLOCK_LINES = 3000


def url_key(url: str | None) -> str:
    """Sort key of a URL: reversed host, port if unusual, path and query; the fragment goes.  Odd URLs keep their text behind ``)``."""
    url = (url or "").strip()
    try:
        parts = urlsplit(url)
        host, port = parts.hostname, parts.port
    except ValueError:
        host = None
    if not host:
        return ")" + url
    usual = {"http": 80, "https": 443}.get(parts.scheme.lower())
    return ",".join(reversed(host.lower().split("."))) + (f":{port}" if port not in (None, usual) else "") + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def digest_text(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One compressed record: a response with its payload, or (if it refers to another page) a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    # line breaks can't stand in a header
    target = (url or "about:blank").replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: {digest_text(hashlib.sha1(payload).digest())}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = http + (payload if refers_to is None else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join([*head, "", ""]).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n", 4, mtime=0)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-cased names) and payload of a compressed record."""
    plain = zlib.decompress(raw, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def page_of(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def decided(pages: DataFrame, *, key: str = "page_id", url: str = "url", page: str = "html", least: int = 1000, most_broadcast: int = 500_000) -> DataFrame:
    """(page_id, url, html, refers_to): for each page, the page whose equal payload it revisits, or null.

    Equal payloads are counted by their SHA-256 (pages can be made that share a SHA-1), combined before the shuffle.  Digests that occur once need no row, so what is
    joined back is small where there are few copies: it is broadcast up to ``most_broadcast`` rows, else joined by digest.
    """
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(page), F.lit("")).alias("html")).withColumn("digest", F.when(F.octet_length("html") >= least, F.sha2("html", 256)))
    winners = written(rows.filter(F.col("digest").isNotNull()).groupBy("digest").agg(F.max("page_id").alias("winner"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "winner"), "warc-copies")
    n = winners.count()
    if not n:
        return rows.select("page_id", "url", "html", F.lit(None).cast("long").alias("refers_to"))
    joined = rows.join(F.broadcast(winners) if n <= most_broadcast else winners, "digest", "left")
    # rows that repeat the winner's id are responses too
    return joined.select("page_id", "url", "html", F.when(F.coalesce(F.col("page_id"), F.col("winner") - 1) != F.col("winner"), F.col("winner")).alias("refers_to"))


CAPTURES = "key string, page_id long, uri string, offset long, length long, type string"


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Writes the records of ``decided`` rows, one or more archives a task; returns their captures (a written table)."""

    def run(batches):
        archive = None
        for batch in pieces(batches, "html", 4 << 20):
            found = []
            for page_id, url, page, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if archive is None:
                    archive = NewFile(folder, "pages.warc.gz")
                data = record(page_id, url, (page or "").encode("utf-8", "surrogatepass"), refers_to)
                found.append((url_key(url), page_id, archive.uri, archive.size, len(data), "response" if refers_to is None else "revisit"))
                archive.write(data)
                if archive.size >= ARCHIVE:
                    archive.close()
                    archive = None
            cols = list(zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["key", "page_id", "uri", "offset", "length", "type"])
        if archive is not None:
            archive.close()

    return written(rows.select("page_id", "url", "html", "refers_to").mapInArrow(run, CAPTURES), "warc-captures")


def write_index(captures: DataFrame, folder: str, *, parts: int | None = None, lines: int = BLOCK_LINES) -> DataFrame:
    """Sorts the captures into block files; returns the sparse directory (first key, last key, uri, offset, length, lines)."""
    parts = parts or int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = captures.repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id")

    def run(batches):
        out, block, rows = None, [], []

        def flush():
            data = gzip.compress("".join(f"{json.dumps(line)}\n" for line in block).encode(), 6, mtime=0)
            rows.append((block[0][0], block[-1][0], out.uri, out.size, len(data), len(block)))
            out.write(data)
            block.clear()

        for batch in batches:
            for line in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = NewFile(folder, "captures.idx.gz")
                block.append(line)
                if len(block) >= lines:
                    flush()
        if out is not None:
            if block:
                flush()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()))], names=["first", "last", "uri", "offset", "length", "lines"])

    return written(ordered.mapInArrow(run, "first string, last string, uri string, offset long, length long, lines long"), "warc-directory")


def read_block(uri: str, offset: int, length: int) -> Iterator[tuple]:
    with opened(uri) as f:
        for line in gzip.decompress(f.read_at(length, offset)).decode().splitlines():
            yield tuple(json.loads(line))


class CaptureIndex:
    """Lookups by URL: a bisection in the directory's rows, range reads of blocks and records."""

    def __init__(self, directory: list):
        self.rows = sorted((r["first"], r["last"], r["uri"], r["offset"], r["length"]) for r in directory)
        self.firsts = [r[0] for r in self.rows]

    def captures(self, url: str) -> list[tuple]:
        key, out = url_key(url), []
        i = max(0, bisect.bisect_left(self.firsts, key) - 1)
        while i < len(self.rows) and self.firsts[i] <= key:
            if self.rows[i][1] >= key:
                out += [c for c in read_block(*self.rows[i][2:]) if c[0] == key]
            i += 1
        return out

    def records(self, url: str) -> list[tuple[dict[str, str], bytes]]:
        out = []
        for _, _, uri, offset, length, _ in self.captures(url):
            with opened(uri) as f:
                out.append(parse(f.read_at(length, offset)))
        return out


def read_archives(directory: DataFrame) -> DataFrame:
    """Every capture of the index, read by range from its archive.

    A row per record: page_id, url, record_type, refers_to, payload (null for revisits), and the digest in its header (hex).
    """
    width = int(directory.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plan = directory.select("uri", "offset", "length").repartition(width, "uri", "offset")

    def blocks(batches):
        for batch in batches:
            for place in zip(*(c.to_pylist() for c in batch.columns)):
                cols = list(zip(*read_block(*place)))
                yield pa.RecordBatch.from_arrays([pa.array(cols[i], t) for i, t in ((2, pa.string()), (3, pa.int64()), (4, pa.int64()))], names=["uri", "offset", "length"])

    def records(batches):
        uri, f = None, None
        for batch in batches:
            rows, size = [], 0
            for name, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if name != uri:
                    if f:
                        f.close()
                    uri, f = name, opened(name)
                headers, payload = parse(f.read_at(length, offset))
                revisit = headers["warc-type"] == "revisit"
                rows.append((page_of(headers["warc-record-id"]), headers["warc-target-uri"], headers["warc-type"], page_of(headers.get("warc-refers-to")), None if revisit else payload, base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:")).hex()))
                size += len(payload)
                if size > 4 << 20:
                    yield _records(rows)
                    rows, size = [], 0
            if rows:
                yield _records(rows)

    # archives are bounded in size, so a file is a fair share; sorted, so that each is read from front to back
    places = plan.mapInArrow(blocks, "uri string, offset long, length long").repartition(width, "uri").sortWithinPartitions("uri", "offset")
    return places.mapInArrow(records, "page_id long, url string, record_type string, refers_to long, payload binary, header_digest string")


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["page_id", "url", "record_type", "refers_to", "payload", "header_digest"])


def archive(pages: DataFrame, *, folder: str | None = None, **columns) -> DataFrame:
    """Writes archives and index of the pages; returns the directory.  A null page is an empty payload, a null URL a blank one.

    Copies are judged within ``pages``; ties (the winner's id repeated) are all responses.  Files are complete or
    absent, and rows name only files that are complete, so repeated task attempts do no harm.
    """
    folder = folder or new_dir(pages.sparkSession, "warc")
    return write_index(write_archives(decided(pages, **columns), folder + "/archives"), folder + "/index")


def summary(directory: DataFrame) -> DataFrame:
    """Per record read back: page_id, payload_bytes, payload_digest, record_type, refers_to; a revisit's payload is that of what it refers to."""
    read = read_archives(directory).select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "record_type", "refers_to", "header_digest")
    read = written(read, "warc-read")
    responses = read.filter("record_type = 'response'")
    full = responses.groupBy(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("header_digest")).agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = read.filter("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "header_digest")
    return responses.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").unionByName(
        revisits.join(full, ["refers_to", "header_digest"], "left").select("page_id", "payload_bytes", F.col("header_digest").alias("payload_digest"), "record_type", "refers_to")
    )
