"""WARC archives with a two-level capture index.

Records are written by tasks into archives of the shared folder, one gzip member each. Their captures
(reversed-host key, archive, offset, length) are range-sorted and kept in compressed blocks; a sparse
directory holds every block's first key, in pages. A lookup bisects the pages, then a page of the
directory, then the block, and reads its range of the archive.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mereflow import scratch
from mereflow.llm.common import arrow_rows, ascii_lower, join_hot

#: WARC asks for a date; the pages have none.
DATE = "1970-01-01T00:00:00Z"
BLOCK_LINES = 1000
#: Blocks to a page of the directory: every task holds the first key of each page, one for a million captures.
PAGE_BLOCKS = 1000
_PLAIN = "".join(chr(c) for c in range(33, 127) if chr(c) != "%")
_LINE = "\t"


@dataclass
class Capture:
    index: DataFrame  # page (the first key of its first block), first, data
    entries: int


def _disk(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, whose scheme may be one that only Hadoop knows by that name."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", folder))


def sort_key(url: Column, page: Column) -> Column:
    """Host with its labels reversed, then what follows it, then the page's id: ``com,example,www)/a?b 17``."""
    rest = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    tail = F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)$", 1), r"[\x00-\x20]", "_")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), tail, F.lit(" "), F.coalesce(page.cast("string"), F.lit("null")))


def _record(page, url, html: bytes, first) -> bytes:
    digest = base64.b32encode(hashlib.sha1(html).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    body = http if first is not None else http + html
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{'null' if page is None else page}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + urllib.parse.quote(url, safe=_PLAIN, errors="surrogatepass"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if first is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{first}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + pack.flush()


def write(pages: DataFrame, folder: str, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record per row under ``folder`` and return its captures (key, archive, at, size).

    Of rows with equal payloads of at least ``least`` bytes that of smallest id is the response, the
    others revisit it. A null payload is empty; rows that repeat the smallest id are responses all;
    rows without an id revisit, or are responses where no row of that payload has one. An archive of a
    task that failed is left behind unread.
    """
    spark = pages.sparkSession
    arrow_rows(spark)
    own = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("html"))
    own = own.withColumn("sha", F.unhex(F.sha1("html")))
    small = own.select("page", "sha", F.length("html").alias("n")).where(F.col("n") >= least)
    first = small.groupBy("sha").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1 and first is not null")
    again = join_hot(small, scratch.save(first, "payloads"), "sha", "rows").where(~F.col("page").eqNullSafe(F.col("first"))).select(F.col("page").alias("page_"), F.col("sha").alias("sha_"), "first").distinct()
    told = own.join(again, F.col("page").eqNullSafe(F.col("page_")) & (F.col("sha") == F.col("sha_")), "left").select("page", "url", "html", "first", sort_key(F.col("url"), F.col("page")).alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, top = _disk(folder)
        out, name, at = None, f"{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            if out is None:
                disk.create_dir(top, recursive=True)
                out = disk.open_output_stream(f"{top}/{name}", compression=None)
            places = []
            for page, url, html, first_ in zip(*(batch.column(k).to_pylist() for k in ("page", "url", "html", "first"))):
                record = _record(page, url, html, first_)
                out.write(record)
                places.append((at, len(record)))
                at += len(record)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([name] * len(places)), pa.array([p[0] for p in places], pa.int64()), pa.array([p[1] for p in places], pa.int64())], names=["key", "archive", "at", "size"])
        if out is not None:
            out.close()

    return scratch.save(told.mapInArrow(run, "key string, archive string, at long, size long"), "captures")


def build_index(captures: DataFrame, lines: int = BLOCK_LINES, page: int = PAGE_BLOCKS) -> Capture:
    """Captures in key order, ``lines`` to a compressed block and ``page`` blocks to a page; equal keys may go on in the next block."""
    spark = captures.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        name, blocks = None, 0

        def close(rows):
            nonlocal name, blocks
            if blocks % page == 0:
                name = rows[0][0]
            blocks += 1
            data = zlib.compress("\n".join(_LINE.join(map(str, r)) for r in rows).encode("utf-8", "surrogatepass"))
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([rows[0][0]]), pa.array([data], pa.binary())], names=["page", "first", "data"])

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("key", "archive", "at", "size"))):
                if len(held) >= lines:
                    yield close(held)
                    held = []
                held.append(row)
        if held:
            yield close(held)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    order = ("key", "archive", "at")  # the places part equal keys
    ordered = captures.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return Capture(scratch.save(ordered.mapInArrow(run, "page string, first string, data binary"), "capture-index"), captures.count())


def _lines(data: bytes) -> list[list[str]]:
    return [x.split(_LINE) for x in zlib.decompress(data).decode("utf-8", "surrogatepass").split("\n")]


def _bytes(x: str) -> bytes:
    return x.encode("utf-8", "surrogatepass")


def _may_hold(firsts: list[bytes], key: bytes) -> set[bytes]:
    """Of the sorted first keys those of the parts that may hold a key: all that begin with it, and the one before."""
    return set(firsts[max(0, bisect.bisect_left(firsts, key) - 1) : bisect.bisect_right(firsts, key)])


def look_up(capture: Capture, keys: DataFrame) -> DataFrame:
    """(archive, at, size) of every capture whose key is among ``keys`` (column key)."""
    spark = keys.sparkSession
    asked = keys.select("key").where("key is not null").distinct()
    directory = capture.index.groupBy("page").agg(F.sort_array(F.collect_set("first")).alias("firsts"))
    pages = spark.sparkContext.broadcast(sorted(_bytes(r["page"]) for r in directory.select("page").collect()))  # one for a million captures

    def to_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, p.decode("utf-8", "surrogatepass")) for k in batch.column("key").to_pylist() for p in _may_hold(pages.value, _bytes(k))]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string())], names=["key", "page"])

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys_, firsts in zip(batch.column("keys").to_pylist(), batch.column("firsts").to_pylist()):
                own = [_bytes(f) for f in firsts]
                found = [(k, f.decode("utf-8", "surrogatepass")) for k in keys_ for f in _may_hold(own, _bytes(k))]
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string())], names=["key", "first"])

    # keys go to a page in lots, so that a page is unpacked once for many and no task gets all keys of a page
    lots = asked.mapInArrow(to_pages, "key string, page string").groupBy("page", F.pmod(F.xxhash64("key"), F.lit(64)).alias("lot")).agg(F.collect_list("key").alias("keys"))
    routed = lots.join(directory, "page").select("keys", "firsts").mapInArrow(to_blocks, "key string, first string")
    wanted = routed.groupBy("first").agg(F.collect_set("key").alias("keys"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, keys_ in zip(batch.column("data").to_pylist(), batch.column("keys").to_pylist()):
                rows = _lines(data)
                own = [_bytes(r[0]) for r in rows]
                got = [r for k in map(_bytes, keys_) for r in rows[bisect.bisect_left(own, k) : bisect.bisect_right(own, k)]]
                yield pa.RecordBatch.from_arrays([pa.array([r[1] for r in got], pa.string()), pa.array([int(r[2]) for r in got], pa.int64()), pa.array([int(r[3]) for r in got], pa.int64())], names=["archive", "at", "size"])

    return capture.index.join(wanted, "first").select("data", "keys").mapInArrow(find, "archive string, at long, size long")


def _parse(member: bytes) -> tuple:
    raw = zlib.decompress(member, 31)
    head, _, body = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    body = body[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError("a record does not hold the payload that it names")
    number = lambda k: None if k not in fields or "null" in fields[k] else int(fields[k].removeprefix("<urn:page:").removesuffix(">"))
    url = urllib.parse.unquote(fields["WARC-Target-URI"], errors="surrogatepass") if "WARC-Target-URI" in fields else None
    return number("WARC-Record-ID"), url, kind, size, digest, number("WARC-Refers-To"), payload if kind == "response" else None


def read(places: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload) of records by range reads.

    The payload of a response is checked against its digest; a revisit has none. ``payload`` false leaves it out.
    """
    spark = places.sparkSession
    arrow_rows(spark)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, top = _disk(folder)
        name, source = None, None
        for batch in batches:
            out = []
            for archive, at, size in zip(*(batch.column(k).to_pylist() for k in ("archive", "at", "size"))):
                if archive != name:
                    if source is not None:
                        source.close()
                    name, source = archive, disk.open_input_file(f"{top}/{archive}")
                out.append(_parse(source.read_at(size, at)))
            columns = list(zip(*out)) or [[]] * 7
            if not payload:
                columns[6] = [None] * len(out)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        if source is not None:
            source.close()

    slab = F.floor(F.col("at") / (4 << 20))  # a large archive is read by many tasks
    ordered = places.repartition("archive", slab).sortWithinPartitions("archive", "at")
    return ordered.mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write every page, index the captures, look all of them up and read them back, without the payloads.

    Without a ``folder`` the archives lie in the shared one and go with the driver's process.
    """
    given, folder = folder, folder or scratch.new_path(pages.sparkSession, "warc")
    captures = write(pages, folder)
    capture = build_index(captures)
    if not given:
        scratch.at_exit(pages.sparkSession, folder)
    keys = pages.select(sort_key(F.col("url"), F.col("page_id").cast("long")).alias("key"))
    return read(look_up(capture, keys), folder, payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The same rows in DuckDB SQL, for pages whose ids are not null and differ. Base 32 takes twenty bits of the digest at a time.
ORACLE = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages),
f as (select html, min(page_id) as least from p group by 1),
d as (select page_id, html, least, list_transform(range(0, 8), lambda k: cast('0x' || substr(hex, cast(5 * k + 1 as bigint), 5) as integer)) as v from p join f using (html))
select page_id, cast(strlen(html) as bigint) as payload_bytes,
  array_to_string(list_transform(v, lambda x: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> s) & 31) + 1, 1)), '')), '') as payload_digest,
  case when page_id = least then 'response' else 'revisit' end as record_type, case when page_id <> least then least end as refers_to
from d
"""
