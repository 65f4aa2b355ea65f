"""Legacy archive converter: ARC files in, equivalent WARC records out.

``write_arc`` puts pages into ARC files (gzip, a bounded number of bytes each), half of them with
version 1 headers and half with version 2. ``read_arc`` parses a file by its version block: the
record line's fields follow the version, and every record's declared length says where it ends, so
nothing in a payload can be taken for a header. ``convert`` synthesises what WARC adds: record
identifiers (UUIDs made from page and digest, so a rerun gives the same), ISO timestamps from
14- or 12-digit dates, record types (response, or revisit when a payload of at least 1000 bytes is
held by the record of the largest page_id), and SHA-1 digests of payload and block.
``read_warc`` reads the records back by their declared lengths.

Payloads are never shuffled: the revisit decision needs digests and page ids alone. Files are written and
read by Spark (the text writer, one archive per row, and the binary file reader).

Defined results: a NULL html is an empty payload; a NULL url is ``unknown:``; white space in urls is
percent-encoded; a page without page_id is a record without that header, which revisits the largest page_id of
its payload or, if none has one, is a response; repeated page_ids are records each, and of
equal payloads all records of the largest page_id are responses; an empty table gives no files and no rows;
other columns are not read, so their names cannot clash; a page larger than ``FILE_BYTES`` is a file of its own.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut_lineage, ship, shared_path

#: Payload bytes in one archive file, unless one record has more.
FILE_BYTES = 6 << 20
MIN_REVISIT = 1000
#: Memory of a map of revisits that is broadcast, and of one of its entries at most; a larger map is joined.
MAP_BYTES = 64 << 20
ENTRY_BYTES = 320
_SPACE = re.compile(rb"[\x00-\x20\x7f]")
#: The version blocks' field lines.
_V1 = "URL IP-address Archive-date Content-type Archive-length"
_V2 = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"


def _http(page_id: int | None, payload: bytes) -> bytes:
    page = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
            f"{page}\r\n").encode()


def _page_of(http: bytes) -> int | None:
    found = re.search(rb"\r\nX-Page-Id: (-?\d+)", http)
    return None if found is None else int(found[1])


def _when(page_id: int | None) -> str:
    """A crawl date for a page (the pages table has none): seconds after the start of 2001 by page_id."""
    days, second = divmod((page_id or 0) % (86_400 * 364), 86_400)
    month, day = divmod(days, 28)
    return f"2001{month % 12 + 1:02d}{day + 1:02d}{second // 3600:02d}{second // 60 % 60:02d}{second % 60:02d}"


def _url(text: str | None) -> str:
    raw = (text or "unknown:").encode()
    return _SPACE.sub(lambda m: b"%%%02X" % m[0][0], raw).decode()


def arc_file(version: int, name: str, records: list[tuple[int, str, bytes]]) -> bytes:
    """One ARC file; it lacks its last line break, which the text writer adds."""
    fields = _V1 if version == 1 else _V2
    block = f"{version} 0 Crawl\n{fields}\n".encode()
    tail = f"{len(block)}" if version == 1 else f"200 - - 0 {name} {len(block)}"
    out = [f"filedesc://{name} 0.0.0.0 20010101000000 text/plain {tail}\n".encode(), block, b"\n"]
    at = sum(map(len, out))
    for page_id, url, payload in records:
        doc = _http(page_id, payload) + payload
        date = _when(page_id) if (page_id or 0) % 2 else _when(page_id)[:12]
        if version == 1:
            head = f"{_url(url)} 0.0.0.0 {date} text/html {len(doc)}\n".encode()
        else:
            head = f"{_url(url)} 0.0.0.0 {date} text/html 200 {zlib.crc32(doc):08x} - {at} {name} {len(doc)}\n".encode()
        out += [head, doc, b"\n"]
        at += len(head) + len(doc) + 1
    return b"".join(out)[:-1]


def arc_records(raw: bytes):
    """(version, url, ip, date, http head, payload, page_id) of every record of an ARC file."""
    def line(at):
        end = raw.index(b"\n", at)
        return raw[at:end].split(b" "), end + 1
    head, at = line(0)
    size = int(head[-1])
    version = int(raw[at:at + size].split(b" ", 1)[0])
    names = raw[at:at + size].split(b"\n")[1].decode().split(" ")
    at += size + 1
    while at < len(raw):
        values, at = line(at)
        if values == [b""]:
            continue
        record = dict(zip(names, values, strict=True))
        size = int(record["Archive-length"])
        doc = raw[at:at + size]
        if len(doc) != size:
            raise ValueError("ARC record ends before its declared length")
        at += size + 1
        head, _, payload = doc.partition(b"\r\n\r\n")
        page = _page_of(head)
        yield (version, record["URL"].decode(), record["IP-address"].decode(), record["Archive-date"].decode(),
               head + b"\r\n\r\n", payload, page)


def iso_date(date: str) -> str:
    """ISO 8601 of a 14-digit date; 12 digits (no seconds) and shorter ones are filled up."""
    d = date + "00000101000000"[len(date):]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _b32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record_id(page_id: int, digest: bytes) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest.hex()}')}>"


def warc_record(url: str, ip: str, date: str, http: bytes, payload: bytes, page: int, source: int | None) -> bytes:
    """One WARC record, without the last of its two closing line breaks."""
    digest = hashlib.sha1(payload).digest()
    block = http + payload if source is None else http
    lines = ["WARC/1.0", f"WARC-Type: {'response' if source is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(page, digest)}", f"WARC-Date: {iso_date(date)}",
             f"WARC-Target-URI: {url}", f"WARC-IP-Address: {ip}", f"WARC-Payload-Digest: {_b32(digest)}",
             f"WARC-Block-Digest: {_b32(hashlib.sha1(block).digest())}"]
    if source is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {record_id(source, digest)}", f"X-Refers-To-Page-Id: {source}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n"


def warc_records(raw: bytes):
    """(headers, block) of every record of a WARC file, by declared lengths."""
    at = 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        first, *lines = raw[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(x.split(": ", 1) for x in lines)
        size = int(headers["Content-Length"])
        at = end + 4 + size
        if raw[at:at + 4] != b"\r\n\r\n":
            raise ValueError("WARC record does not end at its declared length")
        yield headers, raw[end + 4:at]
        at += 4


def _save(rows: DataFrame, path: str, line_end: str) -> None:
    """One gzip file per row of the only column."""
    (rows.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("lineSep", line_end)
     .option("maxRecordsPerFile", 1).text(path))


def _load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*.gz").load(path).select("content")


def _files(batches):
    """Unpacked archives of a task; a partition without records leaves an empty file."""
    for batch in batches:
        for content in batch.column(0):
            raw = zlib.decompress(content.as_py(), 31)
            if raw:
                yield raw


def write_arc(pages: DataFrame, path: str) -> None:
    """Pages (page_id, url, html) as ARC files below ``path``."""
    ship(pages.sparkSession)

    def run(batches):
        from pyspark import TaskContext
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            value = arc_file(1 + (part + seq) % 2, f"crawl-{part:05d}-{seq:05d}.arc", held)
            return pa.RecordBatch.from_arrays([pa.array([value.decode()])], names=["value"])
        for batch in batches:
            for page, url, html in zip(*(batch.column(c) for c in range(3)), strict=True):
                payload = (html.as_py() or "").encode()
                if held and size + len(payload) > FILE_BYTES:
                    yield flush()
                    seq, held, size = seq + 1, [], 0
                held.append((page.as_py(), url.as_py(), payload))
                size += len(payload)
        if held:
            yield flush()

    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    _save(rows.mapInArrow(run, "value string"), path, "\n")


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """``arc_version, url, date, page_id, n, digest`` (SHA-1) of every record of the ARC files below ``path``."""
    ship(spark)

    def run(batches):
        for raw in _files(batches):
            found = [(v, u, d, page, len(p), hashlib.sha1(p).hexdigest())
                     for v, u, _, d, _, p, page in arc_records(raw)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

    names = ["arc_version", "url", "date", "page_id", "n", "digest"]
    kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return _load(spark, path).mapInArrow(run, "arc_version int, url string, date string, page_id long, n long, "
                                              "digest string")


def convert(spark: SparkSession, arc: str, warc: str) -> None:
    """Convert the ARC files below ``arc`` to WARC files below ``warc``, one for each."""
    index = cut_lineage(read_arc(spark, arc).where(F.col("n") >= MIN_REVISIT).select("page_id", "n", "digest"))
    best = index.groupBy("digest", "n").agg(F.max("page_id").alias("source"), F.count("*").alias("c")).where(
        "c > 1 and source is not null")
    revisits = cut_lineage(index.join(best, ["digest", "n"]).where("page_id is null or page_id < source")
                           .select("page_id", "digest", "source").distinct())
    if revisits.count() * ENTRY_BYTES <= MAP_BYTES:
        # the map is small: every task gets it, and payloads stay where they are
        known = spark.sparkContext.broadcast({(r.page_id, bytes(r.d)): r.source for r in revisits.select(
            "page_id", F.unhex("digest").alias("d"), "source").toLocalIterator()})

        def run(batches):
            for raw in _files(batches):
                out = [warc_record(u, ip, d, http, p, page,
                                   known.value.get((page, hashlib.sha1(p).digest())))
                       for _, u, ip, d, http, p, page in arc_records(raw)]
                yield pa.RecordBatch.from_arrays([pa.array([b"\r\n".join(out).decode()])], names=["value"])
        rows = _load(spark, arc).mapInArrow(run, "value string")
    else:
        # otherwise records meet their decision by page_id, and each is an archive row of its own
        def split(batches):
            for raw in _files(batches):
                found = [(page, hashlib.sha1(p).hexdigest(), u, ip, d, http, p)
                         for _, u, ip, d, http, p, page in arc_records(raw)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found, strict=True)], names=names)
        names = ["page_id", "digest", "url", "ip", "date", "http", "payload"]
        records = _load(spark, arc).mapInArrow(split, "page_id long, digest string, url string, ip string, "
                                                      "date string, http binary, payload binary")

        def join(batches):
            held, size = [], 0
            for batch in batches:
                for r in batch.to_pylist():
                    held.append(warc_record(r["url"], r["ip"], r["date"], r["http"], r["payload"], r["page_id"],
                                            r["source"]))
                    size += len(held[-1])
                    if size > FILE_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array([b"\r\n".join(held).decode()])], names=["value"])
                        held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array([b"\r\n".join(held).decode()])], names=["value"])
        known = revisits.select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "source")
        rows = records.join(known, records["page_id"].eqNullSafe(known["p"]) & (records["digest"] == known["d"]), "left").drop(
            "p", "d").mapInArrow(join, "value string")
    _save(rows, warc, "\r\n")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, warc_date, target_uri``."""
    ship(spark)

    def run(batches):
        for raw in _files(batches):
            found = []
            for h, block in warc_records(raw):
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:"))
                size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
                if h["WARC-Type"] == "response" and (len(payload) != size
                                                     or hashlib.sha1(payload).digest() != digest):
                    raise ValueError("payload does not match its digest")
                source = h.get("X-Refers-To-Page-Id")
                found.append((_page_of(http), size, digest.hex(),
                              h["WARC-Type"], None if source is None else int(source), h["WARC-Record-ID"],
                              h["WARC-Date"], h["WARC-Target-URI"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=names)

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "warc_date",
             "target_uri"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return _load(spark, path).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, "
                                              "record_type string, refers_to long, record_id string, "
                                              "warc_date string, target_uri string")


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages to ARC, ARC to WARC, and the WARC records read back."""
    spark = pages.sparkSession
    arc, warc = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc)
    return read_warc(spark, warc)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS d FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS best FROM q)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 1000 AND (best > page_id OR page_id IS NULL AND best IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND (best > page_id OR page_id IS NULL) THEN best END AS refers_to
FROM r
"""
