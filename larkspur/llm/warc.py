"""WARC archives: one gzip member per record, equal payloads written once, and a reader that splits files at any byte."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.llm.common import saved
from larkspur.operators.joins import sliced_join
from larkspur.session import work_path

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LAST = (1 << 63) - 1  # stands for a missing page_id, which comes last

FILES = "file string, size long, records long"
RECORDS = (
    "file string, start long, stop long, since long, offset long, next long, record_type string, record_id string, "
    "page_id long, url string, refers_to_record string, payload_digest string, payload_bytes long, payload binary"
)


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI that every executor reaches, and the path on it."""
    uri = re.sub("^file:/+", "/", uri)
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _field(value: str) -> str:
    """A header value on one line: control characters as percent escapes."""
    return re.sub("[\x00-\x1f\x7f]", lambda c: f"%{ord(c[0]):02X}", value)


def _record(kind: str, fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *fields, ("Content-Length", len(block))]
    lines = "".join(f"{k}: {_field(str(v))}\r\n" for k, v in head if v is not None)
    out = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join((out.compress(f"WARC/1.1\r\n{lines}\r\n".encode()), out.compress(block), out.compress(b"\r\n\r\n"), out.flush()))


def _write(folder: str, date: str, most: int):
    """Records into files of about ``most`` bytes. A file's name holds the attempt of its task and only
    files of a task that ended are listed, so a task that is lost or runs twice leaves nothing behind in the list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, root = opened(folder)
        disk.create_dir(root, recursive=True)
        task = TaskContext.get()
        out, size, n, files = None, 0, 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "size": [size], "records": [n]})

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{files:03d}.warc.gz"
                    out, size, n, files = disk.open_output_stream(f"{root}/{name}", compression=None), 0, 0, files + 1
                    info = _record("warcinfo", [("WARC-Filename", name), ("WARC-Date", date)], b"format: WARC File Format 1.1\r\n")
                    size += out.write(info)
                response = row["refers_to_record"] is None
                body = (row["html"] or "").encode() if response else b""
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['n_bytes']}\r\n\r\n"
                fields = [
                    ("WARC-Record-ID", f"<urn:uuid:{row['record_id']}>"),
                    ("WARC-Date", date),
                    ("WARC-Target-URI", row["url"]),
                    ("WARC-Page-ID", row["page_id"]),
                    ("WARC-Payload-Digest", f"sha1:{base32(row['digest'])}"),
                    ("WARC-Profile", None if response else PROFILE),
                    ("WARC-Refers-To", None if response else f"<urn:uuid:{row['refers_to_record']}>"),
                    ("Content-Type", "application/http;msgtype=response"),
                ]
                size += out.write(_record("response" if response else "revisit", fields, http.encode() + body))
                n += 1
                if size >= most:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return run


def _uuid(*parts: Column) -> Column:
    """A name for a record, the same whenever it is computed again."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """The records of ``pages`` (page_id, url, html): ``record_id``, ``refers_to_record``, ``html`` and headers.

    Of equal payloads of at least ``least`` bytes the row with the smallest page_id (a missing one
    last, then the smallest url) is a response; all others refer to it and carry no html. The
    payload moves once, after rows of one payload have been reduced to one in their own
    partition; rows that refer to a payload of a very large group are dealt over slices.
    """
    rows = pages.select(
        F.coalesce(F.col("page_id").cast("long"), F.lit(LAST)).alias("key"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    rows = rows.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "n_bytes": F.octet_length("html").cast("long")})
    named = ["digest", "n_bytes", "key", "url"]
    slim = saved(rows.groupBy(*named).agg(F.count("*").alias("copies")), "pages")
    lead = F.struct("key", "url")
    first = slim.where(F.col("n_bytes") >= least).groupBy("digest").agg(F.min(lead).alias("lead"), F.sum("copies").alias("n"))
    again = sliced_join(slim, first.where("n > 1").drop("n"), ["digest"], F.xxhash64("key", "url"))
    again = again.withColumn("copies", F.col("copies") - F.when(lead == F.col("lead"), 1).otherwise(0)).where("copies > 0")
    again = again.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    one = rows.where(F.col("n_bytes") >= least).groupBy("digest").agg(F.min(F.struct("key", "url", "n_bytes", "html")).alias("r")).select("digest", "r.*")
    if least > 0:
        small = rows.where(F.col("n_bytes") < least).select(*one.columns)
        one = one.unionByName(small).withColumn("copy", F.when(F.col("n_bytes") < least, F.monotonically_increasing_id()).otherwise(0))
    else:
        one = one.withColumn("copy", F.lit(0).cast("long"))
    page = F.when(F.col("key") < LAST, F.col("key")).alias("page_id")
    own = _uuid(F.col("digest"), F.col("key"), F.col("url"), F.col("copy")).alias("record_id")
    told = _uuid(F.col("digest"), F.col("lead.key"), F.col("lead.url"), F.lit(0)).alias("refers_to_record")
    none = F.lit(None).cast("string")
    responses = one.select(own, none.alias("refers_to_record"), page, "url", "digest", "n_bytes", "html")
    return responses.unionByName(again.select(own, told, page, "url", "digest", "n_bytes", none.alias("html")))


def write(pages: DataFrame, folder: str, least: int = 0, date: str = "1970-01-01T00:00:00Z", most: int = 1 << 30) -> DataFrame:
    """Writes one record per row of ``pages`` below ``folder`` and returns the list of files (``file``, ``size``, ``records``).

    ``folder`` must be one that all executors reach. The page_id is kept in the header field WARC-Page-ID;
    control characters in a url are written as percent escapes. Null html is an empty payload, a null url
    or page_id leaves its field out. Equal rows are records of their own. An empty table gives an empty list;
    other columns are ignored. Payloads are in memory one at a time.
    """
    return saved(records(pages, least).mapInArrow(_write(folder, date, most), FILES), "warc-files")


def listed(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder or pattern, with their sizes; contents are not read."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.col("length").alias("size"))


def _begins(f, at: int) -> bool:
    """Whether a gzip member that begins at ``at`` decodes to the start of a record."""
    try:
        return zlib.decompressobj(31).decompress(f.read_at(4096, at), 5) == b"WARC/"
    except zlib.error:
        return False


def _find(f, at: int, stop: int, block: int = 1 << 18) -> int | None:
    """Place of the first valid member that begins in [at, stop)."""
    while at < stop:
        held = f.read_at(min(block, stop - at) + len(MAGIC) - 1, at)
        i = held.find(MAGIC)
        while i >= 0:
            if _begins(f, at + i):
                return at + i
            i = held.find(MAGIC, i + 1)
        at += block
    return None


def _decoded(f, at: int, block: int = 1 << 18) -> tuple[bytes | None, int]:
    """The member's content and the place behind it; no content if it is damaged or cut off."""
    d, parts, to = zlib.decompressobj(31), [], at
    try:
        while not d.eof:
            held = f.read_at(block, to)
            if not held:
                return None, at + 1
            parts.append(d.decompress(held))
            to += len(held)
    except zlib.error:
        return None, at + 1
    return b"".join(parts), to - len(d.unused_data)


def _told(data: bytes, payload: bool) -> dict:
    """Fields of one record; digest and length are those of the payload that was read."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        fields[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
    block = rest[: int(fields.get("content-length", len(rest)))]
    kind = fields.get("warc-type")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    body = None
    if kind == "response":
        body = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    plain = lambda name: (fields.get(name) or "").strip("<>").removeprefix("urn:uuid:") or None
    page = fields.get("warc-page-id", "")
    return {
        "record_type": kind,
        "record_id": plain("warc-record-id"),
        "page_id": int(page) if re.fullmatch(r"-?\d{1,19}", page) else None,
        "url": fields.get("warc-target-uri"),
        "refers_to_record": plain("warc-refers-to"),
        "payload_digest": digest,
        "payload_bytes": None if body is None else len(body),
        "payload": body if payload else None,
    }


def _scan(payload: bool, flush: int = 1 << 24):
    """Byte ranges to the records that begin in them, and one row ``#range`` per range that says
    where its first record began and where the search ended."""
    schema = pa.schema(
        [
            (c, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t])
            for c, t in (x.split() for x in RECORDS.split(", "))
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weight = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                disk, path = opened(r["file"])
                with disk.open_input_file(path) as f:
                    at, first = r["since"], None
                    while (begin := _find(f, at, r["stop"])) is not None:
                        data, at = _decoded(f, begin)
                        first = begin if first is None else first
                        told = {"record_type": "damaged"} if data is None else _told(data, payload)
                        held.append({**r, "offset": begin, "next": at, **told})
                        weight += 500 + (len(data) if payload and data else 0)
                        if weight > flush:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, weight = [], 0
                    held.append({**r, "offset": first, "next": max(at, r["stop"]), "record_type": "#range"})
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return run


def read(files: DataFrame, split: int = 64 << 20, payload: bool = True) -> DataFrame:
    """Records of the gzip archives in ``files`` (``file``, ``size``), written to the shared folder.

    Files are cut every ``split`` bytes. A task looks in its range for the bytes that begin a gzip
    member, takes a place as a record if the member decodes to a record's first bytes, and owns the records that
    begin in the range, which it reads beyond the range's end. A place inside a payload that holds an archive
    itself may look like a record; so the ranges of a file are compared: where a range did not begin
    where the one before it ended, it is read again from there, until all agree. A member that is cut off or
    damaged gives a row of type ``damaged`` and the search goes on behind its first byte; bytes between records
    are passed over. Null, missing and empty files: a file of size 0 has no records, a null one is left out.

    Result: ``file``, ``offset``, ``record_type``, ``record_id``, ``page_id``, ``url``, ``refers_to_record``,
    ``payload_digest``, ``payload_bytes`` (those of the payload read; revisits have the digest of their header)
    and ``payload`` (null unless wanted).
    """
    files = files.where(F.col("file").isNotNull() & (F.col("size") > 0)).select("file", F.col("size").cast("long").alias("size"))
    n = files.agg(F.sum(F.ceil(F.col("size") / split))).first()[0] or 0
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split).cast("long")))
    ranges = files.withColumn("start", start).select("file", "start", F.least(F.col("start") + split, "size").alias("stop"), F.col("start").alias("since"))
    found = saved(ranges.repartition(max(1, int(n))).mapInArrow(_scan(payload), RECORDS), "warc-records")
    marks = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        due = F.least(F.coalesce(F.max("next").over(marks), F.lit(0).cast("long")), "stop")
        ends = found.where("record_type = '#range'").withColumn("due", due)
        agreed = (F.col("since") == F.col("due")) | (F.coalesce("offset", "stop") == F.col("due"))
        off = saved(ends.where(~agreed).select("file", "start", "stop", F.col("due").alias("since")), "warc-ranges")
        if off.isEmpty():
            return found.where("record_type <> '#range'").drop("start", "stop", "since", "next")
        again = off.mapInArrow(_scan(payload), RECORDS)
        found = saved(found.join(off.select("file", "start"), ["file", "start"], "left_anti").unionByName(again), "warc-records")


def resolved(found: DataFrame) -> DataFrame:
    """Responses and revisits, the latter with ``payload_bytes`` and ``refers_to`` (page_id) of the response that they name;
    both null where it is in none of the archives."""
    told = found.where("record_type IN ('response', 'revisit')").drop("payload")
    named = told.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("full")
    )
    back = sliced_join(told.where("record_type = 'revisit'"), named, ["refers_to_record"], F.xxhash64("record_id"), "left")
    back = back.withColumn("payload_bytes", F.col("full")).drop("full")
    return told.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long")).unionByName(back)


def digest(pages: DataFrame, least: int = 0) -> DataFrame:
    """Writes ``pages`` as archives to the shared folder, reads them back, and says per record what came back.
    Nulls, repeats, ties, empty tables and other columns: see ``records`` and ``write``."""
    files = write(pages, work_path(pages.sparkSession, "warc"), least)
    out = resolved(read(files, payload=False))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Base 32 by SQL: 5 bits from two neighbouring hexadecimal digits.
SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
  SELECT *, min(page_id) OVER (PARTITION BY hex) AS lead,
    row_number() OVER (PARTITION BY hex ORDER BY page_id NULLS LAST) AS k,
    [strpos('0123456789abcdef', substr(hex || '0', i, 1)) - 1 FOR i IN range(1, 42)] AS nib FROM p
)
SELECT page_id, payload_bytes,
  list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((((nib[5 * i // 4 + 1] * 16 + nib[5 * i // 4 + 2]) >> (3 - 5 * i % 4)) & 31) + 1)::INTEGER, 1) FOR i IN range(0, 32)], 'string_agg', '') AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN k > 1 THEN lead END AS refers_to
FROM d
"""
