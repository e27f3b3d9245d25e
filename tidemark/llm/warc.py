"""WARC archives: writing with revisit records, reading with boundary-chain verification.

Writing. A record is text (its payload is UTF-8), so Spark's text writer makes the
archives: one row is one record without its closing blank lines, and the blank
lines are the row separator. A failed task leaves nothing behind, and any file
system that Spark writes to will do. Records whose payloads are equal and long
enough are written once: the largest page_id keeps the payload, the others become
revisit records that name it.

Reading. The bytes ``WARC/1.1`` may occur inside a payload, so finding them proves
nothing. Each task emits every place that looks like the start of a record,
together with its successor, the place where that record says it ends. A file's
start is a record; pointer jumping over the table of candidates (each round
doubles the reach of the pointers) marks what is reachable from it. Only marked
places are records, whatever payloads contain.

Scale: copies are found by digest with one aggregate and joined back by digest, where
Spark splits a hot digest; payloads are never grouped. Archives roll after
``records_per_file`` records, as archives do, which bounds what a reading task holds
and the rounds of pointer jumping (logarithm of the records of a file). Rounds
work on (file, offset, successor) only and are written to the shared folder.

Defined results: a null html is an empty payload; a null or odd url is written
percent-encoded where a header could not hold it; payloads of less than
``min_bytes`` bytes are always responses; repeated rows of the page that keeps a
payload are responses each; a null page_id reads back as null; an empty table gives no rows; extra columns are
ignored. A candidate that points beyond its file, or a file that does not begin with
a record, raises ValueError when ``strict``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import remove, table, written
from tidemark.session import scratch_path

MAGIC = b"WARC/1.1\r\n"
CLOSE = "\r\n\r\n"
MIN_BYTES = 1000
RECORDS_PER_FILE = 1024
_LENGTH = re.compile(rb"\r\nContent-Length: *(\d{1,18})\r\n", re.I)


def with_copies(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, refers_to (null: this row keeps the payload)."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).alias("html")) \
        .withColumns({"payload_bytes": F.octet_length("html").cast("bigint"),
                      "payload_digest": F.sha1(F.col("html").cast("binary"))})
    first = rows.filter(F.col("payload_bytes") >= min_bytes).groupBy(F.col("payload_digest").alias("digest")).agg(
        F.max("page_id").alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    same = (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") >= min_bytes)
    own = F.col("best").isNull() | F.col("page_id").eqNullSafe(F.col("best"))
    return rows.join(first, same, "left").select(
        "page_id", "url", "html", "payload_bytes", "payload_digest", own.alias("is_response"),
        F.when(~own, F.col("best")).alias("refers_to"))


def record(date: str = "2024-01-01T00:00:00Z"):
    """A row of ``with_copies`` as the text of a WARC record, without its closing blank lines."""
    line = lambda *x: F.concat(*x, F.lit("\r\n"))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    keep = F.col("is_response")
    # A header value is one line of printable ASCII.
    uri = F.coalesce(F.when(F.col("url").rlike(r"\A[!-~]+\z"), F.col("url")),
                     F.url_encode(F.coalesce("url", F.lit(""))))
    http = F.concat(
        line(F.lit("HTTP/1.1 200 OK")), line(F.lit("Content-Type: text/html; charset=utf-8")),
        line(F.lit("Content-Length: "), F.col("payload_bytes").cast("string")), F.lit("\r\n"))
    block = F.when(keep, F.concat(http, F.col("html"))).otherwise(http)
    head = F.concat(
        line(F.lit("WARC/1.1")),
        line(F.lit("WARC-Type: "), F.when(keep, "response").otherwise("revisit")),
        line(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">")),
        line(F.lit(f"WARC-Date: {date}")),
        line(F.lit("WARC-Target-URI: "), uri),
        line(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.when(keep, "").otherwise(F.concat(
            line(F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line(F.lit("WARC-Refers-To: <urn:page:"), F.coalesce(F.col("refers_to").cast("string"), F.lit("null")),
                 F.lit(">")))),
        line(F.lit("Content-Type: application/http; msgtype=response")),
        line(F.lit("Content-Length: "), F.octet_length(block).cast("string")), F.lit("\r\n"))
    return F.concat(head, block)


def write(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    with_copies(pages, min_bytes).select(record().alias("value")).write \
        .option("lineSep", CLOSE).option("maxRecordsPerFile", records_per_file).text(path)


# ---- reading --------------------------------------------------------------

def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path) \
        .filter("length > 0").select("path", "content")


def _header(data: memoryview, at: int) -> tuple[bytes, int, int] | None:
    """(header, start of the block, end of the record) of what stands at ``at``, if it has a header."""
    size = 4096
    while True:
        piece = bytes(data[at:at + size])
        stop = piece.find(b"\r\n\r\n")
        if stop >= 0 or len(piece) < size:
            break
        size *= 4
    length = _LENGTH.search(piece, 0, stop + 2) if stop >= 0 else None
    if length is None:
        return None
    begin = at + stop + 4
    return piece[:stop + 2], begin, begin + int(length[1]) + len(CLOSE)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, next): every place that looks like a record and where that record says the next one is.

    ``next`` is null at the end of the file, and -1 where the claimed end cannot be one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column("path"), b.column("content")):
                buffer = content.as_buffer()
                data, raw = memoryview(buffer), buffer.to_pybytes()
                at, rows = raw.find(MAGIC), []
                while at >= 0:
                    found = _header(data, at)
                    if found:
                        end = found[2]
                        good = end <= len(raw) and raw[end - 4:end] == CLOSE.encode() \
                            and (end == len(raw) or raw.startswith(MAGIC, end))
                        rows.append((at, (None if end == len(raw) else end) if good else -1))
                    elif at == 0:
                        rows.append((0, -1))
                    at = raw.find(MAGIC, at + 1)
                if not raw.startswith(MAGIC):
                    rows.append((0, -1))
                yield pa.record_batch([pa.array([file.as_py()] * len(rows), pa.string()),
                                       pa.array([r[0] for r in rows], pa.int64()),
                                       pa.array([r[1] for r in rows], pa.int64())], names=["file", "at", "next"])

    return _files(spark, path).mapInArrow(run, "file string, at bigint, next bigint")


def reachable(spark: SparkSession, found: DataFrame, strict: bool = True) -> DataFrame:
    """(file, at) of the candidates that the chain from the file's start reaches.

    Round k knows the candidates within 2**k records of the start and, for every
    candidate, the one 2**k records on. A row that is marked marks its pointer's target,
    and every pointer is replaced by its target's pointer.
    """
    rows = found.select("file", "at", F.col("next").alias("jump"), F.col("next").eqNullSafe(-1).alias("bad"),
                        (F.col("at") == 0).alias("marked"))
    rows, path = written(spark, rows, "warc-chain")
    marked = rows.filter("marked").count()
    while True:
        target = rows.filter("jump >= 0").select("file", F.col("jump").alias("at"), "marked")
        pushed = target.groupBy("file", "at").agg(F.max("marked").alias("pushed"))
        ahead = rows.select("file", F.col("at").alias("jump"), F.col("jump").alias("further"))
        step = rows.join(pushed, ["file", "at"], "left").join(ahead, ["file", "jump"], "left").select(
            "file", "at", F.col("further").alias("jump"), "bad",
            (F.col("marked") | F.coalesce("pushed", F.lit(False))).alias("marked"))
        after, new_path = written(spark, step, "warc-chain")
        n, broken = after.filter("marked").agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.col("bad").cast("int")), F.lit(0))).first()
        remove(spark, path)
        rows, path = after, new_path
        if n == marked:
            if strict and broken:
                raise ValueError(f"{broken} archives have a record that does not end where it says")
            return rows.filter("marked and not bad").select("file", "at")
        marked = n


def records(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """The records of the archives below ``path``.

    page_id, url, record_type, refers_to, payload (null for revisits), payload_bytes
    and payload_digest of the full payload; a response's are those of its bytes.
    """
    marked = reachable(spark, candidates(spark, path), strict)
    places = marked.groupBy("file").agg(F.sort_array(F.collect_list("at")).alias("at"))   # bounded by the file
    files = _files(spark, path).withColumnRenamed("path", "file").join(places, "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content, places in zip(b.column("content"), b.column("at")):
                data, rows = memoryview(content.as_buffer()), []
                for at in places.as_py():
                    rows.append(_parse(data, *_header(data, at)))
                    if len(rows) == 256:
                        yield _out(rows)
                        rows = []
                if rows:
                    yield _out(rows)

    return files.select("content", "at").mapInArrow(run, ", ".join(f"{n} {t}" for n, t in _FIELDS))


_FIELDS = (("page_id", "bigint"), ("url", "string"), ("record_type", "string"), ("refers_to", "bigint"),
           ("payload", "binary"), ("payload_bytes", "bigint"), ("payload_digest", "string"))
_ARROW = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _out(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, _ARROW[t]) for c, (_, t) in zip(zip(*rows), _FIELDS)],
                           names=[n for n, _ in _FIELDS])


def _page(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def _parse(data: memoryview, header: bytes, begin: int, end: int) -> tuple:
    fields = dict(x.split(": ", 1) for x in header.decode("ascii").split("\r\n")[1:] if ": " in x)
    block = bytes(data[begin:end - len(CLOSE)])
    kind = fields["WARC-Type"]
    http, _, payload = block.partition(b"\r\n\r\n")
    if kind == "response":
        return (_page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], kind, None, payload, len(payload),
                hashlib.sha1(payload).hexdigest())
    size = int(_LENGTH.search(http + b"\r\n")[1])
    return (_page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], kind, _page(fields.get("WARC-Refers-To")), None,
            size, fields["WARC-Payload-Digest"].removeprefix("sha1:"))


def q_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    return records(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS best FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_BYTES} AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_BYTES} AND page_id <> best THEN best END AS refers_to
FROM r"""
