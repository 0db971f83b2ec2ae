"""WARC archives with revisit resolution.

Headers (payload digest, page id, row number) are shuffled by digest; the smallest page id of a digest is
the response, all others become revisits that name it. Archives are written by Spark's own text
writer (each row is one record, the line separator is the record separator), so a lost executor or a
repeated task leaves no torn file and any Hadoop file system will do. Reading parses by
Content-Length, checks every digest, and joins revisit records to their responses by record id.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.llm.common import rereadable, scratch, stash, text_or_empty

CRLF = "\r\n"
ARCHIVE_BYTES = 32 << 20  # payload bytes of one archive file, on average
SENT_ROWS = 1_000_000  # of 24 bytes
# fixed values of the WARC 1.1 format
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32, HEX32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789ABCDEFGHIJKLMNOPQRSTUV"

PARSED = ("record_type string, record_id string, page_id long, url string, payload string, payload_bytes long, "
          "payload_digest string, refers_to_id string")


def digest32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: ten hex digits are eight base32 digits."""
    sha = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(sha, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), HEX32, BASE32)


def _rows(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    payload = text_or_empty(F.col(f"`{payload_col}`"))
    return pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), digest32(payload).alias("payload_digest"))


def revisits(rows: DataFrame, least_bytes: int) -> DataFrame:
    """row, refers_to, refers_to_row of the rows that revisit another; written once, payloads stay where they are."""
    heads = stash(rows.where(F.col("payload_bytes") >= least_bytes).select("row", "page_id", "payload_digest"), "warc-heads")
    first = heads.groupBy("payload_digest").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row")).alias("origin"), F.count("*").alias("n"))
    shared = first.where(F.col("n") > 1).select("payload_digest", "origin")  # a digest of its own needs no partner
    found = heads.join(shared, "payload_digest").where(F.col("origin.row") != F.col("row"))
    return stash(found.select("row", F.col("origin.page_id").alias("refers_to"), F.col("origin.row").alias("refers_to_row")), "warc-revisits")


def resolve(pages: DataFrame, least_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
            payload_col: str = "html", sent_rows: int = SENT_ROWS) -> DataFrame:
    """row, page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to, refers_to_row of ``pages``.

    Null payloads are empty. Of rows with equal payloads of at least ``least_bytes`` the one with the
    smallest (page_id, row number) is the response; smaller payloads are all responses. Null page ids
    come after all others. Only headers are shuffled for the choice; a payload that very many pages
    share is reduced to one row in each task first. Up to ``sent_rows`` revisits are sent to the tasks
    that hold the payloads; beyond that both sides are shuffled by row number."""
    names = (id_col, url_col, payload_col)
    rows = _rows(rereadable(pages.select(*[F.col(f"`{c}`") for c in names]), "warc-pages"), *names)
    heads = revisits(rows, least_bytes)
    if heads.count() <= sent_rows:
        joined = rows.join(F.broadcast(heads), "row", "left")
    else:
        joined = rows.join(heads, "row", "left")
    return joined.withColumn("record_type", F.when(F.col("refers_to_row").isNotNull(), "revisit").otherwise("response"))


def _record_id(row: Column) -> Column:
    """A urn:uuid made from the row's number; stable when a task is repeated."""
    h = F.md5(row.cast("string").cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """One header line; nothing for a null value. Line breaks in a value become spaces."""
    safe = F.translate(value.cast("string"), "\r\n", "  ")
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)))


def record(resolved: DataFrame, date: str) -> DataFrame:
    """One column value: the record of each row, without the two line breaks that end it."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(CRLF + CRLF))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat_ws(
        "", F.lit(VERSION + CRLF), _line("WARC-Type", F.col("record_type")), _line("WARC-Record-ID", _record_id(F.col("row"))),
        _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", F.col("url")), _line("X-Page-Id", F.col("page_id")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))), _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("refers_to_row")))),
        _line("X-Refers-To-Page-Id", F.when(revisit, F.col("refers_to"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")), _line("Content-Length", F.octet_length(block)))
    return resolved.select(F.concat(head, F.lit(CRLF), block).alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
                   compression: str = "gzip", **cols: str) -> None:
    """Write a deduplicated archive of ``pages`` to folder ``path``: files of about ``ARCHIVE_BYTES``."""
    size, n = pages.agg(F.sum(F.octet_length(F.col(f"`{cols.get('payload_col', 'html')}`"))), F.count("*")).first()
    per_file = max(1, n * ARCHIVE_BYTES // max(1, size or 0))
    record(resolve(pages, least_bytes, **cols), date).write.option("lineSep", CRLF + CRLF).option(
        "maxRecordsPerFile", per_file).option("compression", compression).text(path)


def parse(data: bytes) -> Iterator[tuple]:
    """Records of one archive file, by Content-Length."""
    at, ends = 0, b"\r\n\r\n"
    while at < len(data):
        split = data.index(ends, at)
        lines = data[at:split].decode("utf-8").split(CRLF)
        if lines[0] != VERSION:
            raise ValueError(f"not a WARC record at byte {at}: {lines[0][:40]!r}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        body = data[split + 4:split + 4 + int(head["Content-Length"])]
        at = split + 4 + int(head["Content-Length"]) + 4
        http, payload = body.split(ends, 1)
        response = head["WARC-Type"] == "response"
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if response and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
        page = head.get("X-Page-Id")
        yield (head["WARC-Type"], head["WARC-Record-ID"], int(page) if page is not None else None, head.get("WARC-Target-URI"),
               payload.decode("utf-8") if response else None, len(payload) if response else None, digest, head.get("WARC-Refers-To"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records under ``path`` (columns of ``PARSED``); each task holds one file at a time."""
    import zlib

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in PARSED.split(", ")]
        for batch in batches:
            for file, data in zip(batch["path"], batch["content"]):
                rows = parse(zlib.decompress(data, 47) if file.endswith(".gz") else bytes(data))
                part = []
                for r in rows:
                    part.append(r)
                    if len(part) == 1000:
                        yield _frame(part, names)
                        part = []
                if part:
                    yield _frame(part, names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInPandas(run, PARSED)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names, dtype=object)
    return frame.astype({"page_id": "Int64", "payload_bytes": "Int64"})


def join_revisits(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record read.

    Revisits have no payload of their own: its size and the page come from the response that
    WARC-Refers-To names. A revisit whose response is missing keeps nulls there."""
    own = records.select("record_type", "page_id", "payload_bytes", "payload_digest", "refers_to_id")
    origin = records.where(F.col("record_type") == "response").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("origin_bytes"))
    return own.join(origin, "refers_to_id", "left").select(
        "page_id", F.coalesce("payload_bytes", "origin_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")


def archive_roundtrip(pages: DataFrame, least_bytes: int = 0, **cols: str) -> tuple[DataFrame, str]:
    """(records read back and resolved, archive folder) of ``pages``, written to the shared folder.

    Null urls leave the header out, null page ids come back null, an empty table gives no rows."""
    path = scratch(pages.sparkSession, "warc")
    write_archives(pages, path, least_bytes, **cols)
    return join_revisits(read_archives(pages.sparkSession, path)), path
