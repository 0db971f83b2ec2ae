import random

import brute
import pytest
from caseload.llm import warc as W


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(1)
    bodies = ["<p>one</p>", "", None, "two\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n", "é漢🙂\n" * 50, "x" * 200_000]
    rows = [(i, f"http://a.example/{i}", rng.choice(bodies) if i % 2 else f"page {i}", "clash") for i in range(60)]
    return [*rows, (60, None, "<p>one</p>", "c"), (61, "http://b.example/\r\nX: y", "line", "c")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string").withColumnRenamed("payload", "row").repartition(4)


def test_round_trip(spark, pages):
    out, path = W.archive_roundtrip(frame(spark, pages))
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out.collect()}
    assert got == brute.warc([(r[0], r[2]) for r in pages])
    records = W.read_archives(spark, path)
    assert records.count() == len(pages)
    stored = {r.page_id: (r.payload, r.url) for r in records.where("record_type = 'response'").collect()}
    want = {r[0]: (r[2] or "", r[1] and r[1].replace("\r", " ").replace("\n", " ")) for r in pages}
    assert stored and all(want[k] == v for k, v in stored.items())
    assert records.where("record_type = 'revisit' and payload is not null").count() == 0


def test_shuffle_join_and_least_bytes(spark, pages):
    by = lambda x: sorted((r.page_id, r.record_type, r.refers_to is None) for r in x.collect())
    assert by(W.resolve(frame(spark, pages), sent_rows=0)) == by(W.resolve(frame(spark, pages)))
    small = W.resolve(frame(spark, pages), least_bytes=1000).collect()
    assert {r.record_type for r in small if r.payload_bytes < 1000} == {"response"}
    assert any(r.record_type == "revisit" for r in small)


def test_nulls_repeats_and_empty_table(spark):
    rows = [(None, "u", "a", "c"), (None, "u", "a", "c"), (5, "v", "a", "c"), (5, "v", "a", "c"), (7, None, None, "c")]
    out, _ = W.archive_roundtrip(frame(spark, rows))
    got = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in out.collect())
    assert got == sorted([("5", 1, "response", None), ("5", 1, "revisit", 5), ("None", 1, "revisit", 5), ("None", 1, "revisit", 5), ("7", 0, "response", None)])
    out, _ = W.archive_roundtrip(frame(spark, rows).where("false"))
    assert out.count() == 0


def test_a_torn_or_changed_record_is_noticed():
    body = b"HTTP/1.1 200 OK\r\n\r\nabc"
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    with pytest.raises(ValueError):
        list(W.parse(head + body + b"\r\n\r\n"))
    with pytest.raises(ValueError):
        list(W.parse(b"x" + head + body + b"\r\n\r\n"))
