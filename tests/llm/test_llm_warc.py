"""Archives against a brute-force grouping of the payloads, and the reader on damaged files."""

import base64
import hashlib
import io

import pytest

from tributary.llm import warc

KINDS = "page_id long, url string, html string, digest string, refers_to string, note int"


def expected(pages, least):
    last = {}
    for p, _, h, *_ in pages:
        b = (h or "").encode()
        if p is not None and len(b) >= least:
            last[b] = max(p, last.get(b, p))
    out = []
    for p, u, h, *_ in pages:
        b = (h or "").encode()
        n = sum((x[2] or "").encode() == b for x in pages)
        refers = last.get(b) if n > 1 and b in last and (p is None or p < last[b]) else None
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((p, len(b), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


PAGES = [
    (1, "http://a/x", "<p>one</p>", "d", "r", 1), (2, "http://a/ü é", "<p>one</p>", None, None, None), (3, None, None, "d", "r", 1),
    (4, "u\r\nX: y", "", "", "", 0), (5, "", "é" * 200_000, "d", "r", 1), (6, "http://b", "\r\n\r\nWARC/1.1\r\n", "d", "r", 1),
    (6, "http://b", "\r\n\r\nWARC/1.1\r\n", "d", "r", 1), (None, "n", "<p>one</p>", "d", "r", 1), (None, "n", "alone", "d", "r", 1),
    (-9, "neg", "zz", "d", "r", 1), (-8, "neg", "zz", "d", "r", 1),
]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    got = warc.archive_round_trip(spark.createDataFrame(PAGES, KINDS).repartition(3), least).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(PAGES, least)


def test_empty_table(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], KINDS)).collect() == []


def test_payloads_and_rolling(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, KINDS).coalesce(1)
    files = warc.write_archives(warc.with_references(pages), str(tmp_path / "w"), file_bytes=400)
    assert files.count() > 3
    got = {(r.page_id, bytes(r.payload)) for r in warc.read_archives(files, with_payload=True).where("record_type='response'").collect()}
    assert (5, ("é" * 200_000).encode()) in got and (6, b"\r\n\r\nWARC/1.1\r\n") in got


def one(payload=b"body"):
    return warc.record(7, "http://x", payload, warc.base32_sha1(payload), len(payload), None)


def test_damaged_archives_are_refused():
    assert [r.payload for r in warc.read_archive(io.BytesIO(one() + one(b"")), True)] == [b"body", b""]
    for bad in (one()[:-9], warc.record(7, "u", b"body", warc.base32_sha1(b"other"), 4, None), warc.record(7, "u", b"body", warc.base32_sha1(b"body"), 5, None)):
        with pytest.raises(warc.Damaged):
            list(warc.read_archive(io.BytesIO(bad)))
