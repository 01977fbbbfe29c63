"""WARC archives: round trips, normalising, reading by offset."""

from __future__ import annotations

import gzip
import hashlib
import json
import zlib

import pytest

from martloom.llm import warc


def records_of(path):
    """Offset and bytes of each gzip member."""
    data, out, at = path.read_bytes(), [], 0
    while at < len(data):
        d = zlib.decompressobj(31)
        text = d.decompress(data[at:])
        out.append((at, text))
        at = len(data) - len(d.unused_data)
    return out


@pytest.mark.parametrize("chunk", [7, 1 << 20])
def test_normaliser_keeps_every_byte(tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(warc, "CHUNK", chunk)
    records = [warc.page_record(str(i), f"http://a/{i}\r\nX: y é", b"\r\n\r\nx" * i, "d", None if i % 3 else "9") for i in range(40)]
    records.append(warc.record("warcinfo", {"WARC-Record-ID": "<urn:x>"}, b""))
    whole = b"".join(records)
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(whole))
    (tmp_path / "many.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "none.warc.gz").write_bytes(gzip.compress(b""))
    for name, n in (("one", len(records)), ("many", len(records)), ("none", 0)):
        assert warc.normalise_file(f"{tmp_path}/{name}.warc.gz", str(tmp_path / "out"), f"{name}.warc.gz", 0) == n
        members = records_of(tmp_path / "out" / f"{name}.warc.gz")
        assert [m for _, m in members] == records[:n]
        index = [json.loads(x) for x in (tmp_path / "out" / f"{name}.warc.gz{warc.INDEX}").read_text().splitlines()]
        assert [e["offset"] for e in index] == [o for o, _ in members]
    for bad in (gzip.compress(whole)[:-20], gzip.compress(whole[:-30])):
        (tmp_path / "bad.warc.gz").write_bytes(bad)
        with pytest.raises(ValueError, match="ends"):
            warc.normalise_file(f"{tmp_path}/bad.warc.gz", str(tmp_path / "out"), "bad.warc.gz", 1)


def test_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 10_000)
    body, long = "é" * 60, "<p>" * 400_000
    rows = [(5, "u", body), (3, None, body), (9, "u\r\n", body), (4, "u", "short"), (2, "u", "short"), (7, "u", None), (8, "u", ""),
            (None, "u", body), (3, "again", body), (10, "u", long), (11, "u", long), (12, "u", "x" * 99), (13, "u", "x" * 99)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS payload", "2 AS `a.b`", "3 AS page")
    got = warc.round_trip(pages, str(tmp_path)).collect()
    assert len(got) == len(rows)
    want = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        refers_to = {body: 3, long: 10}.get(html)
        refers_to = None if page_id in (None, refers_to) else refers_to
        kind = "response" if refers_to is None else "revisit"
        want.append((page_id or -1, len(payload), hashlib.sha256(payload).hexdigest(), kind, refers_to))
    assert sorted(want, key=str) == sorted(
        ((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str
    )
    for r in got:
        assert (r.payload is None) == (r.record_type == "revisit")
    assert warc.round_trip(pages.limit(0), str(tmp_path / "none")).count() == 0
