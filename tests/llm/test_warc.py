"""Archives: round trips, revisits of equal payloads, odd rows, archives of others."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from salesloom.llm import warc

SCHEMA = "page_id long, url string, html string"
ROWS = [
    (5, "u", "abc"), (3, "u", "abc"), (3, "u", "abc"), (3, "u", "abc"), (None, "x", "abc"),
    (7, None, None), (8, "a b\r\nc", ""), (None, None, None), (10, "long", "é" * 200_000),
    (9, "z", "é\x00\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (11, "z", "\r\n\r\n"),
]


def expected(rows, least=0):
    first, seen = {}, set()
    key = {}
    for page, url, html in rows:
        k = (page is None, page or 0, url is None, url or "")
        key[html or ""] = min(key.get(html or "", k), k)
        if k == key[html or ""]:
            first[html or ""] = page
    out = []
    for page, url, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        k = (page is None, page or 0, url is None, url or "")
        revisit = len(data) >= least and (k != key[html or ""] or (html or "") in seen)
        if k == key[html or ""]:
            seen.add(html or "")
        out.append((page, len(data), digest, "revisit" if revisit else "response",
                    first[html or ""] if revisit else None))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("least", [0, 4])
def test_round_trip(spark, tmp_path, least):
    pages = spark.createDataFrame(ROWS, SCHEMA).withColumns(
        {c: F.lit(1) for c in ("payload", "shared", "first", "copies", "total", "number", "content", "value")})
    assert found(warc.archive_pages(pages, str(tmp_path / "a"), least)) == expected(ROWS, least)


def test_joins_of_large_sides_and_many_copies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "MOST_BROADCAST", 1)
    monkeypatch.setattr(warc, "COPIES_PER_ROW", 3)
    rows = ROWS + [(3, "u", "abc")] * 20 + [(4, f"w{k}", "d" * (k % 5)) for k in range(60)]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert found(warc.archive_pages(pages, str(tmp_path / "a"))) == expected(rows)


def test_archives_are_split_and_have_unique_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 8_000)
    pages = spark.range(40).select(F.col("id").alias("page_id"), F.concat(
        F.lit("http://e.org/"), "id").alias("url"), F.repeat(F.lit("x"), F.col("id").cast("int") + 900).alias("html"))
    out = warc.archive_pages(pages.coalesce(1), str(tmp_path / "a"))
    assert out.count() == 40 and out.where("record_type = 'response'").count() == 40
    assert len(list((tmp_path / "a").glob("part-*"))) >= 8
    read = warc.read_archives(spark, str(tmp_path / "a"))
    assert read.select("record_id").distinct().count() == 40


def test_no_pages(spark, tmp_path):
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA), str(tmp_path / "a")).count() == 0


def record(kind, body, **fields):
    http = b"HTTP/1.1 200 OK\r\n\r\n" + body
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"Content-Length: {len(http)}"] + [
        f"{k.replace('_', '-')}: {v}" for k, v in fields.items()]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + b"\r\n\r\n"


def test_archives_written_elsewhere(spark, tmp_path):
    records = [
        record("warcinfo", b"software: none"),
        record("response", b"hello", WARC_Record_ID="<urn:uuid:1>", WARC_Target_URI="http://a"),
        record("revisit", b"", WARC_Record_ID="<urn:uuid:2>", WARC_Refers_To="<urn:uuid:1>",
               WARC_Payload_Digest="sha1:" + warc.payload_digest(b"hello")),
        record("revisit", b"", WARC_Record_ID="<urn:uuid:3>", WARC_Refers_To="<urn:uuid:9>",
               WARC_Payload_Digest="sha1:UNKNOWN"),
    ]
    (tmp_path / "a").mkdir()
    (tmp_path / "a/plain.warc").write_bytes(b"".join(records))
    (tmp_path / "a/packed.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    read = warc.read_archives(spark, str(tmp_path / "a"))
    assert read.where("record_type = 'response'").select("uri", "payload_bytes").collect() == [("http://a", 5)] * 2
    got = warc.with_originals(read).where("record_type = 'revisit'").select("payload_bytes", "payload_digest").distinct()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(5, warc.payload_digest(b"hello")), (None, "UNKNOWN")], key=str)


def test_reading_takes_time_in_proportion_to_an_archive(spark, tmp_path):
    import time

    took = {}
    for megabytes in (1, 8, 40):  # the first one starts the workers
        folder = tmp_path / str(megabytes)
        folder.mkdir()
        (folder / "a.warc").write_bytes(b"".join(
            record("response", b"%06d" % k * 8_000, WARC_Record_ID=f"<urn:uuid:{k}>") for k in range(21 * megabytes)))
        begin = time.perf_counter()
        read = warc.read_archives(spark, str(folder)).select("record_id", "payload_digest").collect()
        took[megabytes] = time.perf_counter() - begin
        assert sorted(map(tuple, read)) == sorted(
            (f"urn:uuid:{k}", warc.payload_digest(b"%06d" % k * 8_000)) for k in range(21 * megabytes))
    assert took[40] < 6 * max(took[8], 0.5)  # with the square it would be some 15 times


def test_damaged_archives_raise():
    whole = record("response", b"hello", WARC_Payload_Digest="sha1:" + "A" * 32)
    with pytest.raises(ValueError, match="digest"):
        list(warc.Parser().feed(whole))
    cut = warc.Parser()
    list(cut.feed(record("response", b"hello")[:-9]))
    with pytest.raises(ValueError, match="ends inside"):
        cut.close()
