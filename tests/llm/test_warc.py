"""Archives: round trip, splits, repeated payloads, what is not a record."""

import base64
import gzip
import hashlib

from scoreloom.llm import warc
from scoreloom.sources.workspace import fresh_path

PAGES = "page_id bigint, url string, html string, digest int"


def brute(rows, least=0):
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    first = {}
    for i, _, h, _ in rows:
        if len((h or "").encode()) >= least and i is not None:
            first[digest(h)] = min(i, first.get(digest(h), i))
    out = []
    for i, _, h, _ in rows:
        size = len((h or "").encode())
        refers = first.get(digest(h)) if size >= least else None
        refers = None if refers == i else refers
        out.append((i, size, digest(h), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def records(frame):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect()), key=repr)


def test_round_trip_and_splits(spark):
    """Ranges of any size, far below a record too, give each record once."""
    rows = [(i, f"http://h.example/{i}?q=ä b", "x" * (i * 37 % 900) + "ü" * (i % 7), None) for i in range(200)]
    rows += [(i, None, None, None) for i in range(200, 205)] + [(205, "http://h/\r\nX: y", "long " * 400_000, None), (206, "", "", 3)]
    frame = spark.createDataFrame(rows, PAGES)
    files = warc.write_warc(frame.repartition(3), fresh_path(spark, "warc"), file_bytes=4000)
    assert files.count() > 3
    for split in (1 << 20, 997, 64):
        found = warc.read_warc(files, split_bytes=split, with_payload=True)
        assert records(found) == brute(rows), split
        assert {bytes(r.payload).decode() for r in found.where("page_id = 17").collect()} == {rows[17][2]}
        assert found.where("record_type = 'response' AND NOT intact").count() == 0
    listed = warc.warc_files(spark, files.first().path.rsplit("/", 1)[0])
    assert warc.read_warc(listed).count() == len(rows)


def test_long_heads(spark):
    """A url that fills megabytes of its record's head, and hardly compresses, is read back like any other."""
    url = "http://h.example/" + "".join(hashlib.sha256(str(i).encode()).hexdigest() + "ü" for i in range(40_000))
    rows = [(1, url, "a", None), (2, "http://h/", "b", None), (3, url[::-1], "a", None)]
    files = warc.write_warc(spark.createDataFrame(rows, PAGES), fresh_path(spark, "warc"))
    for split in (1 << 20, 50_000):
        assert records(warc.read_warc(files, split_bytes=split)) == brute(rows)


def test_short_payloads_are_responses(spark):
    rows = [(1, None, "ab", None), (2, None, "ab", None), (3, None, "abcdef", None), (4, None, "abcdef", None)]
    frame = spark.createDataFrame(rows, PAGES)
    assert records(warc.archive_round_trip(frame, least_bytes=4)) == brute(rows, 4)


def test_ties_nulls_and_empty(spark):
    """Equal page_ids are responses all; a null page_id comes after the others."""
    rows = [(5, "u", "same", None), (5, "u", "same", None), (None, "u", "same", None), (7, "u", "other", None)]
    frame = spark.createDataFrame(rows, PAGES)
    assert records(warc.archive_round_trip(frame)) == brute(rows)
    assert warc.archive_round_trip(frame.limit(0)).count() == 0


def test_magic_that_is_no_record(tmp_path):
    """Other gzip members and bare magic bytes are passed over; a cut-off record is none."""
    record = gzip.compress(b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 2\r\n\r\nok\r\n\r\n")
    data = warc.MAGIC + b"\x00junk" + gzip.compress(b"no warc") + record + warc.MAGIC * 3 + record + record[:-9]
    path = str(tmp_path / "x.warc.gz")
    with open(path, "wb") as f:
        f.write(data)
    assert len(list(warc.members(path, 0, len(data)))) == 2
    assert sum(len(list(warc.members(path, a, a + 10))) for a in range(0, len(data), 10)) == 2
