"""WARC archives: a deduplicating writer and a splittable reader."""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..sources.workspace import fresh_path, stored

MAGIC = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
# The identifiers of our records, the revisit profile and the date that all records carry.
RECORD_URN = "urn:scoreloom:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"

FILE_BYTES = 256 << 20
SPLIT_BYTES = 8 << 20
BLOCK = 1 << 20

MANIFEST = "path string, bytes bigint, records bigint"
RECORDS = (
    "page_id bigint, record_type string, target_uri string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint, intact boolean, payload binary"
)


def _open(uri: str):
    """File system and path of a URI, on whatever machine the task runs."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload an earlier page_id has.

    Only identifiers and digests are shuffled. The first page of a digest is a minimum that is combined
    before the shuffle; the join back to the members is one that adaptive execution splits when a digest
    has many. Pages that tie for the smallest page_id are responses all; a null page_id comes last.
    """
    narrow = pages.select(
        "page_id", F.sha1("_payload").alias("digest"), F.octet_length("_payload").alias("size")
    ).where(F.col("size") >= least_bytes)
    first = narrow.groupBy("digest").agg(
        F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")
    ).where((F.col("n") > 1) & F.col("refers_to").isNotNull())
    return (
        narrow.join(first, "digest")
        .where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select("page_id", "digest", "refers_to").distinct()
    )


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per page below ``folder``; returns the table of files (path, bytes, records).

    ``pages`` has page_id, url and html. A null html is an empty payload, a null url leaves the target
    out. Of equal payloads of at least ``least_bytes`` bytes the one with the smallest page_id is written
    in full, the others as revisits without payload. Each attempt of a task writes files of its own
    name, and only those in the returned table count, so failed and repeated attempts leave no records.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    whole = pages.select("page_id", "url", payload.alias("_payload"))
    known = revisits(whole, least_bytes)
    joined = whole.withColumn("_digest", F.sha1("_payload")).join(
        known.select(F.col("page_id").alias("_page"), F.col("digest").alias("_d"), "refers_to"),
        F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("_digest") == F.col("_d")), "left",
    ).select(
        F.col("page_id").cast("string").alias("page"), "url", F.col("refers_to").cast("string").alias("refers"),
        F.when(F.col("refers_to").isNull(), F.col("_payload")).alias("payload"),
        F.octet_length("_payload").cast("bigint").alias("size"), F.unhex("_digest").alias("digest"),
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        attempt, number, out, held, count = uuid.uuid4().hex, 0, None, 0, 0

        def done():
            out.close()
            return pd.DataFrame({"path": [name], "bytes": [held], "records": [count]})

        for batch in batches:
            for row in batch.itertuples(index=False):
                if out is None:
                    name = f"{folder}/part-{TaskContext.get().partitionId():05d}-{attempt}-{number:04d}.warc.gz"
                    out, held, count, number = system.open_output_stream(_open(name)[1], compression=None), 0, 0, number + 1
                    info = gzip.compress(_record({"WARC-Type": "warcinfo"}, b"software: scoreloom\r\n"), mtime=0)
                    out.write(info)
                    held += len(info)
                data = gzip.compress(_page_record(row), mtime=0)
                out.write(data)
                held, count = held + len(data), count + 1
                if held >= file_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return stored(joined.mapInPandas(write, MANIFEST), "warc_files")


def _record(fields: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return f"WARC/1.1\r\n{head}WARC-Date: {DATE}\r\nContent-Length: {len(block)}\r\n\r\n".encode() + block + END


def _page_record(row) -> bytes:
    given = lambda x: isinstance(x, str)
    fields = {
        "WARC-Type": "revisit" if given(row.refers) else "response",
        "WARC-Record-ID": f"<{RECORD_URN}{row.page if given(row.page) else ''}>",
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(row.digest).decode(),
        "Content-Type": "application/http; msgtype=response",
    }
    if given(row.url):
        fields["WARC-Target-URI"] = urllib.parse.quote(row.url, safe=":/?#[]@!$&'()*+,;=%~")
    if given(row.refers):
        fields |= {"WARC-Refers-To": f"<{RECORD_URN}{row.refers}>", "WARC-Profile": PROFILE}
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row.size}\r\n\r\n".encode()
    return _record(fields, http + (b"" if given(row.refers) else row.payload))


def warc_files(spark, paths: str) -> DataFrame:
    """path and bytes of the archives below a path or pattern; their content is not read."""
    return spark.read.format("binaryFile").load(paths).select("path", F.col("length").alias("bytes"))


def read_warc(files: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = False) -> DataFrame:
    """All response and revisit records of the archives in ``files`` (path, bytes).

    Every task takes byte ranges of files. In a range it looks for the gzip magic, decodes the head of
    the candidate and takes it for a record only if that is a WARC head; the record belongs to the range
    in which its first byte lies, and is read to its end beyond the range. Then the search goes on behind
    the record, so bytes inside of records are not searched. One record at a time is in memory. The
    archives must be in a store that PyArrow can open.

    payload_bytes and payload_digest are of the full payload, also for revisits; ``intact`` tells whether
    the digest of the payload read is the recorded one (null for revisits).
    """
    ranges = files.where(F.col("bytes") > 0).select(
        "path", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(split_bytes))).alias("start")
    )
    tasks = files.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"]):
                rows, held = [], 0
                for data in members(path, int(start), int(start) + split_bytes):
                    row = _parsed(data, with_payload)
                    if row is not None:
                        rows.append(row)
                        held += len(data) if with_payload else 200
                    if held > (16 << 20):
                        yield _frame(rows)
                        rows, held = [], 0
                if rows:
                    yield _frame(rows)

    dealt = ranges.repartition(min(int(tasks), 100_000), "path", "start")
    found = dealt.mapInPandas(read, RECORDS)
    return found if with_payload else found.drop("payload")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORDS.split(", ")])
    return frame.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64", "intact": "boolean"})


def members(path: str, start: int, end: int) -> Iterator[bytes]:
    """Decoded gzip members with a WARC head whose first byte lies in [start, end)."""
    system, name = _open(path)
    with system.open_input_file(name) as file:
        size, at = file.size(), start
        window, base = b"", start
        while at < min(end, size):
            if not base <= at < base + len(window) - len(MAGIC) or not window:
                base, window = at, file.read_at(min(BLOCK, size - at), at)
            hit = window.find(MAGIC, at - base)
            if hit < 0:  # the last bytes may begin a magic
                if base + len(window) >= size:
                    return
                at = base + max(1, len(window) - len(MAGIC) + 1)
                window = b""
                continue
            at = base + hit
            if at >= end:
                return
            data, behind = _member(file, at, size)
            if data is None:
                at += 1
            else:
                yield data
                at = behind


def _member(file, at: int, size: int) -> tuple[bytes | None, int]:
    """The member at a position and the position behind it; None where no WARC record begins.

    The first bytes tell whether it may be a record; a head may be as long as it likes, but must end within the member.
    """
    decoder, out, read, checked = zlib.decompressobj(31), [], at, False
    held = 0
    try:
        while not decoder.eof:
            block = file.read_at(min(BLOCK if checked else 1 << 14, size - read), read)
            if not block:
                return None, at  # cut off
            read += len(block)
            out.append(decoder.decompress(block))
            held += len(out[-1])
            if not checked and (held >= 7 or decoder.eof):
                if not b"".join(out).startswith(b"WARC/1."):
                    return None, at
                checked = True
    except zlib.error:
        return None, at
    data = b"".join(out)
    return (data, read - len(decoder.unused_data)) if END in data else (None, at)


def _parsed(data: bytes, with_payload: bool) -> tuple | None:
    head, _, rest = data.partition(END)
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        key, _, value = line.decode("utf-8", "replace").partition(":")
        fields[key.strip().lower()] = value.strip()
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(END)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    if kind == "response":
        count, intact = len(payload), None if digest is None else sha1_base32(payload) == digest
        digest = sha1_base32(payload)
    else:
        count, intact = int(length[1]) if length else None, None
    number = lambda x: int(m[1]) if (m := re.fullmatch(rf"<?{RECORD_URN}(-?\d+)>?", x or "")) else None
    return (
        number(fields.get("warc-record-id")), kind, fields.get("warc-target-uri"), count, digest,
        number(fields.get("warc-refers-to")), intact, payload if with_payload and kind == "response" else None,
    )


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write all pages as archives in the shared folder and read their records back."""
    files = write_warc(pages, fresh_path(pages.sparkSession, "warc"), least_bytes)
    return read_warc(files)
