"""WARC archives: a writer with payload de-duplication and a splittable reader.

Writing. Each record is a gzip member of its own. Of pages with equal payloads of at least
``min_bytes``, that with the smallest id becomes the response and the others revisits that refer to
it; a revisit keeps the HTTP header (with the payload's length) and the payload digest, not the
payload. Only pages that a repeat filter (see ``exact_dedup``) finds possibly repeated are shuffled.
Every task writes its own archives under a temporary name and moves them into place, so a repeated
or speculative task leaves the same files; only files named by the returned manifest count.

Reading. An archive is cut into byte ranges. A task seeks to its range, looks for the gzip magic,
and accepts a candidate only if it decodes to a WARC header; from there it goes member by member. It
owns the records that start inside its range, and reads past the end to finish the last one. Bytes
that look like a member inside compressed data fail to decode to a WARC header, and stored (not
compressed) UTF-8 text cannot contain the magic. A damaged member with a sound header is an error.

Files are opened with ``pyarrow.fs``, so the folder may be on any store it knows (local, HDFS, S3).
Defined cases: null html is an empty payload; a null url is left out; a null page id is written as
``none``, comes last among equal payloads, and reads back as null; ids keep their type,
text percent-encoded in the archive; rows that repeat both id and
payload of the response are responses too; extra columns are ignored; no rows give no archives and an
empty result. Memory in a task is bounded by its largest record.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditmart.llm.common import whole_text
from creditmart.llm.exact_dedup import filter_bits, flag_repeats, repeat_filter
from creditmart.sources.stage import stage, stage_folder

MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 20
BATCH_BYTES = 1 << 24
MAX_TASKS = 100_000  # beyond that a task reads several ranges
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = re.compile(rb"<urn:page:([^>]*)>")


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record(page: str, url: str | None, payload: bytes, digest: str, length: int, refers_to: str | None, date: str) -> bytes:
    """One WARC record, not compressed."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        payload = b""
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block) + len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + payload + b"\r\n\r\n"


def id_text(id_: Column, kind: T.DataType) -> Column:
    """A page id as written: numbers as they are, any other text percent-encoded after ``=``; null is ``none``."""
    text = id_.cast("string") if isinstance(kind, T.IntegralType) else F.concat(F.lit("="), F.url_encode(id_.cast("string")))
    return F.coalesce(text, F.lit("none"))


def id_of(text: Column, kind: T.DataType) -> Column:
    """The page id, in its own type, of what :func:`id_text` wrote."""
    found = text if isinstance(kind, T.IntegralType) else F.url_decode(F.substring(text, 2, 1 << 30))
    return F.when(text != "none", found).cast(kind)


def archive_writer(folder: str, archive_bytes: int, date: str, level: int) -> Callable:
    """For mapInPandas over (page, url, html, digest, length, refers_to): writes archives, yields a row for each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        done, out, name, size, count = [], None, "", 0, 0

        def finish() -> None:
            out.close()
            store.move(f"{root}/_{name}.{task.taskAttemptId()}", f"{root}/{name}")
            done.append((posixpath.join(folder, name), count, size))

        for batch in batches:
            for page, url, html, digest, length, refers_to in batch.itertuples(index=False, name=None):
                if out is None:
                    name, size, count = f"part-{task.partitionId():05d}-{len(done):05d}.warc.gz", 0, 0
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root}/_{name}.{task.taskAttemptId()}")
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                payload = html.encode() if refers_to is None else b""
                member = packer.compress(record(page, url, payload, base32(bytes.fromhex(digest)), length, refers_to, date)) + packer.flush()
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= archive_bytes:
                    finish()
                    out = None
        if out is not None:
            finish()
        yield pd.DataFrame(done, columns=["path", "records", "bytes"])

    return run


def write_warc(
    pages: DataFrame, folder: str, min_bytes: int = 0, key: str = "page_id", url: str = "url", html: str = "html",
    archive_bytes: int = 1 << 28, date: str = DATE, level: int = 6,
) -> DataFrame:
    """Write the pages; the manifest ``path, records, bytes`` of the archives."""
    kind = pages.schema[key].dataType
    bare = pages.select(
        F.col(f"`{key}`").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), whole_text(html).alias("html"),
        F.sha1(whole_text(html)).alias("digest"), F.octet_length(whole_text(html)).cast("long").alias("length"),
    )
    digests = stage(bare.select("digest", "id", "length"), "warc-digests")
    bits = filter_bits(digests.count())
    bitmaps = stage(repeat_filter(digests, "digest", bits), "warc-filter")
    large = F.col("length") >= min_bytes
    order = F.struct(F.col("id").isNull().alias("a"), F.col("id").alias("b"))
    firsts = stage(
        flag_repeats(digests, "digest", bitmaps, bits, "maybe").filter(F.col("maybe") & large)
        .groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
        .select(F.col("digest").alias("first_digest"), id_text(F.col("first.b"), kind).alias("first")),
        "warc-firsts",
    )
    page = id_text(F.col("id"), kind).alias("page")
    flagged = flag_repeats(bare, "digest", bitmaps, bits, "maybe").withColumn("maybe", F.col("maybe") & large)
    alone = flagged.filter(~F.col("maybe")).select(page, "url", "html", "digest", "length", F.lit(None).cast("string").alias("refers_to"))
    other = F.col("first") != id_text(F.col("id"), kind)
    repeated = (
        flagged.filter("maybe").join(firsts, F.col("digest") == F.col("first_digest"), "left")
        .select(page, "url", F.when(other, F.lit("")).otherwise(F.col("html")).alias("html"), "digest", "length", F.when(other, F.col("first")).alias("refers_to"))
    )
    return stage(
        alone.unionByName(repeated).mapInPandas(archive_writer(folder, archive_bytes, date, level), "path string, records long, bytes long"),
        "warc-manifest",
    )


class _Window:
    """A file as a growing window of bytes; what lies before the current position is dropped."""

    def __init__(self, file, start: int):
        self.file, self.base, self.data = file, start, b""
        file.seek(start)

    def more(self) -> bool:
        got = self.file.read(CHUNK)
        self.data += got
        return bool(got)

    def drop_before(self, position: int) -> None:
        self.data, self.base = self.data[position - self.base :], position

    def find_magic(self, position: int, end: int) -> int:
        """The first magic at or after a position and before the end, or -1."""
        while True:
            at = self.data.find(MAGIC, position - self.base)
            if at >= 0:
                return self.base + at if self.base + at < end else -1
            position = max(position, self.base + len(self.data) - len(MAGIC) + 1)
            if position >= end:
                return -1
            self.drop_before(position)
            if not self.more():
                return -1

    def is_record(self, position: int) -> bool:
        """Whether the bytes from here decode to a WARC header."""
        while True:
            unpack = zlib.decompressobj(31)
            try:
                head = unpack.decompress(self.data[position - self.base : position - self.base + CHUNK], 8)
            except zlib.error:
                return False
            if len(head) >= 7 or unpack.eof:
                return head.startswith(b"WARC/1.")
            if not self.more():
                return False

    def member(self, position: int) -> tuple[bytes, int]:
        """The decoded member that starts here, and where it ends."""
        unpack, parts, at = zlib.decompressobj(31), [], position
        while True:
            given = self.data[at - self.base :]
            try:
                parts.append(unpack.decompress(given))
            except zlib.error as e:
                raise ValueError(f"damaged WARC member at byte {position}: {e}") from e
            at += len(given) - len(unpack.unused_data)
            if unpack.eof:
                self.drop_before(at)
                return b"".join(parts), at
            self.drop_before(at)
            if not self.more():
                raise ValueError(f"WARC member at byte {position} has no end")


def records_in(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of the records that start in a byte range."""
    window, position = _Window(file, start), start
    while (position := window.find_magic(position, end)) >= 0:
        if window.is_record(position):
            window.drop_before(position)
            offset = position
            data, position = window.member(position)
            yield offset, data
        else:
            position += 1


def parse(data: bytes) -> dict:
    """The fields of a record; the payload is what follows the HTTP header."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")[1:])}
    http, _, payload = rest[: int(fields[b"content-length"])].partition(b"\r\n\r\n")
    length = re.search(rb"(?mi)^content-length:\s*(\d+)", http)
    kind = fields[b"warc-type"].decode()
    digest = fields.get(b"warc-payload-digest", b"").decode().removeprefix("sha1:")
    if kind == "response":
        found = base32(hashlib.sha1(payload).digest())
        if digest and digest != found:
            raise ValueError(f"payload digest {found} differs from the header's {digest}")
        digest = found
    name = lambda k: (m := RECORD.search(fields.get(k, b""))) and m[1].decode()
    return {
        "record_type": kind, "page": name(b"warc-record-id"), "refers_to": name(b"warc-refers-to"), "url": fields.get(b"warc-target-uri", b"").decode() or None,
        "payload_bytes": len(payload) if kind == "response" else int(length[1]) if length else 0, "payload_digest": digest, "payload": payload,
    }


FIELDS = "path string, offset long, record_type string, page string, refers_to string, url string, payload_bytes long, payload_digest string"


def range_reader(with_payload: bool) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        names = [f.split()[0] for f in FIELDS.split(", ")] + ["payload"] * with_payload
        for batch in batches:
            for path, start, end in batch.itertuples(index=False, name=None):
                store, place = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_file(place) as file:
                    for offset, data in records_in(file, start, end):
                        rows.append(parse(data) | {"path": path, "offset": offset})
                        held += len(data)
                        if not with_payload:
                            del rows[-1]["payload"]
                        if held >= BATCH_BYTES:
                            yield pd.DataFrame(rows, columns=names)
                            rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return run


def read_warc(archives: DataFrame, split_bytes: int = 1 << 25, with_payload: bool = True) -> DataFrame:
    """The records of archives (``path, bytes``), one row each; ``page`` and ``refers_to`` are the ids as text."""
    starts = archives.filter("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = starts.select("path", "start", F.least(F.col("start") + split_bytes, F.col("bytes")).alias("end"))
    # A stated number, because adaptive execution would merge such small rows into one task.
    count = ranges.count()
    spread = ranges.repartition(max(1, min(count, MAX_TASKS)))
    return spread.mapInPandas(range_reader(with_payload), FIELDS + (", payload binary" if with_payload else ""))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to a shared folder and read them back: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""
    archives = write_warc(pages, stage_folder(pages.sparkSession, "warc"))
    found, kind = read_warc(archives, with_payload=False), pages.schema["page_id"].dataType
    return found.select(id_of(F.col("page"), kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", id_of(F.col("refers_to"), kind).alias("refers_to"))
