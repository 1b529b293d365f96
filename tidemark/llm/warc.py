"""WARC archives written and read by tasks (operator 11).

Archives are gzip files with one member a record. The reader splits them: a task gets a
range of bytes, looks for the gzip magic in it, takes a candidate for a record if its member
decodes to a whole WARC record, and owns the records that start inside its range, also where
they end beyond it. So one archive may be larger than any task.

Tasks open archives through ``pyarrow.fs``: local and shared folders, HDFS and object stores.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import column, written
from tidemark.session import scratch_path

#: Payloads from this many bytes on are stored once; of equal ones the others refer to it.
REVISIT_FROM = 1000
#: Bytes of an archive that a task scans, after which a writer begins another one, and read at once.
SPLIT, FILE_BYTES, CHUNK = 64 << 20, 1 << 30, 1 << 20
MAGIC = b"\x1f\x8b\x08"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A record's own headers are no longer than this.
HEAD = 1 << 16


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it. Spark writes local paths with one slash."""
    system, inner = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path) if path.startswith("file:") else path)
    return system, inner


# --- writing ----------------------------------------------------------------


def record_id(page: object) -> str:
    return "<urn:page>" if page is None else f"<urn:page:{quote(str(page), safe='')}>"


def page_of(name: str | None) -> str | None:
    """The page that a record id is of, as text."""
    match = re.fullmatch("<urn:page:(.*)>", name or "", re.DOTALL)
    return unquote(match[1]) if match else None


def _safe(value: str) -> str:
    """A header value in one line: control characters and blanks at an end are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]|^ +| +$", lambda m: quote(m[0], safe=""), value)


def member(kind: str, headers: list[tuple[str, str]], block: bytes, date: str, level: int = 6) -> bytes:
    """A record as a gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {date}", *[f"{k}: {_safe(v)}" for k, v in headers]]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode()
    packer = zlib.compressobj(level, wbits=31)
    return packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def page_record(page: object, url: str | None, payload: bytes, sha1: str, original: object, revisit: bool, date: str) -> bytes:
    """A page as a response, or as a revisit of the response that has its payload."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    headers = [("WARC-Record-ID", record_id(page))]
    headers += [("WARC-Target-URI", url)] if url is not None else []
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if revisit:
        headers += [("WARC-Refers-To", record_id(original)), ("WARC-Profile", PROFILE)]
        return member("revisit", headers, block, date)
    return member("response", headers, block + payload, date)


class _Archives:
    """The files a task writes. Their names hold the attempt, so a task that runs again disturbs none."""

    def __init__(self, folder: str, date: str, limit: int) -> None:
        context = TaskContext.get()
        self.folder, self.date, self.limit = folder, date, limit
        self.stem = f"{folder}/part-{context.partitionId():05d}-{context.taskAttemptId()}"
        self.system, _ = opened(folder)
        self.out, self.done, self.path, self.size, self.records = None, [], "", 0, 0

    def add(self, record: bytes) -> None:
        if self.out is not None and self.size >= self.limit:
            self.close()
        if self.out is None:
            self.path = f"{self.stem}-{len(self.done):03d}.warc.gz"
            self.system.create_dir(opened(self.folder)[1], recursive=True)
            self.out = self.system.open_output_stream(opened(self.path)[1], compression=None)
            about = member("warcinfo", [("Content-Type", "application/warc-fields")], b"software: tidemark\r\n", self.date)
            self.out.write(about)
            self.size, self.records = len(about), 1
        self.out.write(record)
        self.size += len(record)
        self.records += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.path, self.size, self.records))
            self.out = None


def archive(
    pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    date: str = DATE, revisit_from: int = REVISIT_FROM, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write a record per page and return the files: path, bytes, records.

    The payload is the html in UTF-8 (null: empty). Of equal payloads of at least
    ``revisit_from`` bytes the page with the largest id is a response and the others revisit
    it; rows that share that id are all responses, and a null id is less than any other. A
    null url is left out. Files that only a failed attempt wrote aren't returned. An empty
    table gives no files; other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    payload = F.coalesce(column(html_col), F.lit("")).cast("binary")
    source = pages.select(column(id_col).alias("page"), column(url_col).alias("url"), payload.alias("payload"))
    keyed = source.withColumn("key", F.when(F.octet_length("payload") >= revisit_from, F.unhex(F.sha2("payload", 256))))
    # One row for each payload that occurs again; stored, so that adaptive execution can split a hot one in the join.
    groups = keyed.filter("key IS NOT NULL").groupBy("key").agg(F.max("page").alias("original"), F.count(F.lit(1)).alias("n"))
    groups = written(groups.filter("n > 1").select("key", "original", F.lit(True).alias("again")), "payloads")
    revisit = F.coalesce(F.col("again"), F.lit(False)) & ~F.col("page").eqNullSafe(F.col("original"))
    rows = keyed.join(groups, "key", "left").select(
        "page", "url", "payload", F.sha1("payload").alias("sha1"), "original", revisit.alias("revisit")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Archives(folder, date, file_bytes)
        for batch in batches:
            for page, url, data, sha1, original, again in zip(*batch.columns):
                files.add(
                    page_record(
                        page.as_py(), url.as_py(), data.as_py(), sha1.as_py(), original.as_py(), again.as_py(), date
                    )
                )
        files.close()
        paths, sizes, counts = zip(*files.done) if files.done else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(paths, pa.string()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
            names=["path", "bytes", "records"],
        )

    return written(rows.mapInArrow(run, "path string, bytes long, records long"), "archives")


# --- reading ----------------------------------------------------------------


class Source:
    """Bytes of an open file by place, read in chunks."""

    def __init__(self, file, size: int) -> None:
        self.file, self.size = file, size
        self.base, self.data = 0, b""

    def load(self, place: int) -> int:
        """Hold what begins at or before this place, and return the place's index in it."""
        if not self.base <= place < self.base + len(self.data):
            self.file.seek(place)
            self.base, self.data = place, self.file.read(CHUNK)
        return place - self.base

    def find(self, place: int, end: int) -> int | None:
        """The first gzip magic that starts from this place on and before the end."""
        while place < end:
            at = self.load(place)
            found = self.data.find(MAGIC, at)
            if found >= 0:
                return self.base + found if self.base + found < end else None
            held = self.base + len(self.data)
            if held >= self.size:
                return None
            # The magic may begin in the last two bytes.
            place = max(place + 1, held - len(MAGIC) + 1)
            if place < held:
                self.file.seek(place)
                self.base, self.data = place, self.file.read(CHUNK)
        return None


def _headers(lines: bytes) -> dict[str, str]:
    found = {}
    for line in lines.decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    return found


def record_at(source: Source, place: int) -> tuple[dict[str, str], bytes, int] | None:
    """Headers, block and end of the record whose member starts here; None if none does."""
    unpacker, out, at, head, due = zlib.decompressobj(wbits=31), bytearray(), place, None, None
    while not unpacker.eof:
        if at >= source.size:
            return None
        i = source.load(at)
        piece = source.data[i : i + (1 << 14)]
        try:
            out += unpacker.decompress(piece)
        except zlib.error:
            return None
        at += len(piece) - len(unpacker.unused_data)
        if head is None:
            if not b"WARC/1.".startswith(bytes(out[:7])):
                return None
            stop = out.find(b"\r\n\r\n", 0, HEAD)
            if stop < 0:
                if len(out) >= HEAD:
                    return None
                continue
            head = _headers(bytes(out[:stop]))
            if not head.get("content-length", "").isdecimal():
                return None
            due = stop + 4, stop + 4 + int(head["content-length"])
        if len(out) > due[1] + 4:
            return None
    if head is None or out[due[1] :] != b"\r\n\r\n":
        return None
    return head, bytes(memoryview(out)[due[0] : due[1]]), at


def records_of(source: Source, start: int, end: int) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Place, end, headers and block of the records that start in this range."""
    place = start
    while (place := source.find(place, end)) is not None:
        record = record_at(source, place)
        if record is None:
            place += 1
            continue
        head, block, after = record
        yield place, after, head, block
        place = after


def _digest(value: str | None) -> str | None:
    """The hexadecimal form of a SHA-1 header value."""
    name, _, text = (value or "").partition(":")
    if name.lower() != "sha1":
        return None
    try:
        return base64.b32decode(text.upper()).hex() if len(text) == 32 else bytes.fromhex(text).hex()
    except ValueError:
        return None


def _described(head: dict[str, str], block: bytes) -> tuple[str | None, int, bytes]:
    """SHA-1, length and bytes of the payload; of a revisit, whose payload lies elsewhere, as its headers say."""
    own, _, payload = block.partition(b"\r\n\r\n") if "application/http" in head.get("content-type", "") else (b"", b"", block)
    if head.get("warc-type") == "revisit":
        length = _headers(own).get("content-length", "")
        return _digest(head.get("warc-payload-digest")), int(length) if length.isdecimal() else 0, b""
    return hashlib.sha1(payload).hexdigest(), len(payload), payload


def listed(spark: SparkSession, path: str) -> DataFrame:
    """The archives of a folder or glob: path, bytes."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path)
    return found.select("path", F.col("length").alias("bytes"))


_RECORD = (
    "path string, split long, place long, `end` long, type string, page string, refers_to string, url string, date string, "
    "payload_bytes long, payload_digest string, sound boolean, payload binary"
)


def records(files: DataFrame, split: int = SPLIT, content: bool = True) -> DataFrame:
    """The records of archives (path, bytes), read by ranges of ``split`` bytes.

    path, split, place, end (bytes in the archive), type, page and refers_to (page ids as
    text), url, date, payload_bytes, payload_digest (SHA-1), sound (false if the header names
    another digest), payload (null without ``content``). No files give no rows. A record that
    lies inside a raw payload and starts in another range is found too: see ``outermost``.
    """
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split).cast("long"))
    ranges = files.select("path", "bytes", F.explode(starts).alias("split"))
    tasks = ranges.agg(F.count(F.lit(1))).first()[0]
    kinds = pa.schema(
        [("path", pa.string()), ("split", pa.int64()), ("place", pa.int64()), ("end", pa.int64())]
        + [(c, pa.string()) for c in ("type", "page", "refers_to", "url", "date")]
        + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("sound", pa.bool_()), ("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                system, inner = opened(path)
                with system.open_input_file(inner) as file:
                    for place, end, head, block in records_of(Source(file, size), start, min(start + split, size)):
                        digest, length, payload = _described(head, block)
                        named = _digest(head.get("warc-payload-digest"))
                        rows.append(
                            (
                                path, start, place, end, head.get("warc-type"), page_of(head.get("warc-record-id")),
                                page_of(head.get("warc-refers-to")), head.get("warc-target-uri"), head.get("warc-date"),
                                length, digest, named is None or named == digest, payload if content else None,
                            )
                        )
                        held += len(payload) * content + 500
                        if held > 4 * CHUNK:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.types)], schema=kinds)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.types)], schema=kinds)

    return ranges.repartition(max(1, min(tasks, 100_000))).mapInArrow(run, _RECORD)


def outermost(found: DataFrame) -> DataFrame:
    """Records without those that lie inside the payload of one that began in an earlier range.

    Give it a stored table, as it reads it twice. One row a range tells how far its records reach.
    """
    reach = found.groupBy("path", "split").agg(F.max("end").alias("reach"))
    before = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    reach = reach.withColumn("reach", F.max("reach").over(before)).filter(F.col("reach") > F.col("split"))
    inside = F.coalesce(F.col("place") < F.col("reach"), F.lit(False))
    return found.join(reach, ["path", "split"], "left").filter(~inside).drop("reach")
