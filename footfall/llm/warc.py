"""WARC archives: write pages as records, and read archives in splits.

Writing.  Each page becomes a record in a gzip member of its own: a response with the whole payload, or, if a
page with a smaller id has the same payload, a revisit that refers to that page's response.  Each task writes a file under a name of its
attempt, and only files that a finished task reports are in the manifest, so lost or repeated tasks leave nothing behind
that is read.

Reading.  A task gets a range of bytes of a file.  It looks for the magic of a gzip member, takes a place for a candidate if
what it holds decodes to the head of a record, and reads members on from the first confirmed one, each byte once.  A record
belongs to the range in which its member starts, so nothing is read twice or left out.  A candidate may lie inside a payload
that deflate stored as it is: archives written here name the starts of their members in the manifest, which confirms
candidates at any size of ranges; in others (a manifest without ``starts``) members have to follow one another out of the range.
Only an archive inside a payload that reaches out of the range can pass that; whoever reads such files gives a range per file.

Edge cases.  A null payload is empty.  A null id has a record id of its own kind; null addresses are left out.  Repeated
rows have equal ids: each is a response if that id is the smallest of its payload.  Payloads of any size and
content are possible, archives inside payloads included.  No pages give no file and no record.  In a damaged file reading
goes on with the next confirmed member; in ranges after a file's first, members before the damage in that range may be lost.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from uuid import UUID

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.blocks import in_blocks
from footfall.runtime import shared_dir, stored

MAGIC, HEAD = b"\x1f\x8b\x08", b"WARC/1."
SPLIT_BYTES, CHUNK, BLOCK_BYTES = 32 << 20, 64 << 10, 4 << 20
MOST_TASKS = 20_000   # beyond it a task reads several ranges, one after the other
NO_ID, ID_BITS = 1 << 127, (1 << 64) - 1
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
          "refers_to bigint, payload binary")


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all machines reach, and the folder's name there."""
    if re.match(r"[a-z0-9+.-]+:", path):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return pafs.LocalFileSystem(), path


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{UUID(int=NO_ID if page_id is None else page_id & ID_BITS)}>"


def page_of(record: str) -> int | None:
    number = UUID(record.strip("<>").removeprefix("urn:uuid:")).int
    if number == NO_ID:
        return None
    return number - (1 << 64) if number >> 63 else number


def sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(page_id: int | None, url: str | None, payload: bytes, first_id: int | None, revisit: bool,
           date: str = DATE) -> bytes:
    """One record as a gzip member."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
             .encode())
    if not revisit:
        block += payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)),
              ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{sha1(payload)}"), ("Content-Length", str(len(block)))]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first_id))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(head.encode() + block + b"\r\n\r\n") + press.flush()


def write(pages: DataFrame, folder: str | None = None, min_revisit_bytes: int = 0, id_col: str = "page_id",
          url: str = "url", html: str = "html", date: str = DATE) -> DataFrame:
    """Write an archive of ``pages`` to a shared folder; returns its manifest (path, size).

    Payloads are equal if their SHA-256 is.  Only what several pages share is joined back.
    """
    folder = folder or shared_dir(pages.sparkSession, "warc")
    given = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url).alias("url"),
                         F.coalesce(F.col(html), F.lit("")).alias("html"))
    key = F.unhex(F.sha2(F.col("html").cast("binary"), 256))
    shared = (given.where(F.octet_length("html") >= min_revisit_bytes).groupBy(key.alias("key"))
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "first_id"))
    rows = given.withColumn("key", key).join(stored(shared, "payloads"), "key", "left").select(
        "page_id", "url", "first_id",
        (F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))).alias("revisit"), "html")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        system, base = file_system(folder)
        system.create_dir(base, recursive=True)
        path = f"{base}/part-{context.partitionId():05d}-{context.taskAttemptId()}.warc.gz"
        out, size, starts = None, 0, []
        for batch, payloads in in_blocks(batches, "html", BLOCK_BYTES):
            out = out or system.open_output_stream(path, compression=None)
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for page_id, address, first_id, revisit, payload in zip(*columns, payloads):
                data = member(page_id, address, payload, first_id, revisit, date)
                out.write(data)
                starts.append(size)
                size += len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()),
                                              pa.array([starts], pa.list_(pa.int64()))], ["path", "size", "starts"])

    return stored(rows.mapInArrow(archive, "path string, size bigint, starts array<bigint>"), "manifest").withColumn(
        "folder", F.lit(folder))


def splits(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, most: int = MOST_TASKS) -> DataFrame:
    """Ranges of bytes (folder, path, size, start, stop, first), dealt evenly to a partition each, to ``most`` at the most.

    ``first`` is where the first member of a range starts if the manifest says where members do; the file's size if none does.
    """
    ranges = manifest.where("size > 0").select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1,
                                                       F.lit(split_bytes).cast("bigint"))).alias("start"))
    ranges = ranges.withColumn("stop", F.least(F.col("start") + split_bytes, "size"))
    first = F.lit(None).cast("bigint")
    if "starts" in manifest.columns:
        inside = F.array_min(F.filter("starts", lambda at: (at >= F.col("start")) & (at < F.col("stop"))))
        first = F.when(F.col("starts").isNotNull(), F.coalesce(inside, "size"))
    ranges = ranges.select("folder", "path", "size", "start", "stop", first.alias("first"))
    return ranges.coalesce(1).repartition(min(most, max(1, ranges.count())))


class Forward:
    """The bytes of a file from a place on, read forward in chunks; those before ``drop`` are let go."""

    def __init__(self, handle, size: int, start: int):
        self.handle, self.size, self.base, self.held, self.end = handle, size, start, bytearray(), start
        handle.seek(start)

    def more(self) -> bool:
        """Read another chunk; False at the end of the file."""
        chunk = self.handle.read(min(CHUNK, self.size - self.end))
        self.held += chunk
        self.end += len(chunk)
        return bool(chunk)

    def find(self, magic: bytes, at: int, stop: int) -> int | None:
        """Where the magic is next found, starting before ``stop``."""
        while True:
            if (found := self.held.find(magic, at - self.base)) >= 0:
                return self.base + found if self.base + found < stop else None
            at = max(at, self.end - len(magic) + 1)
            if at >= stop or not self.more():
                return None

    def drop(self, at: int) -> None:
        gone = min(at, self.end) - self.base
        del self.held[:gone]
        self.base += gone

    def pieces(self, at: int) -> Iterator[bytes]:
        """The bytes from ``at`` on, in pieces that grow up to a chunk."""
        most = 4 << 10
        while at < self.end or self.more():
            piece = bytes(memoryview(self.held)[at - self.base:at - self.base + most])
            yield piece
            at, most = at + len(piece), min(2 * most, CHUNK)


class Members:
    """The gzip members of a file that start in a range of bytes.

    The range is read once, forward.  ``first`` is the first member's start if it is known (the file's size: there is none).
    Else a candidate counts if members follow one another from it until they have left the range, with one more after it or
    the end of the file: so a member inside a payload that deflate has stored as it is does not count.
    Compressed bytes of the range are held until that is known.
    """

    def __init__(self, handle, size: int, start: int, stop: int, first: int | None = None):
        self.bytes, self.size, self.at, self.stop, self.first = Forward(handle, size, start), size, start, stop, first
        self.sure = start == 0 and first is None   # what a file starts with is a member if it decodes
        self.refused: set[int] = set()
        self.cut = False   # whether the last member looked at goes on where the file ends

    def inflated(self, at: int, keep: bool = True) -> tuple[bytes, int] | None:
        """The record whose member starts here (its head only unless ``keep``) and where the member ends, if there is one."""
        press, data, head, end = zlib.decompressobj(31), [], b"", at
        self.cut = False
        try:
            for piece in self.bytes.pieces(at):
                out = press.decompress(piece)
                end += len(piece)
                if len(head) < len(HEAD):
                    head += out[:len(HEAD)]
                    if not head.startswith(HEAD[:len(head)]):
                        return None
                if keep:
                    data.append(out)
                if press.eof:
                    break
        except zlib.error:
            return None
        self.cut = not press.eof and head.startswith(HEAD)
        return (b"".join(data), end - len(press.unused_data)) if press.eof and head.startswith(HEAD) else None

    def confirmed(self, at: int) -> bool:
        """Whether a candidate is a member of the file and not of a payload."""
        if self.first is not None:
            return at == self.first and self.inflated(at, keep=False) is not None
        chain: list[int] = []
        while at < self.size:
            done = bool(chain) and at >= self.stop
            found = None if at in self.refused else self.inflated(at, keep=False)
            if found is None and chain and self.cut:
                return True
            if found is None:
                self.refused.update(chain)   # they all lead here
                return False
            if done:
                return True
            chain.append(at)
            at = found[1]
        return True

    def __iter__(self) -> Iterator[bytes]:
        while self.at < self.stop:
            if not self.sure:
                found = self.bytes.find(MAGIC, self.at, self.stop)
                if found is None:
                    return
                self.at = found
                if not self.confirmed(found):
                    self.at += 1
                    self.bytes.drop(self.at)
                    continue
            record = self.inflated(self.at)
            self.sure = record is not None   # what follows a member is one, unless the file is damaged
            if record is None:
                self.first = None
                continue
            yield record[0]
            self.at = record[1]
            self.bytes.drop(self.at)


def parsed(record: bytes) -> tuple | None:
    """What a response or revisit says: the columns of ``RECORD``; None for other records.

    The digest of a response is that of its payload as read; it has to be what the head says.
    """
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {name.strip().lower(): value.strip() for name, _, value in (
        line.partition(":") for line in head.decode().split("\r\n")[1:])}
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    said = fields["warc-payload-digest"].removeprefix("sha1:")
    page, refers, size = page_of(fields["warc-record-id"]), None, len(payload)
    if kind == "revisit":
        refers, payload = page_of(fields["warc-refers-to"]), None
        size = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
    elif sha1(payload) != said:
        raise ValueError(f"record {fields['warc-record-id']}: its payload does not have the digest that it names")
    return page, fields.get("warc-target-uri"), size, said, kind, refers, payload


def read(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """The records of the archives of a manifest; ``payloads`` says whether to return the payloads too."""
    names = [part.split(" ")[0] for part in RECORD.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], names)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            for split in given.to_pylist():
                system, _ = file_system(split["folder"])
                rows, held = [], 0
                with system.open_input_file(split["path"]) as handle:
                    for record in Members(handle, split["size"], split["start"], split["stop"],
                                          split["first"]):
                        if (row := parsed(record)) is None:
                            continue
                        rows.append(row if payloads else (*row[:-1], None))
                        held += len(record) if payloads else 500
                        if held >= BLOCK_BYTES:
                            yield batch(rows)
                            rows, held = [], 0
                if rows:
                    yield batch(rows)

    return splits(manifest, split_bytes).mapInArrow(records, RECORD)
