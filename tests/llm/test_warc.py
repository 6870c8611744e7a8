import base64
import gzip
import hashlib
import io
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from footfall.llm import queries, warc

ROWS = [
    (None, None, None), (1, "http://a/", ""), (2, "http://b/\r\nX: y", "same page"), (3, "http://c/", "same page"),
    (3, "http://c/", "same page"), (-4, "u", "same page"), (5, "é", "ü😀" * 1000), (7, "z", "\r\n\r\nWARC/1.1\r\n\r\n"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, "page_id long, url string, html string")


@pytest.mark.parametrize("split", [1 << 20, 700, 64, 1])
def test_records_whatever_the_splits(pages, split):
    found = warc.read(warc.write(pages), split).collect()
    assert len(found) == len(ROWS)
    first = {}
    for i, _, text in ROWS:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    expected = sorted(
        (str(i), len((t or "").encode()), base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode(),
         first[t or ""] if i != first[t or ""] else None) for i, _, t in ROWS)
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.refers_to) for r in found)
    assert got == expected
    assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in found)
    texts = {r.page_id: bytes(r.payload).decode() for r in found if r.record_type == "response" and r.page_id is not None}
    assert texts[5] == "ü😀" * 1000 and texts[7] == ROWS[-1][2]


def test_files_are_plain_gzip(pages):
    row = warc.write(pages).first()
    data = gzip.open(row.path.removeprefix("file:")).read()
    assert data.startswith(b"WARC/1.1\r\n") and os.path.getsize(row.path) == row["size"]


def test_small_payloads_are_not_revisited(pages):
    found = warc.read(warc.write(pages, min_revisit_bytes=5)).collect()
    assert {r.record_type for r in found if not r.payload_bytes} == {"response"}
    assert sum(r.record_type == "revisit" for r in found) == 3


def test_an_archive_inside_a_page_and_noise():
    inner = warc.member(1, "a", b"x" * 50, None, False)
    data = os.urandom(500) + b"\x1f\x8b\x08" + os.urandom(50) + inner + warc.member(2, "b", os.urandom(3000) + inner, None, False)
    found = [warc.parsed(r)[0] for r in warc.Members(io.BytesIO(data), len(data), 0, len(data))]
    assert found == [1, 2]


class Counting(io.BytesIO):
    read_bytes = 0

    def read(self, n=-1):
        data = super().read(n)
        self.read_bytes += len(data)
        return data


def stored(member):
    press = zlib.compressobj(0, zlib.DEFLATED, 31)
    return press.compress(gzip.decompress(member)) + press.flush()


def stored_inside(count):
    """A file whose second member holds whole members as they are, and where its members start."""
    noise = random.Random(4).randbytes
    inner = b"".join(warc.member(90 + i, "inner", noise(300), None, False) for i in range(count))
    members = [warc.member(1, "a", noise(5000), None, False),
               stored(warc.member(2, "b", noise(200_000) + inner + noise(200_000), None, False)),
               *(warc.member(i, "c", noise(700), None, False) for i in range(3, 60))]
    data = b"".join(members)
    assert inner in data
    return data, [sum(map(len, members[:i])) for i in range(len(members))]


def ids(data, split, starts=None, kind=io.BytesIO):
    found, total = [], 0
    for start in range(0, len(data), split):
        stop, handle = min(start + split, len(data)), kind(data)
        first = None if starts is None else next((s for s in starts if start <= s < stop), len(data))
        found += [warc.parsed(r)[0] for r in warc.Members(handle, len(data), start, stop, first)]
        total = max(total, getattr(handle, "read_bytes", 0))
    return found, total


@pytest.mark.parametrize("split", [1 << 30, 100_000, 30_000, 5_000, 997])
def test_members_stored_inside_a_payload_are_no_records(split):
    for count in (1, 3):
        data, starts = stored_inside(count)
        assert ids(data, split, starts)[0] == list(range(1, 60))
    assert ids(stored_inside(1)[0], split)[0] == list(range(1, 60))   # without the starts: members follow one another


def test_a_range_is_read_once():
    data = b"".join(warc.member(i, "u", random.Random(i).randbytes(300), None, False) for i in range(20_000))
    split = len(data) // 3
    for starts in (None, [0, *(m for m in range(1, len(data)) if data.startswith(warc.MAGIC, m))]):
        found, most = ids(data, split, starts, Counting)
        assert found == list(range(20_000)) and most < 1.1 * split


def test_a_cut_and_a_damaged_file():
    members = [warc.member(i, "u", random.Random(i).randbytes(300), None, False) for i in range(40)]
    whole = b"".join(members)
    for split in (1 << 30, 4000):
        assert ids(whole[:-50], split)[0] == list(range(39))
    damaged = b"".join([*members[:10], b"\0" * 100, *members[10:]])
    assert ids(damaged, 1 << 30)[0] == list(range(40))


def test_long_payload_in_splits(spark):
    noise = base64.b85encode(random.Random(1).randbytes(3 << 20)).decode()
    rows = spark.createDataFrame([(1, "a", noise), (2, "b", "short"), (3, "c", noise)], "page_id long, url string, html string")
    manifest = warc.write(rows.coalesce(1))
    for archives in (manifest, manifest.drop("starts")):
        found = {r.page_id: r for r in warc.read(archives, 500_000).collect()}
        assert sorted(found) == [1, 2, 3] and bytes(found[1].payload).decode() == noise and found[3].refers_to == 1


def test_partitions_are_bounded(pages):
    many = warc.splits(warc.write(pages), 10, most=7)
    assert many.count() > 50 and many.rdd.getNumPartitions() == 7


def test_no_pages(pages):
    assert warc.read(warc.write(pages.limit(0))).count() == 0


def test_query(spark):
    found = queries.op6_warc(spark, "/root/testdata/sf0.001")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    first = {}
    for r in pages.collect():
        first[r.html or ""] = min(r.page_id, first.get(r.html or "", r.page_id))
    assert sorted(map(tuple, found.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.coalesce("refers_to", F.lit(-1))).collect())) == sorted(
        (r.page_id, len(data := (r.html or "").encode()), base64.b32encode(hashlib.sha1(data).digest()).decode(),
         *(("response", -1) if (at := first[r.html or ""]) == r.page_id else ("revisit", at))) for r in pages.collect())
