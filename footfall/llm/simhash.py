"""Document fingerprints by SimHash, and a search within a Hamming radius.

A text's terms are its pairs of neighbouring words (A-Z lower-cased; a lone word is one term), each weighted by 1 plus the
binary logarithm, rounded down, of how often it occurs.  Every term's 64-bit hash votes with its weight on each
bit, and the sign of the sum is the fingerprint's bit.  The likeness of two fingerprints is the share of equal bits.

Search.  64 bits are cut in ``BLOCKS`` blocks.  Fingerprints within ``RADIUS`` bits differ in that many
blocks at most, so they agree in some choice of the others: there is a table per choice, keyed by the bits of
its blocks, and two fingerprints within the radius meet in one table at least.  Equal fingerprints are one entry with a count.

Edge cases.  Null text is empty; a text without words has the fingerprint 0.  Equal texts have
equal fingerprints.  Ids may be null (first in order) or repeated (in the order of a hash of their texts).  One row alone is its own next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.blocks import GOLDEN, Words, in_blocks, mixed
from footfall.runtime import stored

BITS, BLOCKS, RADIUS = 64, 6, 3
BLOCK_BYTES = 2 << 20
U = np.uint64


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    words = Words(texts)
    hashes = words.hashes()[words.ids] if len(words.ids) else np.empty(0, U)
    pairs = mixed(hashes[:-1] * GOLDEN + hashes[1:]) if len(hashes) > 1 else np.empty(0, U)
    out = np.zeros(len(texts), U)
    last = 0
    for i, end in enumerate(words.ends.tolist()):
        if end - last > 1:
            out[i] = vote(np.sort(pairs[last:end - 1]))
        elif end > last:
            out[i] = vote(mixed(hashes[last:end]))
        last = end
    return out


def vote(terms: np.ndarray, chunk: int = 1 << 16) -> np.uint64:
    """The bits that more than half of the weighted terms have set; equal terms stand together."""
    starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
    counts = np.diff(np.append(starts, len(terms)))
    weight = np.frexp(counts)[1]                    # 1 + floor(log2(count))
    ballots = np.repeat(terms[starts], weight)
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(ballots), chunk):
        part = ballots[at:at + chunk]
        total += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return np.packbits(total * 2 > len(ballots), bitorder="little").view(U)[0]


def likeness(a: str | Column, b: str | Column) -> Column:
    """The share of equal bits, 0 to 1."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_hex(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def edited(text: str, following: str) -> str:
    """The text with its last half (rounded down) replaced by as many first code points of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compared(ids: pa.Array, texts: list[bytes], following: list[bytes]) -> list[pa.Array]:
    own = [t.decode() for t in texts]
    changed = [edited(t, f.decode()).encode() for t, f in zip(own, following)]
    return [ids, pa.array(np.fromiter(map(len, own), np.int64, len(own))),
            pa.array([hashlib.sha256(t).hexdigest() for t in changed]),
            *(pa.array(fingerprints(x).view(np.int64)) for x in (texts, changed, following))]


RESULT = ["id", "n_chars", "edited_sha256", "fingerprint", "edited", "next"]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each row of a sorted partition with the one after it.

    The first row's text and the last row, whose next is in another partition, go out as they are.
    """
    part, held, held_id = TaskContext.get().partitionId(), None, None

    def ends(kind: int, row_id: pa.Array, text: bytes) -> pa.RecordBatch:
        blank = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())]
        return pa.RecordBatch.from_arrays(
            [pa.array([kind], pa.int32()), pa.array([part], pa.int32()), row_id, *blank,
             pa.array([text.decode()], pa.string())], ["kind", "part", *RESULT, "text"])

    for rows, texts in in_blocks(batches, "text", BLOCK_BYTES):
        if held is None:
            yield ends(1, rows.column(0).slice(0, 1), texts[0])
            before_ids, before = rows.column(0).slice(0, len(texts) - 1), texts[:-1]
            following = texts[1:]
        else:
            before_ids = pa.concat_arrays([held_id, rows.column(0).slice(0, len(texts) - 1)])
            before, following = [held, *texts[:-1]], texts
        held, held_id = texts[-1], rows.column(0).slice(len(texts) - 1, 1)
        if before:
            n = len(before)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, part, np.int32)),
                 *_compared(before_ids, before, following), pa.nulls(n, pa.string())],
                ["kind", "part", *RESULT, "text"])
    if held is not None:
        yield ends(2, held_id, held)


def with_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's id, n_chars, edited_sha256, and the fingerprints of its text, of that text edited, and of the next.

    The next row is that with the next id; the first one follows the last.  Rows are sorted into ranges, and each
    range is read once, in order; only one text of each end of a range is passed on to the range before.
    """
    given = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = dict(given.dtypes)["id"]
    columns = f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint bigint, edited bigint, next bigint"
    tie = F.xxhash64("text")   # texts themselves are no bounds of ranges: those pass through the driver
    rows = stored(given.repartitionByRange("id", tie).sortWithinPartitions("id", tie, "text").mapInArrow(
        _in_order, f"kind int, part int, {columns}, text string"), "simhash")
    heads, tails = rows.where("kind = 1"), rows.where("kind = 2")
    order = heads.select("part", F.coalesce(
        F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())).alias("next_part"))
    pairs = (tails.select("part", "id", "text").join(order, "part")
             .join(heads.select(F.col("part").alias("next_part"), F.col("text").alias("following")), "next_part"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in in_blocks(batches, "text", BLOCK_BYTES):
            following = [t.encode() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(_compared(batch.column(0), texts, following), RESULT)

    last = pairs.select("id", "text", "following").mapInArrow(compare, columns)
    return rows.where("kind = 0").select(*RESULT).union(last).withColumnRenamed("id", id_col)


def masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """For each choice of ``blocks - radius`` blocks, the bits of those blocks, as signed numbers."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    bits = [(1 << high) - (1 << low) for low, high in zip(edges, edges[1:])]
    found = [sum(choice) for choice in combinations(bits, blocks - radius)]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in found]


def links(queries: DataFrame, all_rows: DataFrame, blocks: int = BLOCKS, radius: int = RADIUS) -> DataFrame:
    """All pairs (asked, fingerprint, bits, n) of distinct fingerprints of both sides within ``radius`` bits.

    ``bits`` says how many differ and ``n`` how many rows of ``all_rows`` have that fingerprint; which rows these are, the rows say.
    """
    def table(rows: DataFrame, name: str) -> DataFrame:
        keys = F.array(*[F.col(name).bitwiseAND(F.lit(m)) for m in masks(blocks, radius)])
        return rows.select("*", F.posexplode(keys).alias("table", "key"))

    asked = table(queries.select(F.col("fingerprint").alias("asked")).distinct(), "asked")
    there = table(all_rows.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")), "fingerprint")
    near = F.bit_count(F.col("asked").bitwiseXOR(F.col("fingerprint"))) <= radius
    pairs = asked.join(there, ["table", "key"]).where(near).select("asked", "fingerprint", "n").distinct()
    return pairs.select("asked", "fingerprint", F.bit_count(F.col("asked").bitwiseXOR(F.col("fingerprint"))).alias("bits"), "n")


def neighbours(queries: DataFrame, all_rows: DataFrame, blocks: int = BLOCKS, radius: int = RADIUS) -> DataFrame:
    """For each distinct fingerprint of ``queries``: how many rows of ``all_rows`` are within ``radius`` bits of it."""
    pairs = links(queries, all_rows, blocks, radius)
    return pairs.groupBy(F.col("asked").alias("fingerprint")).agg(F.sum("n").alias("n_near"))
