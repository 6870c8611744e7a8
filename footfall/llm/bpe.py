"""Byte-level BPE: encode texts by a table of ranks, and decode the ids.

A text is cut into pre-tokens by a pattern; each is encoded by itself, in two tiers.  A minimal
perfect hash over the vocabulary resolves pre-tokens that are entries as a whole, for all distinct
ones of a block at once.  The others are merged byte by byte: a heap holds the neighbouring pairs that
form an entry, lowest rank first, over a doubly linked list, so a pre-token of n bytes costs O(n log n).

The hash is built on the driver from the rank file (its size is that of the vocabulary, a parameter) and
broadcast.  A worker's cache has a fixed size.  Decoding looks up each id's bytes.

Edge cases.  Null and empty texts have no ids.  Special tokens in a text are ordinary text.  Very long
pre-tokens take no quadratic time; a text is held whole, once.  Ids outside the vocabulary raise ValueError in decoding.
Further columns are kept aside and may have any name.
"""

from __future__ import annotations

import array
import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm.blocks import GOLDEN, Numbers, in_blocks, mixed, runs

U = np.uint64
BLOCK = 4 << 20
MISSES, LONGEST = 400_000, 64   # merged pre-tokens that a worker remembers, and bytes of the longest
# White space that the quick way of cutting does not expect: all but a blank or line end after something else.
SPACED = regex.compile(r"\s |^ |[^\S \n]").search
WORKER_ONLY = ("cut", "cache", "rank_of", "packed", "sizes", "starts", "blob")


class PerfectHash:
    """Slots 0..n-1 for n distinct keys, one each: hash and displace, with free slots for lone keys."""

    def __init__(self, keys: list[bytes]):
        n = len(keys)
        self.n, self.buckets = n, max(1, n // 3)
        hashes = self.hashes(keys)
        bucket = (hashes % U(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        starts = np.cumsum(sizes) - sizes
        self.shift = np.zeros(self.buckets, np.int64)
        taken = np.zeros(n, bool)
        for b in np.argsort(-sizes, kind="stable").tolist():
            if sizes[b] < 2:
                break
            mine, shift = hashes[order[starts[b]:starts[b] + sizes[b]]], 0
            while True:
                trial = np.arange(shift, shift + 64, dtype=U)[:, None]
                slots = np.sort((mixed(mine[None, :] ^ (trial * GOLDEN)) % U(n)).astype(np.int64), axis=1)
                fits = ~taken[slots].any(axis=1) & (np.diff(slots, axis=1) > 0).all(axis=1)
                if fits.any():
                    first = int(np.argmax(fits))
                    self.shift[b] = shift + first
                    taken[slots[first]] = True
                    break
                shift += 64
        lone = np.flatnonzero(sizes == 1)
        self.shift[lone] = -1 - np.flatnonzero(~taken)[:len(lone)]
        slots = self._slots(hashes)
        self.order = np.empty(n, np.int64)   # the key in each slot
        self.order[slots] = np.arange(n)

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), U, len(keys))

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        shift = self.shift[(hashes % U(self.buckets)).astype(np.int64)]
        moved = mixed(hashes ^ (shift.astype(U) * GOLDEN)) % U(self.n)
        return np.where(shift < 0, -1 - shift, moved.astype(np.int64))

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The number of the key that each of ``keys`` would be, if it is one."""
        return self.order[self._slots(self.hashes(keys))]


class Encoder:
    """A vocabulary of byte strings with ranks, and the pattern that cuts texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.tokens, self.pattern = list(ranks), pattern
        self.ranks = np.fromiter(ranks.values(), np.int64, len(ranks))
        self.table = PerfectHash(self.tokens)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in WORKER_ONLY}

    def ready(self) -> Encoder:
        """With what is not shipped: the compiled pattern, the tables of lookups by rank, the cache."""
        if not hasattr(self, "cut"):
            self.rank_of = dict(zip(self.tokens, self.ranks.tolist()))
            self.packed = [np.int32(rank).tobytes() for rank in self.ranks]
            self.sizes = np.zeros(int(self.ranks.max(initial=0)) + 1, np.int32)
            self.sizes[self.ranks] = list(map(len, self.tokens))
            self.starts = np.cumsum(self.sizes, dtype=np.int32) - self.sizes
            self.blob = np.frombuffer(b"".join(sorted(self.tokens, key=self.rank_of.get)), np.uint8)
            self.cache: dict[bytes, bytes] = {}
            self.cut = regex.compile(self.pattern).findall
        return self

    def merged(self, token: bytes) -> bytes:
        """The ids of a pre-token that is no entry; those met before come from the cache."""
        found = self.cache.get(token)
        if found is None:
            if len(self.cache) >= MISSES:
                self.cache.clear()
            found = self.merge(token)
            if len(token) <= LONGEST:
                self.cache[token] = found
        return found

    def merge(self, token: bytes) -> bytes:
        """The ids of one pre-token, packed, by merging its bytes, lowest rank first, leftmost among equals.

        ``end[i]`` is where the part that starts at byte i ends, and so where the next one starts; 0 if no
        part starts there.  A heap entry is a rank, a start and the end of the two parts as one number.
        """
        n, rank_of = len(token), self.rank_of.get
        end, before = list(range(1, n + 1)), list(range(-1, n))
        half = n.bit_length()
        full, low = 2 * half, (1 << half) - 1
        heap = [rank << full | i << half | i + 2 for i in range(n - 1)
                if (rank := rank_of(token[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            i, stop = entry >> half & low, entry & low
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (rank := rank_of(token[i:end[stop]])) is not None:
                    heapq.heappush(heap, rank << full | i << half | end[stop])
            p = before[i]
            if p >= 0 and (rank := rank_of(token[p:stop])) is not None:
                heapq.heappush(heap, rank << full | p << half | stop)
        out, i = array.array("i"), 0
        while i < n:
            out.append(self.rank_of[token[i:end[i]]])
            i = end[i]
        return out.tobytes()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's end.

        No match of the pattern goes on from other characters into white space, so texts fall apart before
        white space that follows something else, and each distinct piece of a block is cut and encoded once.
        """
        self.ready()
        pieces, uses, stops = Numbers(), array.array("i"), np.zeros(len(texts), np.int64)
        number = pieces.__getitem__
        for i, text in enumerate(texts):
            for j, line in enumerate(text.split("\n")):
                if SPACED(line) or j and not line:
                    uses.extend(map(number, self.cut_apart(text, stops[i - 1] if i else 0, uses)))
                    break
                words = line.split(" ")
                first = "\n" + words[0] if j else words[0]
                if first:
                    uses.append(number(first))
                uses.extend(map(number, [" " + word for word in words[1:]]))
            stops[i] = len(uses)
        if not pieces:
            return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
        tokens, token_uses = Numbers(), array.array("i")
        piece_ends = np.zeros(len(pieces), np.int64)
        for i, piece in enumerate(pieces):
            token_uses.extend(map(tokens.__getitem__, self.cut(piece)))
            piece_ends[i] = len(token_uses)
        keys = [t.encode() for t in tokens]
        at = self.table.find(keys).tolist()
        packed = [self.packed[a] if self.tokens[a] == key else self.merged(key) for a, key in zip(at, keys)]
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        pool = np.frombuffer(b"".join(packed), np.int32)
        token_use = np.frombuffer(token_uses, np.int32)
        piece_ids = pool[runs(np.cumsum(sizes) - sizes, sizes, token_use)]
        piece_stops = np.concatenate([[0], np.cumsum(sizes[token_use])])[piece_ends]
        piece_sizes = np.diff(piece_stops, prepend=0)
        use = np.frombuffer(uses, np.int32)
        ids = piece_ids[runs(piece_stops - piece_sizes, piece_sizes, use)]
        return ids, np.concatenate([[0], np.cumsum(piece_sizes[use])])[stops]

    def cut_apart(self, text: str, start: int, uses: array.array) -> list[str]:
        """The pieces of a text with white space of other kinds; what was found of it so far is taken back."""
        del uses[start:]
        return self.cut(text)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids one after another, and where those of each run of ids end."""
        self.ready()
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.sizes) or not self.sizes[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        counts = np.concatenate([[0], np.cumsum(self.sizes[ids])])
        return self.blob[runs(self.starts, self.sizes, ids)], counts[ends]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line per entry with its bytes in base64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def encoder(spark: SparkSession, path: str, pattern: str):
    """The encoder of a rank file, broadcast; its size is that of the vocabulary."""
    return spark.sparkContext.broadcast({"packed": cloudpickle.dumps(Encoder(read_ranks(path), pattern))})


def unpacked(shared) -> Encoder:
    """The broadcast encoder; a worker unpacks it once and keeps it, with its cache, for its further tasks."""
    held = shared.value
    if "ready" not in held:
        held["ready"] = cloudpickle.loads(held["packed"]).ready()
    return held["ready"]


def large_list(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values, kind))


def binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Consecutive runs of bytes as an Arrow binary column."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def tokenized(docs: DataFrame, shared, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and each text's ``ids``; ``shared`` comes from :func:`encoder`."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = unpacked(shared)
        for rows, texts in in_blocks(batches, "__text", BLOCK):
            ids, ends = tool.encode([t.decode() for t in texts])
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:-1], large_list(ids, ends, pa.int32())], [*rows.schema.names[:-1], "ids"])

    given = docs.select(*keep, F.col(text).alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema[:-1])
    return given.mapInArrow(encode, f"{kinds}, ids array<int>")


def detokenized(rows: DataFrame, shared, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and the bytes, ``decoded``, that each row's ids stand for; null ids are none."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = unpacked(shared)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            found, ends = tool.decode(flat, np.cumsum(sizes))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], binaries(found, ends)], [*batch.schema.names[:-1], "decoded"])

    given = rows.select(*keep, F.coalesce(F.col(ids), F.array().cast("array<int>")).alias("__ids"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema[:-1])
    return given.mapInArrow(decode, f"{kinds}, decoded binary")


def round_trip(docs: DataFrame, shared, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, each text's ids and the bytes they decode to: both directions in one pass.

    ``packed`` holds the ids as little-endian unsigned 32-bit integers, as token files do.
    """
    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = unpacked(shared)
        for rows, texts in in_blocks(batches, "__text", BLOCK):
            ids, ends = tool.encode([t.decode() for t in texts])
            found, stops = tool.decode(ids, ends)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:-1], binaries(ids.astype("<u4").view(np.uint8), ends * 4), binaries(found, stops)],
                [*rows.schema.names[:-1], "packed", "decoded"])

    given = docs.select(*keep, F.col(text).alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema[:-1])
    return given.mapInArrow(both, f"{kinds}, packed binary, decoded binary")
