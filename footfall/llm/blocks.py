"""Turn Arrow batches of texts into blocks of words that numpy can work on.

Every operator that works on words reads a partition as a stream of Arrow batches, a bounded number
of bytes at a time, so its memory depends on the block size and on the longest single text only.
"""

from __future__ import annotations

import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BLOCK_BYTES = 8 << 20
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
GOLDEN = np.uint64(0x9E3779B97F4A7C15)  # fixed values of the splitmix64 finaliser
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    return pc.fill_null(column.cast(pa.large_binary()), b"").to_pylist()


def in_blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES,
              rows: int = 20_000) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batches cut where the texts of ``column`` reach ``limit`` bytes, each with its texts."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        size = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, n in enumerate(size.tolist()):
            if i > start and (total + n > limit or i - start >= rows):
                cut = batch.slice(start, i - start)
                yield cut, utf8(cut.column(at))
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            cut = batch.slice(start)
            yield cut, utf8(cut.column(at))


class Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


class Words:
    """The words of a block of texts: ``ids`` in order, text ``i`` at ``ends[i-1]:ends[i]``, ``words[id]``.

    Words are what white space in ASCII separates; ``lower`` folds A-Z.
    """

    def __init__(self, texts: list[bytes], lower: bool = True, close: bytes | None = None):
        numbers, ids, ends = Numbers(), array.array("i"), np.empty(len(texts), np.int64)
        number = numbers.__getitem__
        for i, text in enumerate(texts):
            words = (text.translate(LOWER) if lower else text).split()
            if close is not None:
                words.append(close)
            ids.extend(map(number, words))
            ends[i] = len(ids)
        self.ids, self.ends = np.frombuffer(ids, np.int32) if len(ids) else np.empty(0, np.int32), ends
        self.words = list(numbers)

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], self.ends[:-1]]) if len(self.ends) else self.ends

    def owner(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each distinct word."""
        return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in self.words), np.uint64, len(self.words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform numbers above 0, up to 1, from hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def list_array(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Consecutive runs of ``values`` as an Arrow list column."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values))


def runs(starts: np.ndarray, sizes: np.ndarray, use: np.ndarray) -> np.ndarray:
    """The positions of the runs numbered ``use``, one run after another."""
    size = sizes[use]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total < 2 ** 31 and (not len(starts) or starts[-1] < 2 ** 31) else np.int64
    return np.repeat((starts[use] - (ends - size)).astype(kind), size) + np.arange(total, dtype=kind)
