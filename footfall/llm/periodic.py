"""Periodic runs in the words of a text, by common extensions from suffix trees.

A run is a stretch of words that repeats with its smallest period ``q`` at least ``TIMES`` times over at least ``LEAST`` words and that no
neighbouring word extends.  Every run holds the longest Lyndon word from one of its positions, under one of the
two orders of the words, as its root.  So for each position the next smaller suffix ends a candidate root, and the root is
extended to both sides as far as the words agree: to the right by the longest common extension of two suffixes, to
the left by that of two prefixes.  Both are constant-time range minima over the tours of two trees by Ukkonen's
algorithm, one of the words and one of their reversal.  Of a tour only the visits of a node between two of its children are
kept, since the lowest common ancestor of two leaves is among these.

What the trees are made of.  ``GRAM`` words (the largest power of two up to ``LEAST / TIMES``) from any position of a run
occur again in it, as the run is that much longer than two periods.  So a run lies in a stretch all of whose grams occur
more than once in the text, and again more than once in that stretch; other words cannot be in any run.  These stretches are
found for a block of texts at once, by sorting hashes, and a text's trees are made of each of its stretches.  A
collision of hashes can make a stretch longer and never loses a run.  In memory are a block of texts and the trees of one stretch.

Collapsing drops each word that some run holds after its first ``q`` words.

Edge cases.  Null text is empty; a text without words has no runs and collapses to nothing.  A lone text may be of any
length, the trees take about 1 kB per word of its longest stretch.  The result is a column, so further columns may
have any name, and repeated rows and ids do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.blocks import GOLDEN, Words, mixed, utf8

LEAST, TIMES = 24, 3
BLOCK_BYTES = 2 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "struct<runs:array<struct<start:bigint,length:bigint,period:bigint>>,best:int,collapsed:string>"


# ---- suffix trees -------------------------------------------------------------------------

class Tree:
    """Ukkonen's suffix tree of numbers above 0, closed by a 0; leaf ``i`` is the suffix from ``i``."""

    def __init__(self, numbers: list[int]):
        self.text = text = [*numbers, 0]
        n = len(text)
        start, stop, link, kids = [0], [0], [0], [{}]   # of the edge above each node; node 0 is the root
        self.leaf = leaf = [-1]                         # the suffix that a leaf stands for
        node = edge = length = open_suffixes = leaves = 0

        def grown(first: int, last: int, below: dict | None, suffix: int) -> int:
            start.append(first)
            stop.append(last)
            link.append(0)
            kids.append(below)
            leaf.append(suffix)
            return len(start) - 1

        for i, sign in enumerate(text):
            open_suffixes += 1
            waiting = 0
            while open_suffixes:
                if not length:
                    edge = i
                child = kids[node].get(text[edge])
                if child is None:
                    kids[node][text[edge]] = grown(i, n, None, leaves)
                    leaves += 1
                    if waiting:
                        link[waiting] = node
                    waiting = node
                else:
                    size = min(stop[child], i + 1) - start[child]
                    if length >= size:
                        node, edge, length = child, edge + size, length - size
                        continue
                    cut = start[child] + length
                    if text[cut] == sign:
                        length += 1
                        if waiting:
                            link[waiting] = node
                        break
                    middle = grown(start[child], cut, {text[cut]: child, sign: grown(i, n, None, leaves)}, -1)
                    leaves += 1
                    kids[node][text[edge]] = middle
                    start[child] = cut
                    if waiting:
                        link[waiting] = middle
                    waiting = middle
                open_suffixes -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - open_suffixes + 1
        self.start, self.stop, self.kids = start, stop, kids

    def tour(self, falling: bool = False) -> tuple[list[int], list[int]]:
        """The leaves in the order of the tour, and how many words lie above the node between each leaf and the one before.

        Children come by rising words, with ``falling`` by falling ones; the closing 0 comes first in both.
        """
        start, stop, kids, leaf = self.start, self.stop, self.kids, self.leaf
        order, between, turn = [], [], 0
        todo = [(0, 0, -1)]
        while todo:
            node, above, turned = todo.pop()
            if turned >= 0:
                turn = turned
            below = kids[node]
            if below is None:
                order.append(leaf[node])
                between.append(turn)
                continue
            depth = above + stop[node] - start[node]
            words = sorted(below, reverse=not falling)   # the last is visited first
            if falling and words[0] == 0:
                words.append(words.pop(0))
            first = words.pop()
            todo += [(below[w], depth, depth) for w in words]
            todo.append((below[first], depth, -1))
        return order, between


class Extensions:
    """The longest common extension of any two suffixes in constant time, by range minima over a tour."""

    def __init__(self, order: list[int], between: list[int]):
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.least = [np.array(between, np.int32)]
        while (step := 1 << (len(self.least) - 1)) * 2 <= len(between):
            last = self.least[-1]
            self.least.append(np.minimum(last[:-step], last[step:]))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of different suffixes."""
        a, b = self.place[a], self.place[b]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            table = self.least[k]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << k)])
        return out


def next_smaller(order: list[int]) -> np.ndarray:
    """For each suffix the next one to its right that comes before it in ``order``; the closing 0 is the last."""
    place = [0] * len(order)
    for rank, suffix in enumerate(order):
        place[suffix] = rank
    out, ahead = [0] * len(order), []
    for i in range(len(order) - 1, -1, -1):
        rank = place[i]
        while ahead and place[ahead[-1]] > rank:
            ahead.pop()
        out[i] = ahead[-1] if ahead else i
        ahead.append(i)
    return np.array(out[:-1], np.int64)


def runs_of(numbers: list[int]) -> np.ndarray:
    """All runs of at least two periods in numbers above 0: rows of start, length, period."""
    n = len(numbers)
    tree = Tree(numbers)
    order, between = tree.tour()
    right = Extensions(order, between)
    roots = [next_smaller(order), next_smaller(tree.tour(falling=True)[0])]
    del tree
    left = Extensions(*Tree(numbers[::-1]).tour())
    found = []
    i = np.arange(n)
    for j in roots:
        before, after = left.of(n - i, n - j), right.of(i, j)
        at = np.flatnonzero(before + after >= j - i)
        found.append(np.column_stack([i[at] - before[at], j[at] + after[at] - i[at] + before[at], (j - i)[at]]))
    return np.unique(np.concatenate(found), axis=0)


# ---- stretches that can hold a run --------------------------------------------------------

def gram_size(least: int, times: int) -> int:
    return 1 << ((least // times).bit_length() - 1)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each position on, for a power of two."""
    step = 1
    while step < size:
        words = mixed(words[:-step] * GOLDEN + words[step:]) if len(words) > step else words[:0]
        step *= 2
    return words


def stretches(at: np.ndarray, owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the grams from the positions ``at`` those that occur again with their owner, and each one's stretch of neighbours."""
    keys = mixed(hashes ^ mixed(owner.astype(np.uint64) * GOLDEN))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    kept, whose = at[again], owner[again]
    starts = np.ones(len(kept), bool)
    starts[1:] = (np.diff(kept) > 1) | (np.diff(whose) != 0)
    return kept, np.cumsum(starts) - 1


def found_runs(block: Words, least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """The runs of each text of a block, by start and period."""
    out = [[] for _ in block.ends]
    size = gram_size(least, times)
    if len(block.ids) < size:
        return out
    owner = block.owner()
    hashes = gram_hashes(block.hashes()[block.ids], size)
    at = np.flatnonzero(owner[:len(hashes)] == owner[size - 1:])
    kept, stretch = stretches(at, owner[at], hashes[at])
    kept, stretch = stretches(kept, stretch, hashes[kept])
    if not len(kept):
        return out
    firsts = np.flatnonzero(np.concatenate([[True], stretch[1:] != stretch[:-1]]))
    lasts = np.append(firsts[1:], len(kept)) - 1
    starts = block.starts
    for a, b in zip(kept[firsts].tolist(), (kept[lasts] + size).tolist()):
        if b - a >= least:
            numbers = np.unique(block.ids[a:b], return_inverse=True)[1] + 1
            runs = runs_of(numbers.tolist())
            runs = runs[runs[:, 1] >= np.maximum(least, times * runs[:, 2])]
            text = int(owner[a])
            offset = a - int(starts[text])
            out[text] += [(s + offset, n, q) for s, n, q in runs.tolist()]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def greatest(runs: list[tuple[int, int, int]]) -> int | None:
    """The number of the run with the most periods; of equal ones the first to start, then the shorter period."""
    return min(range(len(runs)), key=lambda k: (-Fraction(runs[k][1], runs[k][2]), runs[k][0], runs[k][2]), default=None)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by blanks, without those that a run holds after its first period."""
    if runs:
        kept, last = [], 0
        spans = sorted((start + period, start + length) for start, length, period in runs)
        for a, b in spans:
            kept += words[last:a]
            last = max(last, b)
        words = kept + words[last:]
    return b" ".join(words)


def periodic_runs(text: str | Column = "text", least: int = LEAST, times: int = TIMES) -> Column:
    """The runs of a text in order of start and period, the number (from 0) of the one with most periods, and the text collapsed.

    Words are what white space in ASCII separates, and are numbered from 0.  ``times`` is 3 at least.
    """
    if times < 3 or least < times:
        raise ValueError("a run has three periods at least, and as many words")

    @F.arrow_udf(FOUND)
    def find(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            parts = [_found(part, least, times) for part in _parts(column)]
            yield pa.concat_arrays(parts) if parts else _found([], least, times)

    return find(F.col(text) if isinstance(text, str) else text)


def _parts(column: pa.Array) -> Iterator[list[bytes]]:
    """The texts of a column in runs of about ``BLOCK_BYTES``."""
    size = np.asarray(pc.fill_null(pc.binary_length(column), 0))
    part = (np.cumsum(size) // BLOCK_BYTES).tolist()
    start = 0
    for i in range(1, len(part) + 1):
        if i == len(part) or part[i] != part[start]:
            yield utf8(column.slice(start, i - start))
            start = i


def _found(texts: list[bytes], least: int, times: int) -> pa.Array:
    runs = found_runs(Words(texts, lower=False), least, times)
    return pa.StructArray.from_arrays(
        [pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs], pa.list_(RUN)),
         pa.array([greatest(own) for own in runs], pa.int32()),
         pa.array([collapsed(t.split(), own) for t, own in zip(texts, runs)], pa.binary()).cast(pa.string())],
        ["runs", "best", "collapsed"])


# ---- the query's rows ---------------------------------------------------------------------

def repeated_tail(text: str, id_col: str) -> Column:
    """The text, whose words from some place on become a period for one id in ten by a checksum of the id.

    With h the checksum of the id as text, g = h / 10 and n words, the words from ``a = g % n`` on repeat the
    ``1 + (n - a) / (3 + g % 8)`` words that stand there, up to the old length.  A null id changes nothing.
    """
    h = f"crc32(cast(cast({id_col} AS string) AS binary))"
    words = f"filter(split({text}, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w != '')"
    return F.expr(f"""
        CASE WHEN {h} % 10 = 0 AND {text} RLIKE '[^\\\\x20\\\\x09-\\\\x0D]' THEN array_join(element_at(transform(transform(
            array({words}), w -> struct(w, cast(({h} div 10) % size(w) AS int) AS a, cast(3 + ({h} div 10) % 8 AS int) AS c)),
            s -> slice(concat(slice(s.w, 1, s.a), flatten(array_repeat(slice(s.w, s.a + 1, 1 + (size(s.w) - s.a) div s.c), 11))),
                       1, size(s.w))), 1), ' ') ELSE {text} END""")


def run_digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: how many runs, the one with most periods, and digests of all runs and of the collapsed text."""
    rows = docs.select(id_col, periodic_runs(text).alias("found"))
    best = F.get("found.runs", F.col("found.best"))
    lines = F.transform("found.runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return rows.select(
        id_col, F.size("found.runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.expr("found.runs[found.best].length * 1000 div found.runs[found.best].period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed").cast("binary"), 256).alias("collapsed_sha256"))
