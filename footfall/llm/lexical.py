"""Ranked lexical search by posting lists that are blocked by the likeness of their documents.

Terms are what stands between ASCII characters other than letters and digits, with A-Z lower-cased.  A term's weight falls with
the number of documents that hold it, and a document's share of it rises with its occurrences and falls with
the document's length (:func:`weight`, :func:`impacts`; whole numbers only).  A document's score for an item is the sum of its impacts
over the item's terms, and each item gets its ``top`` best documents.

Index.  Documents become vectors of impacts on the terms of the items; other terms cannot add to any score.  Tasks take
them in segments of bounded size.  In a segment each term has the list of its documents, and a list is clustered by
likeness: some of its documents are pivots, the others go to the pivot with the largest inner product of sketches (random signs),
and a cluster is cut into blocks.  A block's summary is the maximum of its documents' impacts in each coordinate.

Search.  The sum of a summary over an item's terms bounds the score of every document in the block, exactly.  A block is
skipped only if that bound is below a score that ``top`` documents are known to reach; and a list is left out if an item's terms with
the smallest maxima, this one among them, cannot reach it together, since a better document is in the list of another term.
What is left is scored in full.  The known score comes from one document in ``SAMPLE``, chosen by hash and scored
for every item, and rises with what a task has found.  So no document that belongs to the result is passed over.

Items are taken in blocks of about ``BLOCK_TERMS`` terms; what is sent to the tasks is one block's terms and items.  Each
block reads the documents once.  No list, segment or item is brought together in one task: a task returns its ``top`` rows per item.

Edge cases.  Null text is empty.  A document without terms counts for nothing and is never found; one without an id counts and
may be found, before others of equal score.  Repeated rows are documents of their own.  An item without terms has no rows; an item that
occurs twice has its rows twice.  Empty tables give no rows.  Ids of documents are integers.  Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.blocks import in_blocks, list_array
from footfall.runtime import stored

TOP = 50
BLOCK_TERMS = 8192     # distinct terms of a block of items, about
SEGMENT_CELLS = 8 << 20  # documents of a segment times terms of the block, at most (64 MB)
BLOCK_DOCS = 8        # documents of a block of a list, at most
SKETCH = 16
SAMPLE = 16
# Fixed by the contract of the query: all ASCII but letters and digits parts terms.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weights * (1_000_000_000 * tf // (1000 * tf + 20 * m))


# ---- vectors of documents -----------------------------------------------------------------

def vectors(docs: DataFrame, vocabulary: list[bytes], id_col: str, text: str) -> DataFrame:
    """Each document's number of terms, and which terms of the vocabulary it holds how often."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for rows, texts in in_blocks(batches, "text"):
            sizes, terms, counts, ends = [], array("i"), array("q"), []
            for words in map(terms_of, texts):
                sizes.append(len(words))
                held = Counter(words)
                own = sorted((number[w], held[w]) for w in held.keys() & number.keys())
                terms.extend(t for t, _ in own)
                counts.extend(n for _, n in own)
                ends.append(len(terms))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(sizes, pa.int64()), list_array(np.array(terms, np.int32), np.array(ends)),
                 list_array(np.array(counts, np.int64), np.array(ends))], ["id", "n", "terms", "counts"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(count, "id long, n long, terms array<int>, counts array<long>")


@dataclass
class Corpus:
    """What the score needs besides the document: sizes of the corpus and the weight of each term."""
    documents: int
    terms: int
    weights: np.ndarray

    def matrix(self, rows: pa.RecordBatch, width: int) -> np.ndarray:
        """The impacts of the documents on all terms; whole numbers that floats hold exactly."""
        lists = rows.column(2)
        size = np.diff(lists.offsets.to_numpy())
        term, tf = (rows.column(k).flatten().to_numpy().astype(np.int64) for k in (2, 3))
        # Python's whole numbers, since 50 * n * N may pass 64 bits for very many documents
        m = np.array([50 + 50 * n * self.documents // self.terms for n in rows.column(1).to_pylist()], np.int64)
        out = np.zeros((len(size), width))
        owner = np.repeat(np.arange(len(size)), size)
        out[owner, term] = impacts(self.weights[term], tf, m[owner])
        return out


def corpus_of(rows: DataFrame, width: int) -> Corpus:
    """Counts over all documents; a row per term of the block at most comes to the driver."""
    documents, terms = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(width, np.int64)
    for term, n in rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holding[term] = n
    return Corpus(documents, terms, np.array([weight(documents, n) for n in holding.tolist()], np.int64))


def segments(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows of a partition in batches of ``rows``, the last one smaller."""
    held, size = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - size)
            held.append(part)
            size += part.num_rows
            batch = batch.slice(part.num_rows)
            if size == rows:
                yield _as_one(held)
                held, size = [], 0
    if size:
        yield _as_one(held)


def _as_one(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


# ---- the index of a segment ---------------------------------------------------------------

def clustered(members: np.ndarray, sketches: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The documents of a list, like ones together, and where each block starts."""
    pivots = members[np.linspace(0, len(members) - 1, -(-len(members) // block)).astype(np.int64)]
    nearest = np.argmax(sketches[members] @ sketches[pivots].T, axis=1)
    order = np.argsort(nearest, kind="stable")
    nearest = nearest[order]
    first = np.flatnonzero(np.concatenate([[True], nearest[1:] != nearest[:-1]]))
    place = np.arange(len(members)) - np.repeat(first, np.diff(np.append(first, len(members))))
    return members[order], np.flatnonzero(place % block == 0)


@dataclass
class Found:
    """The best rows of one item so far."""
    top: int
    least: float                 # a score that ``top`` documents of the corpus reach, 1 if none is known
    scores: np.ndarray = field(default_factory=lambda: np.empty(0))
    named: np.ndarray = field(default_factory=lambda: np.empty(0, bool))
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def add(self, scores: np.ndarray, named: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.least
        scores, named, ids = (np.concatenate(x) for x in (
            (self.scores, scores[good]), (self.named, named[good]), (self.ids, ids[good])))
        best = np.lexsort((ids, named, -scores))[:self.top]
        self.scores, self.named, self.ids = scores[best], named[best], ids[best]
        if len(best) == self.top:
            self.least = max(self.least, self.scores[-1])


def candidates(matrix: np.ndarray, items: list[np.ndarray], least: list[float], block: int = BLOCK_DOCS) -> tuple[np.ndarray, int, int]:
    """Which documents may reach ``least`` for each item, and how many blocks were skipped, of how many."""
    peaks = matrix.max(axis=0)
    wanted: dict[int, list[int]] = {}
    for k, terms in enumerate(items):
        rising = terms[np.argsort(peaks[terms], kind="stable")]
        for t in rising[np.cumsum(peaks[rising]) >= least[k]].tolist():
            if peaks[t]:
                wanted.setdefault(t, []).append(k)
    signs = np.random.default_rng(1).choice([-1.0, 1.0], (matrix.shape[1], SKETCH))
    size = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    sketches = (matrix @ signs) / np.maximum(size, 1)
    may, skipped, blocks = np.zeros((len(items), len(matrix)), bool), 0, 0
    for t, which in wanted.items():
        members, starts = clustered(np.flatnonzero(matrix[:, t]), sketches, block)
        columns = np.unique(np.concatenate([items[k] for k in which]))
        summaries = np.maximum.reduceat(matrix[np.ix_(members, columns)], starts, axis=0)
        asks = np.stack([np.isin(columns, items[k]) for k in which], axis=1).astype(np.float64)
        visit = summaries @ asks >= np.array([least[k] for k in which])
        owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(members))))
        for column, k in enumerate(which):
            may[k, members[visit[owner, column]]] = True
        skipped, blocks = skipped + int((~visit).sum()), blocks + visit.size
    return may, skipped, blocks


def _searched(items: list[np.ndarray], corpus: Corpus, least: list[float], top: int, everything: bool):
    """The task: the best rows of a partition for each item; with ``everything`` all documents are scored."""
    width = len(corpus.weights)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Found(top, max(1.0, x)) for x in least]
        for rows in segments(batches, max(64, SEGMENT_CELLS // width)):
            matrix = corpus.matrix(rows, width)
            ids = rows.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            named = rows.column(0).is_valid().to_numpy(zero_copy_only=False)
            if everything:
                may = np.ones((len(items), len(matrix)), bool)
            else:
                may, _, _ = candidates(matrix, items, [f.least for f in found])
            for k, terms in enumerate(items):
                at = np.flatnonzero(may[k])
                if len(at):
                    found[k].add(matrix[np.ix_(at, terms)].sum(axis=1), named[at], ids[at])
        which = np.repeat(np.arange(len(items)), [len(f.scores) for f in found])
        if len(which):
            named, ids, scores = (np.concatenate([getattr(f, c) for f in found]) for c in ("named", "ids", "scores"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(which, pa.int32()), pa.array(ids, pa.int64(), mask=~named), pa.array(scores.astype(np.int64))],
                ["item", "id", "score"])

    return search


# ---- search -------------------------------------------------------------------------------

def item_blocks(items: DataFrame, item_id: str, text: str, block_terms: int) -> Iterator[tuple[list, list[bytes], list[np.ndarray]]]:
    """Items in blocks of about ``block_terms`` terms: their ids, the vocabulary, and each one's distinct terms by number."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in in_blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([sorted(set(terms_of(t))) for t in texts], pa.list_(pa.binary()))], ["item_id", "terms"])

    kind = items.schema[item_id].dataType.simpleString()
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text"))
    rows = stored(rows.mapInArrow(split, f"item_id {kind}, terms array<binary>").where(F.size("terms") > 0), "items")
    total = rows.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // block_terms)
    for k in range(blocks):
        own = rows.where(F.pmod(F.xxhash64("terms", F.col("item_id").cast("string")), F.lit(blocks)) == k).collect()
        vocabulary = sorted({bytes(t) for r in own for t in r.terms})
        number = {t: i for i, t in enumerate(vocabulary)}
        if own:
            yield [r.item_id for r in own], vocabulary, [np.array([number[bytes(t)] for t in r.terms]) for r in own]


def _best(rows: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def ranked(items: DataFrame, docs: DataFrame, item_id: str = "item_id", id_col: str = "doc_id", text: str = "text",
           top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``top`` best documents of each item: ``item_id``, ``rank`` from 1, ``doc_id`` and ``score``."""
    kind, out = items.schema[item_id].dataType.simpleString(), []
    schema = "item int, id long, score long"
    for names, vocabulary, asked in item_blocks(items, item_id, text, block_terms):
        rows = stored(vectors(docs, vocabulary, id_col, text), "vectors")
        corpus = corpus_of(rows, len(vocabulary))
        rows = rows.where(F.size("terms") > 0)
        few = rows.where(F.pmod(F.xxhash64("id", "n", "terms"), F.lit(SAMPLE)) == 0)
        known = _best(few.mapInArrow(_searched(asked, corpus, [0.0] * len(asked), top, True), schema), top)
        least = [0.0] * len(asked)
        for item, score in known.where(F.col("rank") == top).select("item", "score").collect():
            least[item] = float(score)
        best = _best(rows.mapInArrow(_searched(asked, corpus, least, top, False), schema), top)
        named = docs.sparkSession.createDataFrame(list(enumerate(names)), f"item int, item_id {kind}")
        out.append(best.join(F.broadcast(named), "item").select(
            F.col("item_id").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))
    if not out:
        return docs.sparkSession.createDataFrame([], f"`{item_id}` {kind}, rank int, `{id_col}` long, score long")
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole
