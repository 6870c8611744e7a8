"""Text quality by supervised subword embeddings.

A text's features are its words, the 2- to 4-byte grams of each word between marks, and its pairs of
neighbouring words, all hashed into ``BUCKETS`` rows of an embedding table (a word that follows itself has one
row of its own, whatever the word).  The embeddings of all features of the whole text are averaged, and
a softmax over the two labels follows.  Both layers are learned by stochastic gradient descent in numpy, in one task,
from a bounded sample of the labelled texts: ``SAMPLE`` of them, those with the smallest hash of their id, as far as
their features (distinct rows of a text) add up to ``SAMPLE_FEATURES``.  Only the weights come to the driver.

A text's score needs one number per feature row, its embedding times the difference of the two outputs, so
scoring adds up numbers per distinct word of a block and divides by the count of features.

Edge cases.  Null text is empty; a text without words gets the model's bias.  Labels that are null or
belong to no text are ignored; without labelled texts the score is 0.5.  Texts with several labels
count once per label.  Scoring is a column function, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.blocks import GOLDEN, Words, mixed, utf8

U = np.uint64
BUCKETS, GRAMS = 1 << 16, (2, 3, 4)
SAMPLE = 8000            # labelled texts learned from, at most
SAMPLE_FEATURES = 32 << 20   # feature rows of these, at most (6 bytes each)
DIMENSIONS, EPOCHS, RATE = 8, 6, 0.5
PAIR_SEED, REPEAT = U(77), 0
BLOCK = 1 << 20


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The feature rows of each distinct word: rows one word after another, and where each word's end."""
    marked = [b"<" + w + b">" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(marked), np.uint8).astype(U) + U(1)
    owners, rows = [np.arange(len(words))], [Words.hashes(_only(words)) % U(BUCKETS)]
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(data))   # bytes from here to the end of the word
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        gram = np.full(len(at), U(n))
        for k in range(n):
            gram = gram * U(1000003) + data[at + k]
        rows.append(mixed(gram * GOLDEN) % U(BUCKETS))
        owners.append(owner[at])
    owner, row = np.concatenate(owners), np.concatenate(rows).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return row[order], np.cumsum(np.bincount(owner, minlength=len(words)))


def _only(words: list[bytes]) -> Words:
    out = object.__new__(Words)
    out.words = words
    return out


def pair_features(block: Words) -> tuple[np.ndarray, np.ndarray]:
    """The row of every pair of neighbouring words in a text, and the text it is in."""
    if len(block.ids) < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    owner, hashes = block.owner(), block.hashes()[block.ids]
    inside = owner[1:] == owner[:-1]
    row = (mixed(hashes[:-1] * GOLDEN + hashes[1:] + PAIR_SEED) % U(BUCKETS)).astype(np.int64)
    row[block.ids[1:] == block.ids[:-1]] = REPEAT
    return row[inside], owner[1:][inside]


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct feature rows and their counts, and where each text's end."""
    block = Words(texts, lower=False)
    rows, ends = word_features(block.words)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    pair, pair_owner = pair_features(block)
    stops = np.searchsorted(pair_owner, np.arange(len(texts)), side="right")
    out_rows, out_counts, out_ends, last, at = [], [], [], 0, 0
    for i, end in enumerate(block.ends.tolist()):
        own = [rows[starts[w]:ends[w]] for w in block.ids[last:end].tolist()]
        row, count = np.unique(np.concatenate([*own, pair[at:stops[i]]]), return_counts=True) if own else (
            np.empty(0, np.int64), np.empty(0, np.int64))
        out_rows.append(row)
        out_counts.append(count)
        out_ends.append(len(row))
        last, at = end, stops[i]
    empty = [np.empty(0, np.int64)]
    return np.concatenate(out_rows or empty), np.concatenate(out_counts or empty), np.cumsum(out_ends)


def fit(samples: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 1) -> tuple[np.ndarray, float]:
    """Learn from (rows, counts, label): the weight of each feature row, and the bias.

    Plain stochastic gradient descent over shuffled samples, its rate falling to 0.
    """
    if not samples:
        return np.zeros(BUCKETS), 0.0
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    output, bias = np.zeros((2, DIMENSIONS)), np.zeros(2)
    steps, step = EPOCHS * len(samples), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(samples)).tolist():
            rows, counts, label = samples[i]
            rate = RATE * (1 - step / steps)
            step += 1
            share = counts / max(1, counts.sum())
            mean = share @ table[rows] if len(rows) else np.zeros(DIMENSIONS)
            raw = output @ mean + bias
            error = np.exp(raw - raw.max())
            error /= error.sum()
            error[label] -= 1
            back = error @ output
            output -= rate * np.outer(error, mean)
            bias -= rate * 0.1 * error
            if len(rows):
                # each row moves by its share of the text, scaled to the number of distinct rows
                table[rows] -= rate * np.outer(np.minimum(share * len(rows), 20.0), back)
    return table @ (output[1] - output[0]), float(bias[1] - bias[0])


def probabilities(texts: list[bytes], weights: np.ndarray, bias: float) -> np.ndarray:
    """The probability of label 1 for each whole text."""
    block = Words(texts, lower=False)
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    if len(block.ids):
        rows, ends = word_features(block.words)
        starts = np.concatenate([[0], ends[:-1]])
        per_word = np.add.reduceat(weights[rows], starts)
        owner = block.owner()
        total += np.bincount(owner, per_word[block.ids], len(texts))
        count += np.bincount(owner, (ends - starts)[block.ids], len(texts))
        pair, pair_owner = pair_features(block)
        total += np.bincount(pair_owner, weights[pair], len(texts))
        count += np.bincount(pair_owner, minlength=len(texts))
    return 1 / (1 + np.exp(-np.clip(total / np.maximum(count, 1) + bias, -500, 500)))


def held_out(id_col: str | Column, parts: int = 3, part: int = 1) -> Column:
    """Whether crc32 of the id as text falls in the part that is not learned from; a null id never does."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id",
          text: str = "text", sample: int = SAMPLE, sample_features: int = SAMPLE_FEATURES):
    """The model from labelled texts that are not held out, broadcast (its size is fixed).

    The sample's ids are chosen first, so the texts are read once and joined with at most ``sample`` rows.
    """
    chosen = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
              .select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("id"), "id", "label").limit(sample))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                rows, counts, ends = features(utf8(part.column(1)))
                cuts = list(zip([0, *ends[:-1]], ends))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2),
                     pa.array([rows[a:b].astype(np.uint16).tobytes() for a, b in cuts], pa.binary()),
                     pa.array([counts[a:b].astype(np.uint32).tobytes() for a, b in cuts], pa.binary())],
                    ["id", "label", "rows", "counts"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, left = [], sample_features
        for batch in batches:
            for i, y, rows, counts in zip(*(column.to_pylist() for column in batch.columns)):
                left -= len(rows) // 2
                if left >= 0:   # once it is below, it stays below
                    held.append((i, y, rows, counts))
        held.sort()
        weights, bias = fit([(np.frombuffer(rows, np.uint16), np.frombuffer(counts, np.uint32), y) for _, y, rows, counts in held])
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()]), pa.array([bias])], ["weights", "bias"])

    kind = dict(texts.dtypes)["id"]
    learned = (texts.mapInArrow(extract, f"id {kind}, label int, rows binary, counts binary").repartition(1)
               .sortWithinPartitions(F.xxhash64("id"), "id", "label", "rows", "counts")
               .mapInArrow(learn, "weights binary, bias double").first())
    model = (np.frombuffer(learned.weights), learned.bias) if learned else fit([])
    return docs.sparkSession.sparkContext.broadcast(model)


def score(model, text: str = "text") -> Column:
    """The probability of label 1 as a column; ``model`` comes from :func:`train`."""
    @F.arrow_udf(T.DoubleType())
    def probability(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, bias = model.value
        for column in columns:
            texts = utf8(column)
            yield pa.array(np.concatenate([np.empty(0), *(
                probabilities(part, weights, bias) for part in in_parts(texts))]))

    return probability(F.col(text))


def in_parts(texts: list[bytes], limit: int = BLOCK) -> Iterator[list[bytes]]:
    """The texts in runs of about ``limit`` bytes."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        if i > start and total + len(text) > limit:
            yield texts[start:i]
            start, total = i, 0
        total += len(text)
    if texts:
        yield texts[start:]


def scored(docs: DataFrame, model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from 0.5 on)."""
    out = docs.withColumn("score", score(model, text))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(spark: SparkSession, docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted to be of label 1, with the columns they had."""
    model = train(docs, labels, text=text)
    return docs.where(score(model, text) >= 0.5)
