"""Language-model scores: a hashed maximum-entropy model, factored by word classes.

Tokens are words (A-Z lower-cased) and one end per text.  The probability of a token is that of its class given
what stands before it, times that of the token within its class, given the words before it:

* Classes.  A word's class is a hash of its last three bytes, one of ``CLASSES``; the end is a class of its own.  The class is
  drawn from a softmax whose features are a bias, the class before (n-gram), the class before that (skip), and
  both hashed together into ``PAIRS`` rows (longer n-gram).
* Words.  The words of a class are dealt into ``BUCKETS`` by a hash of the whole word.  The bucket is drawn from a second softmax, one for
  each class, whose features are a bias, the word before (n-gram), the word before that (skip), and both together (longer n-gram),
  hashed into ``ROWS`` rows a class.  Words of one bucket, which is what the hash has to make of a vocabulary without bound, share its
  probability by their counts: with count c a word has (c - D_k) / (N_b - D_k V_b), where the bucket has N_b tokens of V_b kinds.
* Unseen words.  The event of any word of a class not seen in training has D_k V_k / N_k, where the class has N_k
  tokens of V_k kinds, and the words seen share the rest; D_k, between 0 and 1, follows from how many kinds were seen
  once and twice (absolute discounting).  A bucket without words has no chance.  So the probabilities of all events add up to 1.

Everything is learned from all training tokens.  One pass cuts the texts into blocks, numbers each block's
words, and writes the numbered texts, the words with their counts, how often each class followed each context, and how
often each bucket stood with each feature of the words before.  Words are added up over blocks by a shuffle; so are
contexts, from which the gradient of the first softmax is computed in ``ROUNDS`` jobs, each adding up the parts' gradients.
The second softmax starts at its biases, where the gradient follows from what was counted; each further round of
``WORD_ROUNDS`` reads the texts once more, and its tasks' expected counts, one table each, are added up by class in a shuffle.
For scoring, the counts go back to the
blocks that have the word, and a block's texts meet its words in one group of bounded size.

The base score is the add-one unigram model over the same counts.

Edge cases.  A null text is empty and has one token, its end.  A null id counts as training.  Repeated
rows are scored, and learned from, once each.  Without training tokens N and V are 0 and both scores are
those of an unseen token.  Only the id and the text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.blocks import GOLDEN, LOWER, Words, in_blocks, mixed
from footfall.llm.bpe import binaries
from footfall.runtime import shared_dir, stored

CLASSES, PAIRS = 64, 1024
OUTPUTS = CLASSES + 1            # class 0 is the end
BEGIN, CONTEXTS = OUTPUTS, OUTPUTS + 1
FEATURES = 1 + 2 * CONTEXTS + PAIRS
ROUNDS, DAMPING = 10, 5.0
BIAS_STEP, STEP = 0.25, 0.5    # four features are active at once, so full steps would swing
BUCKETS, ROWS = 32, 256          # a class has a row of biases, and the others for hashed features
WORD_ROUNDS, WORD_DAMPING, WORD_STEP = 3, 5.0, 0.5
EMPTY = -40.0                    # the bias of a bucket without words
CHUNK = 1 << 12                  # tokens whose rows and chances stay in the cache
FLUSH = 64                       # chunks counted at a time
SALTS = 16
BLOCK_BYTES, BLOCK_ROWS = 16 << 20, 50_000
READ_BYTES, READ_ROWS = 4 << 20, 50_000   # where words are not numbered
END = b"\n"                      # no word is white space
NEAR = 32                        # longer words are hashed one by one
U = np.uint64

# CRC-32 is linear in the bits: that of a word is that of as many zeros, changed by each byte according to how far from the end it stands.
ZEROS = np.array([zlib.crc32(bytes(n)) for n in range(NEAR + 1)], np.uint32)
CHANGES = np.array([[zlib.crc32(bytes([b]) + bytes(away)) ^ zlib.crc32(bytes(away + 1)) for b in range(256)]
                    for away in range(NEAR)] + [[0] * 256], np.uint32)   # none by those further away


def codes_of(words: list[bytes]) -> np.ndarray:
    """Each word's class, above 32 bits, and the CRC of the whole word; the end's is 0."""
    return np.fromiter((0 if w == END else (1 + zlib.crc32(w[-3:]) % CLASSES << 32) + zlib.crc32(w) for w in words),
                       np.int64, len(words))


def codes_in_order(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all words of the texts, as :func:`codes_of` has them, without the ends; and where texts with words start."""
    data = np.frombuffer((END + END.join(texts) + END).translate(LOWER), np.uint8)
    white = (data == 32) | (data - np.uint8(9) < 5)
    edges = np.flatnonzero(white[1:] != white[:-1]) + 1
    firsts, lasts = edges[::2], edges[1::2]
    codes = np.empty(len(firsts), np.int64)
    for at in range(0, len(firsts), CHUNK):
        _hash(data, white, firsts[at:at + CHUNK], lasts[at:at + CHUNK], codes[at:at + CHUNK])
    before = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    starts = np.unique(np.searchsorted(firsts, before + 1))
    return codes, starts[starts < len(firsts)]


def _hash(data: np.ndarray, white: np.ndarray, firsts: np.ndarray, lasts: np.ndarray, into: np.ndarray) -> None:
    """The codes of the words that stand from ``firsts`` to ``lasts``, a few thousand at a time."""
    sizes = lasts - firsts
    if lasts[-1] - firsts[0] > 2 * NEAR * len(firsts):   # a stretch of long words or white space
        into[:] = codes_of([data[a:b].tobytes() for a, b in zip(firsts.tolist(), lasts.tolist())])
        return
    ends = np.cumsum(sizes)
    letters = data[firsts[0]:lasts[-1]][~white[firsts[0]:lasts[-1]]]
    away = np.repeat(ends - 1, sizes) - np.arange(len(letters))
    crc = np.bitwise_xor.reduceat(CHANGES.take(np.minimum(away, NEAR) * 256 + letters), ends - sizes)
    crc ^= ZEROS[np.minimum(sizes, NEAR)]
    kind = ZEROS[np.minimum(sizes, 3)]
    for k in range(3):
        kind ^= np.where(sizes > k, CHANGES[k].take(data.take(lasts - 1 - k)), np.uint32(0))
    into[:] = ((kind % CLASSES).astype(np.int64) + 1 << 32) + crc
    for i in np.flatnonzero(sizes > NEAR).tolist():
        into[i] = codes_of([data[firsts[i]:lasts[i]].tobytes()])[0]


def code(word: str) -> Column:
    """As :func:`codes_of`, in Spark."""
    last = F.crc32(F.substring(word, -3, 3)) % CLASSES + 1
    return F.when(F.col(word) == F.lit(END), F.lit(0).cast("long")).otherwise(last * F.lit(1 << 32) + F.crc32(word))


def bucket_of(codes: np.ndarray) -> np.ndarray:
    return codes % BUCKETS


def contexts(classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The number of each token's context: the class before it and the one before that."""
    last = np.concatenate([[BEGIN], classes[:-1]])
    skip = np.concatenate([[BEGIN, BEGIN], classes[:-2]])[:len(classes)]
    last[starts] = BEGIN
    skip[starts] = BEGIN
    second = starts + 1
    skip[second[second < len(classes)]] = BEGIN
    return skip * CONTEXTS + last


def feature_rows(context: np.ndarray) -> np.ndarray:
    """The four rows of weights that are active in each context."""
    last, skip = context % CONTEXTS, context // CONTEXTS
    pair = (mixed(context.astype(U) * GOLDEN + U(1)) % U(PAIRS)).astype(np.int64)
    return np.stack([np.zeros_like(context), 1 + last, 1 + CONTEXTS + skip, 1 + 2 * CONTEXTS + pair], axis=1)


def log_softmax(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    raw = weights[rows].sum(axis=1)
    raw -= raw.max(axis=1, keepdims=True)
    return raw - np.log(np.exp(raw).sum(axis=1, keepdims=True))


def word_rows(codes: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The four rows of the second softmax that are active for each token: bias, word before, the one before that, both.

    ``codes`` are those of the distinct words that ``ids`` number.  The rows come in chunks, each with its first token's number.
    """
    named = mixed((codes.astype(U) + U(1)) * GOLDEN)
    base = (codes >> 32).astype(np.int32) * ROWS
    first = np.zeros(len(ids) + 1, bool)
    first[starts] = True
    lone = first.copy()             # nothing stands two words before the first and the second
    lone[starts + 1] = True
    padded = np.concatenate([[0, 0], ids])
    for at in range(0, len(ids), CHUNK):
        to = min(at + CHUNK, len(ids))
        last = np.where(first[at:to], U(0), named[padded[at + 1:to + 1]])
        skip = np.where(lone[at:to], U(0), named[padded[at:to]])
        rows = np.empty((to - at, 4), np.int32)
        rows[:, 0] = base[ids[at:to]]
        for k, feature in enumerate((last, mixed(skip + U(1)), mixed(last * GOLDEN + skip)), 1):
            rows[:, k] = rows[:, 0] + 1 + ((feature >> U(20)) % U(ROWS - 1)).astype(np.int32)
        yield at, rows


def added_weights(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    raw = weights.take(rows[:, 0], axis=0)
    for k in range(1, rows.shape[1]):
        raw += weights.take(rows[:, k], axis=0)
    return raw


def bucket_chances(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The second softmax: a row of chances of the buckets for each row of features."""
    raw = added_weights(weights, rows)
    top = raw
    while top.shape[1] % 2 == 0:    # by halves, which takes whole columns at a time
        top = np.maximum(*np.split(top, 2, axis=1))
    raw -= top.max(axis=1, keepdims=True)
    np.exp(raw, out=raw)
    raw /= raw.sum(axis=1, keepdims=True)
    return raw


def quick_chances(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """As :func:`bucket_chances`, in half the time where all exponentials have room without a shift."""
    with np.errstate(over="ignore"):
        chances = np.exp(added_weights(weights, rows))
        total = np.einsum("ij->i", chances)
    if not ((total > 1e-10) & (total < 1e10)).all():
        return bucket_chances(weights, rows)
    chances /= total[:, None]
    return chances


def expected_counts(weights: np.ndarray, rows: np.ndarray, into: np.ndarray) -> None:
    """Add to ``into`` what the second softmax expects in each cell of the features, for tokens with these rows.

    Biases are left out: every token has one and three other rows, so they follow from these (:func:`with_biases`).
    """
    cells = into.reshape(-1, BUCKETS)
    kind = np.min_scalar_type(len(cells))   # numbers of two bytes are sorted by their bytes
    rows = rows.take(np.argsort(rows[:, 1].astype(kind), kind="stable"), axis=0)   # which brings a class together
    for at in range(0, len(rows), CHUNK):
        part = rows[at:at + CHUNK]
        chances = quick_chances(weights, part)
        for k in range(1, rows.shape[1]):
            row = part[:, k].astype(kind)
            order = np.argsort(row, kind="stable")
            row = row[order]
            firsts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            cells[row[firsts]] += np.add.reduceat(chances.take(order, axis=0), firsts, axis=0)


def with_biases(cells: np.ndarray) -> np.ndarray:
    """The cells (class and row, bucket) with those of the biases, a third of the sum over the class's other rows."""
    cells = cells.reshape(OUTPUTS, ROWS, BUCKETS)
    cells[:, 0] = cells[:, 1:].sum(axis=1) / 3
    return cells.reshape(OUTPUTS * ROWS, BUCKETS)


def planes(ids: np.ndarray) -> np.ndarray:
    """Numbers as bytes, lowest bytes first: small numbers compress well that way."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.ravel()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    cells, schema = np.zeros(CONTEXTS * CONTEXTS * OUTPUTS, np.int64), None
    word_cells = np.zeros(OUTPUTS * ROWS * BUCKETS, np.int64)
    for number, (rows, texts) in enumerate(in_blocks(batches, "text", BLOCK_BYTES, BLOCK_ROWS)):
        block = Words(texts, close=END)
        learn = ~np.asarray(rows.column(1).to_pylist(), bool)
        schema = schema or pa.schema([
            ("kind", pa.int32()), ("block", pa.string()), rows.schema.field(0), ("held_out", pa.bool_()),
            ("ids", pa.binary()), ("word", pa.binary()), ("number", pa.int32()), ("class", pa.int32()),
            ("n", pa.int64())])
        codes = codes_of(block.words)
        mine = learn[block.owner()]
        name = f"{part}-{number}"
        packed = [planes(block.ids[a:b]) for a, b in zip(block.starts.tolist(), block.ends.tolist())]
        yield _rows(schema, 0, rows.num_rows, block=pa.array([name] * rows.num_rows), id=rows.column(0),
                    held_out=rows.column(1), ids=binaries(np.concatenate(packed), block.ends * 4))
        counts = np.bincount(block.ids[mine], minlength=len(block.words))
        for at in range(0, len(block.words), 50_000):
            words = block.words[at:at + 50_000]
            yield _rows(schema, 1, len(words), block=pa.array([name] * len(words)), word=pa.array(words, pa.binary()),
                        number=pa.array(np.arange(at, at + len(words), dtype=np.int32)),
                        n=pa.array(counts[at:at + len(words)]))
        seen = (codes >> 32)[block.ids]
        cell = contexts(seen, block.starts) * OUTPUTS + seen
        cells += np.bincount(cell[mine], minlength=len(cells))
        of_words, buckets = mine & (seen > 0), bucket_of(codes)
        for chunks in batched(word_rows(codes, block.ids, block.starts), FLUSH):
            found = []
            for at, rows_of in chunks:
                use = np.flatnonzero(of_words[at:at + CHUNK])
                bucket = buckets[block.ids[at:at + CHUNK][use]]
                found.append((rows_of[use, 1:] * np.int64(BUCKETS) + bucket[:, None]).ravel())
            word_cells += np.bincount(np.concatenate(found), minlength=word_cells.size)
    if schema is not None:
        found = np.flatnonzero(cells)
        yield _rows(schema, 2, len(found), number=pa.array((found // OUTPUTS).astype(np.int32)),
                    **{"class": pa.array((found % OUTPUTS).astype(np.int32))}, n=pa.array(cells[found]))
        yield _rows(schema, 3, OUTPUTS, number=pa.array(np.full(OUTPUTS, part, np.int32)),
                    **{"class": pa.array(np.arange(OUTPUTS, dtype=np.int32))}, ids=packed_tables(word_cells))


def packed_tables(cells: np.ndarray) -> pa.Array:
    """The table of each class as bytes."""
    return pa.array([t.tobytes() for t in cells.astype("<f4").reshape(OUTPUTS, -1)], pa.binary())


def _rows(schema: pa.Schema, kind: int, count: int, **columns: pa.Array) -> pa.RecordBatch:
    """A batch of one kind of row; columns that the kind lacks are null."""
    columns["kind"] = pa.array(np.full(count, kind, np.int32))
    return pa.RecordBatch.from_arrays(
        [columns.get(f.name, None) if f.name in columns else pa.nulls(count, f.type) for f in schema], schema=schema)


def cut(given: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The numbered texts, the words of each block, the counted contexts, and the tasks' counts of buckets by feature.

    ``given`` has (id, held_out, text); what is returned is read from the shared folder.
    """
    kind = dict(given.dtypes)["id"]
    path = shared_dir(given.sparkSession, "lm")
    columns = (f"kind int, block string, id {kind}, held_out boolean, ids binary, word binary, number int, "
               "class int, n bigint")
    given.mapInArrow(_cut, columns).write.partitionBy("kind").option("compression", "zstd").parquet(path)

    def rows(number: int) -> DataFrame:
        return given.sparkSession.read.schema(columns).parquet(path).where(F.col("kind") == number)

    return (rows(0).select("block", "id", "held_out", "ids"),
            rows(1).select("block", "word", "number", "n"),
            rows(2).select(F.col("number").alias("context"), "class", "n"),
            rows(3).select("class", F.col("number").alias("part"), F.col("ids").alias("cells")))


def fit(events: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """The weights of the class softmax from (context, class, n), by full gradients.

    A context has at most ``OUTPUTS`` rows and there are at most ``CONTEXTS`` squared of them, so what a job returns,
    a number per weight, is bounded by the parameters; how many tokens they stand for is not.
    """
    events = stored(events.groupBy("context", "class").agg(F.sum("n").alias("n")).groupBy("context").agg(
        F.collect_list("class").alias("classes"), F.collect_list("n").alias("ns")), "events")
    weights = np.zeros((FEATURES, OUTPUTS))

    def gradient(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, expected = np.zeros((FEATURES, OUTPUTS)), np.zeros((FEATURES, OUTPUTS))
        for batch in batches:
            context = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            counts = np.zeros((len(context), OUTPUTS))
            counts[np.repeat(np.arange(len(context)), sizes), batch.column(1).flatten()] = batch.column(2).flatten()
            rows = feature_rows(context)
            model = np.exp(log_softmax(weights, rows)) * counts.sum(axis=1, keepdims=True)
            for k in range(rows.shape[1]):
                np.add.at(seen, rows[:, k], counts)
                np.add.at(expected, rows[:, k], model)
        used = np.flatnonzero(seen.any(axis=1))
        cells = (used[:, None] * OUTPUTS + np.arange(OUTPUTS)).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells), pa.array(seen.ravel()[cells]), pa.array(expected.ravel()[cells])],
            ["cell", "seen", "expected"])

    for _ in range(rounds):
        total = (events.mapInArrow(gradient, "cell bigint, seen double, expected double")
                 .groupBy("cell").agg(F.sum("seen"), F.sum("expected")).toArrow())
        cell, seen, expected = (c.to_numpy() for c in total.columns)
        step = (seen - expected) / (np.maximum(seen, expected) + DAMPING)
        np.add.at(weights.reshape(-1), cell, np.where(cell < OUTPUTS, BIAS_STEP, STEP) * step)
    return weights


def summed(tables: DataFrame) -> np.ndarray:
    """The sum of the tasks' tables (class, part, cells): by class and salt, then by class, so the driver gets one table."""
    def adder(kind: str):
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {}
            for batch in batches:
                for number, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    sums[number] = sums.get(number, 0) + np.frombuffer(cells, kind).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(
                [s.astype("<f8").tobytes() for s in sums.values()], pa.binary())], ["class", "cells"])
        return add

    columns = "class int, cells binary"
    salted = tables.where("class > 0").repartition("class", F.col("part") % SALTS).select("class", "cells")
    found = salted.mapInArrow(adder("<f4"), columns).repartition("class").mapInArrow(adder("<f8"), columns)
    total = np.zeros((OUTPUTS, ROWS * BUCKETS))
    for row in found.toArrow().to_pylist():
        total[row["class"]] = np.frombuffer(row["cells"], "<f8")
    return with_biases(total)


def nudge(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """The step of the weights in a round, along the gradient: up where more was seen than expected."""
    return WORD_STEP * np.log((seen + WORD_DAMPING) / (expected + WORD_DAMPING))


def fit_words(given: DataFrame, tables: DataFrame, rounds: int = WORD_ROUNDS) -> np.ndarray:
    """The weights of the second softmax, of a size that the parameters fix, by full gradients over all training texts."""
    seen = summed(tables)
    in_class = seen[::ROWS]
    share = in_class / np.maximum(in_class.sum(axis=1, keepdims=True), 1)
    weights = np.zeros_like(seen)
    weights[::ROWS] = np.where(share > 0, np.log(np.maximum(share, 1e-15)), EMPTY)
    if not rounds:
        return weights
    weights += nudge(seen, seen.sum(axis=1, keepdims=True) * np.repeat(share, ROWS, axis=0))
    training = given.where(~F.coalesce("held_out", F.lit(False))).select("text")
    for _ in range(rounds - 1):
        shared = given.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            into = np.zeros(OUTPUTS * ROWS * BUCKETS)
            for _, texts in in_blocks(batches, "text", READ_BYTES, READ_ROWS):
                codes, starts = codes_in_order(texts)   # ends are not drawn, and stand before no word
                for chunks in batched(word_rows(codes, np.arange(len(codes), dtype=np.int32), starts), FLUSH):
                    expected_counts(shared.value, np.concatenate([rows for _, rows in chunks]), into)
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(OUTPUTS, dtype=np.int32)), pa.array(np.full(OUTPUTS, part, np.int32)),
                 packed_tables(into)], ["class", "part", "cells"])

        weights += nudge(seen, summed(training.mapInArrow(expect, "class int, part int, cells binary")))
        shared.destroy()
    return weights


def scores(docs: DataFrame, id_col: str = "doc_id", text: str = "text", held_out=None,
           rounds: int = ROUNDS, word_rounds: int = WORD_ROUNDS) -> DataFrame:
    """Each row's (id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    ``held_out`` is the column that says which texts are not learned from.  Both scores are sums of log10
    probabilities.  Runs jobs while it is called; what they find is in the shared folder.
    """
    spark = docs.sparkSession
    held_out = F.lit(False) if held_out is None else held_out
    given = docs.select(F.col(id_col).alias("id"), held_out.alias("held_out"), F.col(text).alias("text"))
    texts, words, events, tables = cut(given)
    counts = stored(words.groupBy("word").agg(F.sum("n").alias("count")).where("count > 0"), "counts")
    leaf = code("word")
    per_bucket = counts.groupBy(
        F.shiftright(leaf, 32).cast("int").alias("class"), (leaf % BUCKETS).cast("int").alias("bucket")).agg(
        F.sum("count").alias("n"), F.count(F.lit(1)).alias("v"),
        F.count_if(F.col("count") == 1).alias("once"), F.count_if(F.col("count") == 2).alias("twice")).collect()
    stats = np.zeros((4, OUTPUTS, BUCKETS))
    for row in per_bucket:
        stats[:, row["class"], row["bucket"]] = row["n"], row["v"], row["once"], row["twice"]
    size, kinds, once, twice = stats.sum(axis=2)
    discount = (once + 0.5) / (once + 2 * twice + 1)
    discount[0] = 0   # the end is one event
    unseen = np.where(size > 0, discount * kinds / np.maximum(size, 1), 1.0)   # all, if there are no tokens
    room = stats[0] - discount[:, None] * stats[1]
    tokens = int(size.sum())
    base_room = tokens + int(kinds.sum()) + 1
    shared = spark.sparkContext.broadcast((
        fit(events, rounds), fit_words(given, tables, word_rounds).astype(np.float32), (discount, unseen, room), tokens,
        np.log10(float(base_room))))

    def score(numbered: pa.Table, block_words: pa.Table) -> pa.Table:
        weights, word_weights, (discount, unseen, room), n, base = shared.value
        count = np.zeros(block_words.num_rows, np.int64)
        codes = np.zeros(block_words.num_rows, np.int64)
        at = block_words["number"].to_numpy()
        count[at], codes[at] = block_words["count"].to_numpy(), block_words["code"].to_numpy()
        kind, bucket, known = codes >> 32, bucket_of(codes), count > 0
        packed = numbered["ids"].to_pylist()
        ids = np.concatenate([np.ascontiguousarray(np.frombuffer(p, np.uint8).reshape(4, -1).T).view("<u4").ravel()
                              for p in packed]).astype(np.int64)
        sizes = np.array([len(p) // 4 for p in packed])
        starts = np.cumsum(sizes) - sizes
        classes = kind[ids]
        context, where = np.unique(contexts(classes, starts), return_inverse=True)
        by_context = log_softmax(weights, feature_rows(context)) / np.log(10)
        per_word = np.log10(count + 1.0)
        inside = np.log10(np.maximum(unseen, 1e-300))[kind]
        inside[known] = np.log10((1 - unseen[kind]) * (count - discount[kind]) / np.where(known, room[kind, bucket], 1))[known]
        log_class = by_context[where, classes] + inside[ids]
        drawn = known & (codes > 0)
        for first, rows in word_rows(codes, ids, starts):
            use = np.flatnonzero(drawn[ids[first:first + CHUNK]])
            chances = bucket_chances(word_weights, rows[use])
            log_class[first + use] += np.log10(chances[np.arange(len(use)), bucket[ids[first + use]]])
        return pa.table({
            "id": numbered["id"], "held_out": numbered["held_out"], "n_tokens": pa.array(sizes),
            "n_known": pa.array(np.add.reduceat((count > 0)[ids].astype(np.int64), starts)),
            "train_tokens": pa.array(np.full(len(sizes), n, np.int64)),
            "base_score": pa.array(np.add.reduceat((per_word - base)[ids], starts)),
            "score": pa.array(np.add.reduceat(log_class, starts))})

    counted = words.join(counts, "word", "left").select(
        "block", "number", code("word").alias("code"), F.coalesce("count", F.lit(0)).alias("count"))
    kind = dict(texts.dtypes)["id"]
    found = texts.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(
        score, f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
               "base_score double, score double")
    return found.withColumnRenamed("id", id_col)
