import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

from footfall.llm import lm, queries
from footfall.llm.blocks import LOWER

from .conftest import ROWS


def tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(LOWER)), None]


def check(found, rows, held_out):
    counts = Counter(t for i, text in rows if not held_out(i) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    expected = sorted((sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(text)), len(tokens(text)),
                       sum(counts[t] > 0 for t in tokens(text))) for _, text in rows)
    got = sorted((r.base_score, r.n_tokens, r.n_known) for r in found)
    assert {r.train_tokens for r in found} == {n}
    assert [g[1:] for g in got] == [e[1:] for e in expected]
    assert [g[0] for g in got] == pytest.approx([e[0] for e in expected])


def test_base_scores_and_a_better_model(spark, docs):
    held_out = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    found = queries.op10_lm(spark, "/root/testdata/sf0.001").collect()
    check(found, [(r.doc_id, r.text) for r in docs.collect()], held_out)
    assert all(r.held_out == held_out(r.doc_id) for r in found)
    out = [r for r in found if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_probabilities_add_up():
    weights = np.random.default_rng(1).normal(size=(lm.FEATURES, lm.OUTPUTS))
    rows = lm.feature_rows(np.arange(lm.CONTEXTS * lm.CONTEXTS))
    assert np.exp(lm.log_softmax(weights, rows)).sum(axis=1) == pytest.approx(1)


def test_training_raises_the_likelihood(spark):
    events = spark.createDataFrame([(1, 3, 50), (1, 4, 50), (70, 5, 100), (71, 3, 10)], "context int, class int, n long")
    log = lm.log_softmax(lm.fit(events, 30), lm.feature_rows(np.array([1, 70])))
    assert np.exp(log[0, 3]) > 0.35 and np.exp(log[1, 5]) > 0.7


def test_odd_rows(odd, none):
    found = lm.scores(odd).collect()
    check(found, ROWS, lambda i: False)
    assert all(r.score < 0 for r in found)
    untrained = lm.scores(odd, held_out=lm.F.lit(True)).collect()
    check(untrained, ROWS, lambda i: True)
    assert lm.scores(none).count() == 0


def looped(rows, held_out, word_rounds):
    """The model by plain loops over tokens, but for the weights of the class softmax, which have tests of their own."""
    texts = {i: [w or lm.END for w in tokens(t)] for i, t in rows}
    training = [ws for i, ws in texts.items() if not held_out(i)]
    counts = Counter(w for ws in training for w in ws)
    code = {w: int(lm.codes_of([w])[0]) for ws in texts.values() for w in ws}
    kind = {w: c >> 32 for w, c in code.items()}
    bucket = {w: c % lm.BUCKETS for w, c in code.items()}

    def features(ws, k):
        numbers = np.arange(len(ws), dtype=np.int32)
        chunks = lm.word_rows(np.array([code[w] for w in ws]), numbers, np.array([0]))
        return np.concatenate([r for _, r in chunks])[k].tolist()

    places = [(features(ws, k), bucket[ws[k]]) for ws in training for k in range(len(ws) - 1)]
    seen = Counter((f, b) for fs, b in places for f in fs)
    weight = Counter()
    for c in range(1, lm.OUTPUTS):
        of_class = [seen[c * lm.ROWS, b] for b in range(lm.BUCKETS)]
        for b, n in enumerate(of_class):
            weight[c * lm.ROWS, b] = math.log(n / sum(of_class)) if n else lm.EMPTY

    def chances(fs):
        raw = [math.exp(sum(weight[f, b] for f in fs)) for b in range(lm.BUCKETS)]
        return [x / sum(raw) for x in raw]

    for _ in range(word_rounds):
        expected = Counter()
        for fs, _ in places:
            for b, p in enumerate(chances(fs)):
                for f in fs:
                    expected[f, b] += p
        for cell in expected:
            weight[cell] += lm.WORD_STEP * math.log((seen[cell] + lm.WORD_DAMPING) / (expected[cell] + lm.WORD_DAMPING))

    discount, unseen, room = {}, {}, Counter()
    for c in range(1, lm.OUTPUTS):
        of_class = [n for w, n in counts.items() if kind[w] == c]
        once, twice = of_class.count(1), of_class.count(2)
        discount[c] = (once + 0.5) / (once + 2 * twice + 1)
        unseen[c] = discount[c] * len(of_class) / sum(of_class) if of_class else 1
    for w, n in counts.items():
        if w != lm.END:
            room[kind[w], bucket[w]] += n - discount[kind[w]]

    def inside(ws, k):
        w = ws[k]
        if w == lm.END:
            return 0.0
        if not counts[w]:
            return math.log10(unseen[kind[w]])
        share = (counts[w] - discount[kind[w]]) / room[kind[w], bucket[w]]
        return math.log10((1 - unseen[kind[w]]) * chances(features(ws, k))[bucket[w]] * share)

    return {i: sum(inside(ws, k) for k in range(len(ws))) for i, ws in texts.items()}


def test_scores_equal_plain_loops(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(["king", "ling", "ring", "string", "Sing", "the", "a", "of", "wing"], rng.integers(0, 9))))
            for i in range(40)] + [(100, "never met thing"), (101, ""), (102, "king nothing")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held_out = lambda i: i >= 100
    # without rounds the class softmax is even, so the rest of the score is the words'
    found = {r.doc_id: r for r in lm.scores(docs, held_out=lm.F.col("doc_id") >= 100, rounds=0, word_rounds=3).collect()}
    expected = looped(rows, held_out, 3)
    for i, r in found.items():
        assert r.score + r.n_tokens * math.log10(lm.OUTPUTS) == pytest.approx(expected[i], rel=1e-4, abs=1e-5)


def test_word_order_counts(spark):
    rows = [(i, "alpha king runs fast" if i % 2 else "kelp ling swims slow") for i in range(40)]
    rows += [(100, "alpha king runs fast"), (101, "alpha ling runs fast"), (102, "kelp king swims slow")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    score = {r.doc_id: r.score for r in lm.scores(docs, held_out=lm.F.col("doc_id") >= 100).collect()}
    assert max(score[101], score[102]) < score[100] - 0.5


def test_chances_of_buckets_add_up():
    weights = np.random.default_rng(1).normal(size=(lm.OUTPUTS * lm.ROWS, lm.BUCKETS))
    words = [w.encode() for w in "a b c d b c king ling thing".split()]
    (at, rows), = lm.word_rows(lm.codes_of(words), np.arange(len(words), dtype=np.int32), np.array([0, 4]))
    chances = lm.bucket_chances(weights, rows)
    into = np.zeros(weights.size)
    lm.expected_counts(weights, rows, into)
    assert at == 0 and chances.sum(axis=1) == pytest.approx(1)
    assert lm.with_biases(into).sum() == pytest.approx(4 * len(words)) and into.reshape(weights.shape)[rows[0, 0]].sum() == pytest.approx(
        chances[rows[:, 0] == rows[0, 0]].sum())


def test_expected_counts_by_bucket_equal_those_token_by_token():
    """Also in a table that has a bucket's cells next to each other."""
    some = np.random.default_rng(3)
    weights = some.normal(size=(lm.OUTPUTS * lm.ROWS, lm.BUCKETS)).astype(np.float32)
    rows = some.integers(0, len(weights), (500, 4)).astype(np.int32)
    rows[1::2, 1] = rows[::2, 1]
    want = np.zeros(weights.shape)
    for one, chance in zip(rows, lm.bucket_chances(weights, rows)):
        raw = weights[one].sum(axis=0)
        assert chance == pytest.approx(np.exp(raw - raw.max()) / np.exp(raw - raw.max()).sum(), rel=1e-4)
        for feature in one[1:]:
            want[feature] += chance
    for into in (np.zeros(weights.size), np.zeros(weights.shape[::-1]).T):
        lm.expected_counts(weights, rows, into)
        assert np.allclose(into.reshape(weights.shape), want)


def test_codes_in_order_equal_those_of_each_word():
    """Also of long words, of none, and where white space or one word is most of the text; found in less time than by numbering words."""
    rng = np.random.default_rng(5)
    texts = [b"", b"King KING a ab abc abcd", b" \t\r\n\x0b\x0c", "\u00e9l\u00e9 \u00c9\u00a0x\u2003y \x1c\x85".encode(), b"\xff\x00 \x00\x08\x0e",
             b"x" * 31 + b" " + b"y" * 32 + b"  " + b"z" * 33 + b" " + b"long" * 30, b"  a  b ", b"", b"w" * 1_000_000 + b" v", b" " * 500_000 + b"end",
             b"", *(bytes(rng.integers(0, 256, 400, np.uint8)) for _ in range(200)), b"last", b" "]
    for some in (texts, texts[:1], texts[2:3], texts[:3], texts[8:9], [b"one"], []):
        codes, starts = lm.codes_in_order(some)
        words = [t.translate(LOWER).split() for t in some]
        assert codes.tolist() == lm.codes_of([w for ws in words for w in ws]).tolist()
        sizes = np.array([len(ws) for ws in words if ws], int)
        assert starts.tolist() == (np.cumsum(sizes) - sizes).tolist()

    many = [b" ".join(b"%x" % n for n in rng.integers(0, 1 << 40, 300)) for _ in range(1000)]
    spent = {lm.codes_in_order: [], lm.Words: []}
    for _ in range(3):
        for way, times in spent.items():
            start = time.process_time()
            way(many)
            times.append(time.process_time() - start)
    assert min(spent[lm.codes_in_order]) < min(spent[lm.Words])


def test_features_without_ends_equal_those_with_them():
    texts = [b"", b"king", b"a king ran", b"", b"", b"a b", b"ling", b""]
    block = lm.Words(texts, close=lm.END)
    codes = lm.codes_of(block.words)
    with_ends = np.concatenate([rows for _, rows in lm.word_rows(codes, block.ids, block.starts)])[codes[block.ids] > 0]
    codes, starts = lm.codes_in_order(texts)
    assert (np.concatenate([rows for _, rows in lm.word_rows(codes, np.arange(len(codes)), starts)]) == with_ends).all()


@pytest.mark.parametrize("shift", [0, 60, -60, 1000])
def test_chances_of_weights_far_from_nought(shift):
    """Chances do not change when all weights of a token do, also where their exponentials have no room in a float."""
    some = np.random.default_rng(4)
    weights = some.normal(size=(40, lm.BUCKETS)).astype(np.float32)
    rows = some.integers(0, 40, (60, 4))
    moved = weights.copy()
    moved[rows[0, 0]] += np.float32(shift)
    want = weights.astype(float)[rows].sum(axis=1)
    want = np.exp(want) / np.exp(want).sum(axis=1, keepdims=True)
    assert lm.bucket_chances(moved, rows) == pytest.approx(want, rel=2e-3)
    assert lm.quick_chances(moved, rows) == pytest.approx(want, rel=2e-3)


def test_codes_in_spark_and_in_python(spark):
    words = [b"a", b"ab", b"abc", b"abcd", "\u00e9l\u00e9".encode(), b"\xff\xfe", lm.END, b"king"]
    rows = spark.createDataFrame([(w,) for w in words], "word binary")
    assert {bytes(r.word): r.code for r in rows.select("word", lm.code("word").alias("code")).collect()} == dict(
        zip(words, lm.codes_of(words).tolist()))
