import math
import zlib

import pytest

from footfall.llm import quality, queries

from .conftest import ROWS

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = queries.op9_quality(spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id]).all()
    both = rows.merge(labels, on="doc_id")
    out = both[both.held_out]
    assert (out.predicted == out.quality).mean() > 0.95
    assert out[out.quality == 1].predicted.mean() > 0.97


def test_scores_of_words_add_up():
    texts = [b"the cat the cat sat", b"", b"x"]
    weights = quality.np.random.default_rng(1).normal(size=quality.BUCKETS)
    rows, counts, ends = quality.features(texts)
    found = quality.probabilities(texts, weights, 0.25)
    for i, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
        mean = (weights[rows[a:b]] * counts[a:b]).sum() / max(1, counts[a:b].sum())
        assert found[i] == pytest.approx(1 / (1 + quality.np.exp(-mean - 0.25)))


def plain_fit(samples, seed=1):
    """One number after another: averaged embeddings, softmax, and steps against the gradient."""
    rng = quality.np.random.default_rng(seed)
    size = quality.DIMENSIONS
    table = (rng.uniform(-1, 1, (quality.BUCKETS, size)) / size).tolist()
    output, bias = [[0.0] * size, [0.0] * size], [0.0, 0.0]
    step, steps = 0, quality.EPOCHS * len(samples)
    for _ in range(quality.EPOCHS):
        for i in rng.permutation(len(samples)).tolist():
            rows, counts, label = samples[i]
            rate = quality.RATE * (1 - step / steps)
            step += 1
            total = max(1, sum(counts))
            mean = [sum(n / total * table[r][d] for r, n in zip(rows, counts)) for d in range(size)]
            raw = [sum(o * m for o, m in zip(output[k], mean)) + bias[k] for k in (0, 1)]
            parts = [math.exp(x - max(raw)) for x in raw]
            error = [p / sum(parts) - (k == label) for k, p in enumerate(parts)]
            back = [error[0] * output[0][d] + error[1] * output[1][d] for d in range(size)]
            for k in (0, 1):
                output[k] = [o - rate * error[k] * m for o, m in zip(output[k], mean)]
                bias[k] -= rate * 0.1 * error[k]
            for r, n in zip(rows, counts):
                table[r] = [t - rate * min(n / total * len(rows), 20.0) * b for t, b in zip(table[r], back)]
    return [sum(t[d] * (output[1][d] - output[0][d]) for d in range(size)) for t in table], bias[1] - bias[0]


def plain_features(text):
    rows, counts, _ = quality.features([text])
    return rows.tolist(), counts.tolist()


def test_training_equals_a_plain_loop(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.where("n_chars < 600").orderBy("doc_id").limit(40).collect()]
    labelled = [(i, i % 2) for i, _ in rows]
    some = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = quality.train(some, spark.createDataFrame(labelled, "doc_id long, quality int")).value
    samples = [(*plain_features(t.encode()), i % 2) for i, t in sorted(rows) if zlib.crc32(str(i).encode()) % 3 != 1]
    weights, bias = plain_fit(samples)
    assert model[0] == pytest.approx(weights, abs=1e-9) and model[1] == pytest.approx(bias, abs=1e-9)


def test_sample_is_bounded_in_features(spark):
    texts = [(i, " ".join(f"{w}{i}" for w in "abcdefgh")) for i in range(60)]
    some = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    few = quality.train(some, labels, sample_features=200).value
    again = quality.train(some.repartition(4), labels, sample_features=200).value
    none = quality.train(some, labels, sample_features=0).value
    assert (few[0] == again[0]).all() and few[0].any() and not none[0].any()


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame(
        [(4, 1), (5, 0), (6, 1), (6, 0), (7, 1), (None, 1), (11, None), (99, 1)], "doc_id long, quality int")
    model = quality.train(odd, labels)
    rows = quality.scored(odd.drop("score"), model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").split()}) == 1
    assert quality.keep_good(spark, odd, labels).columns == odd.columns
    empty = quality.train(none, labels.limit(0))
    assert {r.score for r in quality.scored(odd, empty).collect()} == {0.5}
    assert quality.scored(none, model).count() == 0
