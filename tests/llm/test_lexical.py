"""Ranked lexical search against a plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from footfall.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(items, docs, top):
    held = [(i, Counter(TERM.findall((t or "").translate(FOLD)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 50 + 50 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(TERM.findall((text or "").translate(FOLD))) if t in c)
            if score > 0:
                scores.append((-score, i is not None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:top])]
    return out


def rows_of(df):
    return sorted(map(str, map(tuple, df.select("item_id", "rank", "doc_id", "score").collect())))


def made(seed=3, n=900):
    """Texts on a few topics, some of them copies, with common words in all."""
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        topic = rng.randint(0, 14)
        words = [f"t{topic}x{min(rng.randint(0, 60), rng.randint(0, 60))}" for _ in range(rng.randint(0, 40))]
        words += [f"common{rng.randint(0, 8)}" for _ in range(rng.randint(0, 30))]
        docs.append((i, " ".join(words)) if rng.random() > 0.1 or not docs else (i, docs[-1][1]))
    items = [(k, " ".join([f"t{k % 15}x{rng.randint(0, 60)}" for _ in range(12)] + [f"COMMON{j}" for j in range(5)])) for k in range(30)]
    return items, docs


ODD = [(None, "t1x1 T1X1 common1"), (None, "t1x1 t1x1 Common1"), (1000, None), (1001, ""), (1002, "--- !!"), (1003, "É_t1x1É t1x1"),
       (5, "t1x1 repeated id"), (5, "t1x1 repeated id"), (1004, "t2x2 " * 30_000), (1005, "x" * 200_000)]


@pytest.mark.parametrize("top,block_terms,cells", [(50, 8192, 8 << 20), (3, 60, 8 << 20), (7, 8192, 64 * 100)])
def test_equals_plain_scoring(spark, monkeypatch, top, block_terms, cells):
    items, docs = made()
    docs, items = docs + ODD, [*items, (3, "t1x1 common1"), (3, "t1x1 common1"), (None, "T2x2"), (98, None), (99, "nowhere"), (100, "...")]
    rows = spark.createDataFrame([(*d, 1, "x", "y") for d in docs], "doc_id long, text string, n long, item string, `a.b` string").repartition(5)
    asked = spark.createDataFrame([(*i, "x", 7) for i in items], "item_id long, text string, doc_id string, terms int")
    monkeypatch.setattr(lexical, "SEGMENT_CELLS", cells)
    found = lexical.ranked(asked, rows, top=top, block_terms=block_terms)
    assert rows_of(found) == sorted(map(str, plain(items, docs, top)))


def test_skipped_blocks_hold_no_result():
    rng = np.random.default_rng(2)
    matrix = np.zeros((600, 60))
    for i in range(600):   # six topics, each with three kinds of documents
        at = rng.permutation(10)[:6] + 10 * (i % 6)
        matrix[i, at] = rng.integers(1, 100, 6) * (1, 5, 25)[i // 6 % 3]
    items = [np.unique(rng.integers(0, 10, 5) + 10 * k) for k in range(6)]
    scores = [matrix[:, t].sum(axis=1) for t in items]
    least = [float(np.sort(s)[-10]) for s in scores]
    may, skipped, blocks = lexical.candidates(matrix, items, least)
    assert all(may[k][scores[k] >= least[k]].all() for k in range(6))
    assert 0.4 * blocks < skipped < blocks and may.sum() < 0.75 * sum((s > 0).sum() for s in scores)


def test_blocks_are_the_list_in_another_order():
    rng = np.random.default_rng(4)
    members, sketches = np.flatnonzero(rng.random(500) < 0.5), rng.standard_normal((500, lexical.SKETCH))
    order, starts = lexical.clustered(members, sketches, 16)
    assert sorted(order) == sorted(members) and starts[0] == 0
    assert np.diff(np.append(starts, len(order))).max() <= 16


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.ranked(items, docs.limit(0)).collect() == []
    assert lexical.ranked(items.limit(0), docs).collect() == []
    assert lexical.ranked(items.limit(0), docs).columns == lexical.ranked(items, docs).columns
