"""Periodic runs against a plain search by period, the query against its definition, odd rows."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from footfall.llm import periodic
from footfall.llm.blocks import Words
from footfall.llm.queries import op13_periodic_runs


LONG_ID = next(i for i in range(3 * 10 ** 9, 4 * 10 ** 9) if zlib.crc32(str(i).encode()) % 10)


def plain_runs(words, least=periodic.LEAST, times=periodic.TIMES):
    """Stretches that agree with themselves ``q`` words on, for one period after another; a run keeps its smallest."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_row(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = b" ".join(w for i, w in enumerate(words) if i not in drop)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_all_runs_of_two_periods():
    rng = random.Random(5)
    for _ in range(1500):
        n, k = rng.randint(1, 40), rng.randint(1, 3)
        words = [rng.randint(1, k) for _ in range(n)]
        if rng.random() < 0.3:
            words = (words[:rng.randint(1, 9)] * n)[:n]
        assert sorted(map(tuple, periodic.runs_of(words).tolist())) == sorted(plain_runs(words, 2, 2))


def test_stretches_lose_no_run():
    rng = random.Random(6)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 5)):
            words = []
            for _ in range(rng.randint(0, 4)):
                root = [f"w{rng.randint(0, rng.choice([1, 3, 50]))}" for _ in range(rng.randint(1, 14))]
                words += (root * 30)[:rng.randint(0, 90)] + [f"w{rng.randint(0, 40)}" for _ in range(rng.randint(0, 10))]
            texts.append(" ".join(words).encode())
        for text, found in zip(texts, periodic.found_runs(Words(texts, lower=False))):
            assert found == sorted(plain_runs(text.split()), key=lambda r: (r[0], r[2]))


def test_collapse_and_greatest():
    runs = [(2, 30, 3), (10, 40, 4), (60, 24, 8)]
    words = [b"%d" % i for i in range(90)]
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    assert periodic.collapsed(words, runs) == b" ".join(w for i, w in enumerate(words) if i not in drop)
    assert periodic.greatest(runs) == 0 and periodic.greatest([]) is None   # 10 periods twice: the first to start
    with pytest.raises(ValueError):
        periodic.periodic_runs("text", 24, 2)


def test_query_equals_its_definition(spark, docs, tmp_path):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    long = " ".join(f"w{i % 700}" for i in range(30_000))
    rows += [(None, "a b c " * 20), (None, None), (10 ** 9, None), (10 ** 9 + 1, ""), (10 ** 9 + 2, " \n\t"), (5, "x " * 24), (5, "x " * 23),
             (LONG_ID, long), (LONG_ID, long), (7, "É x \x1c y " * 9), *[(2 * 10 ** 9 + i, f"one two three {i}") for i in range(60)]]
    made = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, found string, `a.b` string")
    made.write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(map(str, map(tuple, op13_periodic_runs(spark, str(tmp_path)).collect())))
    short = [r for r in rows if r[1] is not long]
    expected = sorted(str(plain_row(*r)) for r in short)
    assert len(found) == len(rows) and [r for r in found if not r.startswith(f"({LONG_ID}, ")] == expected
    deep = [r for r in found if r.startswith(f"({LONG_ID}, ")]
    assert len(deep) == 2 and deep[0] == deep[1] and deep[0].startswith(f"({LONG_ID}, 1, 0, 30000, 700, 42857, ")


def test_column_keeps_other_columns_and_empty_tables(odd, none):
    out = odd.withColumn("found", periodic.periodic_runs())
    assert out.columns == [*odd.columns, "found"] and out.count() == odd.count()
    by_text = {r.text: r.found for r in out.collect()}
    assert by_text[None].runs == [] and by_text[None].collapsed == "" and by_text[None].best is None
    assert none.withColumn("found", periodic.periodic_runs()).collect() == []
