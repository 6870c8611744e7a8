import itertools

import numpy as np

from footfall.llm import near_dedup
from footfall.llm.blocks import Words

from .conftest import ROWS


def brute(texts):
    """Class numbers by comparing all pairs of multisets of shingles."""
    keys, ends = near_dedup.units(Words([t.encode() for t in texts]))
    sets = [set(keys[a:b].tolist()) for a, b in zip([0, *ends[:-1]], ends)]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        common = len(sets[i] & sets[j])
        if texts[i] == texts[j] or common and common >= 0.8 * (len(sets[i]) + len(sets[j]) - common):
            parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))]


def test_signatures_are_unbiased():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(40):
        one = [f"w{i}" for i in rng.integers(0, 300, 250)]
        one += one[:15] * int(rng.integers(1, 12))          # shingles that occur many times
        two = [w if rng.random() > 0.02 else "x" for w in one][:int(len(one) * rng.uniform(0.6, 1))]
        words = Words([" ".join(one).encode(), " ".join(two).encode()])
        keys, ends = near_dedup.units(words)
        a, b = set(keys[:ends[0]].tolist()), set(keys[ends[0]:].tolist())
        shingles, before, stops = near_dedup.occurrences(words)
        first = np.flatnonzero(before == 0)
        weight = np.diff(np.append(first, len(shingles)))
        owner = np.repeat([0, 1], np.diff(stops, prepend=0))[first]
        found = near_dedup.signatures(shingles[first], weight, owner, 2, 400)
        errors.append((found[0] == found[1]).mean() - len(a & b) / len(a | b))
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.04


def test_classes_equal_brute_force(spark, docs):
    rows = docs.select("doc_id", "text").toPandas()
    # near copies with growing numbers of changes, in a group larger than what is compared as pairs
    base = [f"b{i}" for i in range(300)]
    rng = np.random.default_rng(5)
    more = [" ".join(w if rng.random() > 0.03 else f"c{k}" for w in base) for k in range(60)]
    rows = list(zip(rows.doc_id.tolist(), rows.text.tolist())) + [(10_000 + k, t) for k, t in enumerate(more)]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    classes = brute([t for _, t in rows])
    smallest = {}
    for (doc_id, _), c in zip(rows, classes):
        smallest[c] = min(doc_id, smallest.get(c, doc_id))
    expected = {doc_id: smallest[c] for (doc_id, _), c in zip(rows, classes)}
    assert dict(zip(found.doc_id, found.class_id)) == expected
    assert found.kept.sum() == len(smallest)


def test_joining_finds_links_between_classes():
    import pyarrow as pa
    units = pa.chunked_array([pa.array([[1, 2, 3, 4, 5], [1, 2, 3, 4, 5, 6], [9, 10], [1, 2, 3, 4, 5, 7]])])
    found = near_dedup.joining([b"a", b"b", b"c", b"d"], [b"a", b"a", b"c", b"d"], units, 0.8)
    assert found.to_pylist() == [{"a": b"a", "b": b"d"}]


def test_odd_rows(odd, none):
    found = near_dedup.near_duplicates(odd).collect()
    assert len(found) == len(ROWS)
    of = {}
    for r in found:
        of.setdefault(r.doc_id, []).append(r)
    assert [r.class_size for r in of[6]] == [3, 3, 3]
    assert of[7][0].class_id == of[8][0].class_id == 7 and of[8][0].class_size == 2
    assert of[1][0].class_id == of[2][0].class_id == 1    # null and empty are equal texts
    assert of[4][0].class_id == of[5][0].class_id == 4    # case does not count
    kept = near_dedup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [-5, 1, 3, 4, 6, 7, 9, 9, 10, 11]
    assert near_dedup.near_duplicates(none).count() == 0 and near_dedup.drop_near_duplicates(none).count() == 0
