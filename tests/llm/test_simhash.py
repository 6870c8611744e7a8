import hashlib
from math import comb

import numpy as np

from footfall.llm import queries, simhash

from .conftest import ROWS


def test_query_equals_brute_force(spark, docs):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()))
    found = {r.doc_id: r for r in queries.op3_simhash(spark, "/root/testdata/sf0.001").collect()}
    assert len(found) == len(rows)
    prints = simhash.fingerprints([t.encode() for _, t in rows])
    bits = lambda a, b: int(a ^ b).bit_count()
    for k, (doc_id, text) in enumerate(rows):
        following, half, r = rows[(k + 1) % len(rows)][1], len(text) // 2, found[doc_id]
        changed = text[:len(text) - half] + following[:half]
        own, edited = (int(x) for x in simhash.fingerprints([text.encode(), changed.encode()]))
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert (r.fingerprint, r.edited_fingerprint) == (f"{own:016x}", f"{edited:016x}")
        assert r.near_edited == 1 - bits(own, edited) / 64
        assert r.near_next == 1 - bits(own, int(prints[(k + 1) % len(rows)])) / 64
        if doc_id % 50 == 0:
            assert r.n_near == sum(bits(own, int(p)) <= simhash.RADIUS for p in prints)


def test_search_finds_all_within_the_radius(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2 ** 63, 20, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 7), False)) for b in base for _ in range(40)]
    values = [x - (1 << 64) if x >> 63 else x for x in [*map(int, base), *near]]
    rows = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    found = {r.fingerprint: r.n_near for r in simhash.neighbours(rows, rows).collect()}
    mask = (1 << 64) - 1
    assert found == {v: sum(((v ^ w) & mask).bit_count() <= 3 for w in values) for v in set(values)}
    pairs = {(r.asked, r.fingerprint): r for r in simhash.links(rows, rows).collect()}
    assert set(pairs) == {(v, w) for v in set(values) for w in set(values) if ((v ^ w) & mask).bit_count() <= 3}
    assert all(r.bits == ((v ^ w) & mask).bit_count() and r.n == values.count(w) for (v, w), r in pairs.items())
    assert len(simhash.masks()) == comb(simhash.BLOCKS, simhash.RADIUS)


def test_no_texts_in_the_bounds_of_ranges(odd):
    plan = simhash.with_next(odd)._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan   # it has run: the rows are read back
    rows = odd.selectExpr("doc_id AS id", "text")
    ranged = rows.repartitionByRange("id", simhash.F.xxhash64("text"))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(id" in ranged and "xxhash64" in ranged


def test_odd_rows(odd, none):
    found = simhash.with_next(odd).collect()
    assert len(found) == len(ROWS)
    assert len({r.fingerprint for r in found if r.doc_id == 6}) == 1
    assert {r.fingerprint for r in found if r.doc_id in (1, 2, 3)} == {0}
    one = simhash.with_next(odd.where("doc_id = 11")).collect()
    assert len(one) == 1 and one[0].next == one[0].fingerprint
    assert simhash.with_next(none).count() == 0
