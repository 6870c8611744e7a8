from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import mixing

from .conftest import ROWS


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=9))
def test_less_than_one_block_from_the_weight(parts):
    total, done = sum(parts), [0] * len(parts)
    plan = mixing.schedule(parts)
    for slot, which in enumerate(plan, 1):
        done[which] += 1
        assert all(abs(d - Fraction(slot * p, total)) < 1 for d, p in zip(done, parts))
    assert done == parts


def test_windows_and_order(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "'t' AS text")
    rows = mixing.slots(docs, {"s0": 3, "s1": 2}, block_rows=8).toPandas()
    assert len(rows) == 3000
    assert ((rows.mix_release <= rows.mix_slot) & (rows.mix_slot < rows.mix_deadline)).all()
    assert rows.groupby(["mix_slot", "mix_row"]).size().max() == 1
    order = [r.doc_id for r in mixing.mixed_rows(docs, {"s0": 3, "s1": 2}, block_rows=8).collect()]
    assert order == rows.sort_values(["mix_slot", "mix_row"]).doc_id.tolist()


def test_odd_rows(odd, none):
    rows = mixing.slots(odd, {"src0": 2, "src1": 1})
    assert rows.columns[:len(odd.columns)] == odd.columns and rows.count() == len(ROWS)
    same = mixing.mixed_rows(odd, {}, other=1)
    assert same.columns == odd.columns and same.count() == len(ROWS)
    assert mixing.mixed_rows(none, {"src0": 1}).count() == 0
