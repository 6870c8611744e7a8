import random
from collections import Counter

import pytest

from footfall.operators import funnel


def pages(actions, sessions, gap=1):
    return actions([(s, i * gap, {"page_id": p}) for s, flow in sessions.items() for i, p in enumerate(flow)])


def test_rates(actions, rows):
    df = pages(actions, {"a": "123", "b": "12", "c": "231"})
    assert funnel.start_page_views(df, "1,2,3").first().start_pv == 3
    assert [tuple(r) for r in funnel.page_convert_rate(df, "1,2,3", task_id="t").collect()] == [
        ("t", 1, "1_2", 0.67), ("t", 2, "2_3", 1.0)]


def test_missing_pair_and_zero_denominator(actions):
    df = pages(actions, {"a": "12", "b": "34"})
    assert [(r.step, r.page_pair, r.rate) for r in funnel.page_convert_rate(df, "1,2,3,4").collect()] == [
        (1, "1_2", 1.0), (2, "2_3", 0.0), (3, "3_4", None)]


def test_no_start_page_and_empty_input(actions):
    df = pages(actions, {"a": "23"})
    assert [r.rate for r in funnel.page_convert_rate(df, "1,2,3").collect()] == [None, None]
    empty = funnel.page_pair_counts(df.where("false"), "1,2,3").collect()
    assert [(r.pair_count, r.previous_count) for r in empty] == [(0, 0), (0, 0)]


def test_rate_may_exceed_one(actions):
    df = pages(actions, {"a": "12", "b": "2323"})
    assert [r.rate for r in funnel.page_convert_rate(df, "1,2,3").collect()] == [1.0, 2.0]


def test_a_busy_session_is_cut_by_its_own_times(spark, actions):
    """A third of all actions is in one session, all within one span of time."""
    df = actions([("busy", i % 500, {"page_id": "1"}) for i in range(1000)]
                 + [(f"s{i % 400}", i % 500, {"page_id": "2"}) for i in range(2000)])
    sizes = funnel._in_ranges(df, ("event_id",), 30).where("session_id = 'busy'").groupBy("_range").count()
    found = [r["count"] for r in sizes.collect()]
    assert len(found) >= 8 and max(found) <= 2 * 3000 / 30 and sum(found) == 1000
    pairs = funnel.session_page_pairs(df, ("event_id",)).groupBy("from_page").count()
    assert {r.from_page: r["count"] for r in pairs.collect()} == {"1": 999, "2": 1600}


def test_actions_are_read_twice(spark, actions, tmp_path):
    """Once for the sample, which is done, and once in the plan, also with a session that is cut."""
    actions([("busy", i, {"page_id": "1"}) for i in range(200)]).write.parquet(f"{tmp_path}/actions")
    df = spark.read.parquet(f"{tmp_path}/actions")
    for out, left in ((funnel.page_pair_counts(df, "1,2,3", ("event_id",), 8), 1), (funnel.session_page_pairs(df, ("event_id",), 8), 0)):
        assert out._jdf.queryExecution().executedPlan().toString().count(f"{tmp_path}/actions") == left


@pytest.mark.parametrize("ranges", [1, 3, 60, 300])
def test_ranges_do_not_change_the_pairs(actions, ranges):
    """Pairs within and across ranges together are those of one ordered walk through a session."""
    rng = random.Random(5)
    walk = [(f"s{rng.randrange(4)}", rng.randrange(60), {"page_id": str(rng.randrange(4))}) for _ in range(300)]
    df = actions(walk)
    expected = Counter()
    for s in {w[0] for w in walk}:
        order = sorted((seconds, i) for i, (name, seconds, _) in enumerate(walk) if name == s)
        flow = [walk[i][2]["page_id"] for _, i in order]
        expected.update(zip(flow, flow[1:]))
    got = funnel.session_page_pairs(df, ("event_id",), ranges).groupBy("from_page", "to_page").count()
    assert {(r.from_page, r.to_page): r["count"] for r in got.collect()} == expected
    flow = funnel.page_pair_counts(df, "0,1,2,3", ("event_id",), ranges).collect()
    assert [r.pair_count for r in flow] == [expected["0", "1"], expected["1", "2"], expected["2", "3"]]
