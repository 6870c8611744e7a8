import random

import pytest

from footfall.operators import ranking
from footfall.operators.ranges import in_ranges

SCORES = [("a", 1, 80), ("b", 1, 78), ("c", 1, 95), ("d", 2, 74), ("e", 2, 92), ("f", 3, 99), ("g", 3, 99),
          ("h", 3, 45), ("i", 3, 55), ("j", 3, 78)]
COLUMNS = "name string, class int, score long"
ARGS = (["class"], "score", "name")


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame(SCORES, COLUMNS).cache()


def test_rank_and_row_number(scores):
    rank = {r.name: r["rank"] for r in ranking.rank_per_group(scores, *ARGS).collect()}
    assert rank == dict(a=2, b=3, c=1, d=2, e=1, f=1, g=1, j=3, i=4, h=5)
    number = {r.name: r["rank"] for r in ranking.row_number_per_group(scores, *ARGS).collect()}
    assert number == dict(a=2, b=3, c=1, d=2, e=1, f=1, g=2, j=3, i=4, h=5)
    dense = {r.name: r.dense_rank for r in ranking.window_suite(scores, *ARGS).collect()}
    assert {k: dense[k] for k in "fgjih"} == dict(f=1, g=1, j=2, i=3, h=4)


def test_first_of_each_group(scores, rows):
    assert [r[0] for r in rows(ranking.top_per_group(scores, *ARGS))] == ["c", "e", "f", "g"]
    assert rows(ranking.max_per_group(scores, ["class"], "score")) == [(1, 95), (2, 92), (3, 99)]


def test_max_join_back(spark, scores, rows):
    df = scores.union(spark.createDataFrame([("k", 2, 95)], COLUMNS))
    assert rows(ranking.max_join_back(df, *ARGS)) == [("c", 1, 95), ("f", 3, 99), ("g", 3, 99), ("k", 2, 95)]
    assert rows(ranking.max_join_back_loose(df, *ARGS)) == [
        ("c", 1, 95), ("c", 2, 95), ("f", 3, 99), ("g", 3, 99), ("k", 1, 95), ("k", 2, 95)]


def brute(data, default=0):
    out = set()
    for group in {r[1] for r in data}:
        members = sorted((r for r in data if r[1] == group), key=lambda r: (-r[2], r[0]))
        values = [r[2] for r in members]
        for i, (name, _, score) in enumerate(members):
            seen = values[:i + 1]
            out.add((group, name, score, values.index(score) + 1, len({v for v in values if v > score}) + 1, i + 1,
                     i + 1, sum(seen), min(seen), max(seen), sum(seen) / (i + 1), members[0][0], name,
                     values[i - 1] if i else default, values[i + 1] if i + 1 < len(values) else default))
    return out


@pytest.mark.parametrize("ranges", [128, 16, 3, 1])
def test_suite_equals_brute_force_whether_groups_are_cut_or_not(spark, ranges):
    """One group has most of the rows, one many equal scores, the others are small."""
    rng = random.Random(11)
    data = ([(f"n{i:03}", 1, rng.randrange(1000)) for i in range(250)]
            + [(f"t{i:03}", 2, rng.choice([5, 5, 5, 9])) for i in range(100)]
            + [(f"r{i:03}", 3 + i % 9, rng.randrange(50)) for i in range(60)])
    df = spark.createDataFrame(data, COLUMNS)
    got = ranking.window_suite(df, *ARGS, ranges=ranges).collect()
    assert len(got) == len(data) and {tuple(r) for r in got} == brute(data)


@pytest.mark.parametrize("ranges", [1, 4, 32])
def test_lag_and_lead_by_any_offset(spark, ranges):
    df = spark.createDataFrame([(f"n{i:02}", 1, i) for i in range(40)] + [("x", 2, 5)], COLUMNS)
    got = {r.name: (r.lag_score, r.lead_score)
           for r in ranking.lag_lead_per_group(df, *ARGS, offset=7, default=-1, ranges=ranges).collect()}
    assert got == {f"n{i:02}": (i + 7 if i + 7 < 40 else -1, i - 7 if i >= 7 else -1) for i in range(40)} | {
        "x": (-1, -1)}


def test_equal_scores_do_not_share_a_range(spark):
    """Nine in ten rows have one score; no range has more than twice the mean, and no rank is wrong."""
    rows = spark.range(60_000).selectExpr("id AS name", "cast(0 AS int) AS class", "if(id % 10 = 0, id, 7) AS score").repartition(8)
    sizes = [r["count"] for r in in_ranges(rows, *ARGS, ranges=16).groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 60_000 / 16
    out = ranking.rank_per_group(rows, *ARGS, ranges=16).groupBy("score").agg({"rank": "min", "name": "count"}).collect()
    above = sum(1 for i in range(0, 60_000, 10) if i > 7)
    assert {r["min(rank)"] for r in out if r.score == 7} == {above + 1}
    assert ranking.rank_per_group(rows, *ARGS, ranges=16).where("score = 7").select("rank").distinct().count() == 1


def test_two_readings_and_no_self_join(spark, tmp_path):
    spark.range(5000).selectExpr("id AS name", "id % 3 AS class", "id * 7 % 1000 AS score").write.parquet(f"{tmp_path}/scores")
    df = spark.read.parquet(f"{tmp_path}/scores")
    plan = in_ranges(df, *ARGS, ranges=8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<name:bigint,class:bigint") == 1 and "Join" not in plan       # the other reading was for the sample
    plan = ranking.lag_lead_per_group(df, *ARGS, offset=2, ranges=8)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<name:bigint,class:bigint,score:bigint>" not in plan and "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1


def test_nulls_and_numbers_that_are_none(spark):
    """Null scores come last, NaN first; null groups are a group, and rows of one name stay."""
    data = [(f"n{i:03}", None if i % 4 == 0 else i % 3, float("nan") if i % 11 == 0 else None if i % 7 == 0 else float(i % 9))
            for i in range(400)] + [(None, None, 1.0), (None, 1, None)]
    df = spark.createDataFrame(data, "name string, class int, score double").repartition(4)
    order = "PARTITION BY class ORDER BY score DESC NULLS LAST"
    df.createOrReplaceTempView("odd_scores")
    expected = spark.sql(f"""SELECT name, class, score, rank() OVER ({order}) AS rank, row_number() OVER ({order}, name) AS number,
        lag(score, 2, -1D) OVER ({order}, name) AS before, lead(score, 2, -1D) OVER ({order}, name) AS after FROM odd_scores""").collect()
    text = lambda rows: sorted(str(tuple(r)) for r in rows)
    assert text(ranking.rank_per_group(df, *ARGS, ranges=9).collect()) == text([r[:4] for r in expected])
    assert text(ranking.row_number_per_group(df, *ARGS, ranges=9).collect()) == text([(*r[:3], r.number) for r in expected])
    assert text(ranking.lag_lead_per_group(df, *ARGS, offset=2, default=-1, ranges=9).collect()) == text(
        [(*r[:3], r.before, r.after) for r in expected])
    assert ranking.window_suite(df.limit(0), *ARGS).collect() == []


def test_group_totals(scores):
    row = next(r for r in ranking.group_totals(scores, *ARGS).collect() if r.name == "d")
    assert (row.group_count, row.group_sum, row.group_min, row.group_max, row.group_avg, row.all_count) == (
        2, 166, 74, 92, 83.0, 10)
