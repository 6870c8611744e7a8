import random
from datetime import datetime, timedelta

import pytest

from footfall.operators import ads


def test_clicks_after_the_third_drop_for_good(clicks, rows):
    df = clicks(("2024-01-10 08:00:00", 7, 1), ("2024-01-10 08:01:00", 7, 1), ("2024-01-10 08:02:00", 7, 1),
                ("2024-01-10 08:03:00", 7, 1), ("2024-01-10 08:04:00", 7, 2), ("2024-01-11 08:00:00", 7, 2),
                ("2024-01-10 08:00:00", 8, 1), ("2024-01-10 08:01:00", 8, 1), ("2024-01-11 08:01:00", 8, 1))
    assert rows(ads.blacklist(df, 3)) == [(7,)]
    kept = ads.filtered_clicks(df, 3)
    assert kept.columns == df.columns
    assert rows(ads.user_click_counts(kept)) == [("2024-01-10", 7, 1, 3), ("2024-01-10", 8, 1, 2), ("2024-01-11", 8, 1, 1)]
    assert rows(ads.filtered_clicks(df)) == rows(df)   # nobody reaches the default of 100


def test_two_ads_crossing_list_a_user_once(clicks, rows):
    df = clicks(*[(f"2024-01-10 08:0{m}:00", 7, ad) for ad in (1, 2) for m in range(3)])
    assert rows(ads.blacklist(df, 3)) == [(7,)]


def test_heavy_user_is_cut_before_the_shuffle(clicks):
    plan = ads.blacklist(clicks(("2024-01-10 08:00:00", 7, 1)))._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 100, Partial" in plan


def test_known_users_are_dropped(spark, clicks, rows):
    df = clicks(("2024-01-10 08:00:00", 7, 1), ("2024-01-10 08:00:00", 8, 1))
    assert [r[3] for r in rows(ads.drop_users(df, spark.createDataFrame([(7,), (7,)], "userid long")))] == [8]


def place(ad, province, n, day=10, city=10):
    return [(f"2024-01-{day} 08:00:{i:02}", i, ad, province, city) for i in range(n)]


def test_province_top(clicks, rows):
    df = clicks(*place(1, 5, 4), *place(1, 5, 2, city=11), *place(2, 5, 5), *place(3, 5, 5), *place(4, 5, 1),
                *place(4, 5, 3, day=11), *place(9, 6, 1))
    stat = ads.ad_stat(df)
    assert ("2024-01-10", 5, 11, 1, 2) in rows(stat)
    by_day = [("2024-01-10", 5, 1, 6), ("2024-01-10", 5, 2, 5), ("2024-01-10", 5, 3, 5), ("2024-01-10", 6, 9, 1),
              ("2024-01-11", 5, 4, 3)]
    assert rows(ads.province_top_ads(stat)) == by_day
    assert rows(ads.province_top_ads(stat, 2)) == by_day       # a tie on rank 2 keeps both
    assert rows(ads.province_top_ads_all_days(stat, 2)) == [
        ("2024-01-10", 5, 1, 6), ("2024-01-10", 5, 2, 5), ("2024-01-10", 6, 9, 1)]


def test_minutes_and_the_last_hour(clicks, rows):
    df = clicks(("2024-01-10 08:00:59.999", 1, 1), ("2024-01-10 08:01:00", 2, 1), ("2024-01-10 09:00:30", 3, 1),
                ("2024-01-10 09:01:10", 3, 1))
    assert rows(ads.minute_clicks(df))[:2] == [("2024-01-10", "08", "00", 1, 1), ("2024-01-10", "08", "01", 1, 1)]
    # 60 minutes up to 09:01 begin at 08:02
    assert [r[1:3] for r in rows(ads.click_trend(df))] == [("09", "00"), ("09", "01")]
    assert [r[1:3] for r in rows(ads.click_trend(df, 61))] == [("08", "01"), ("09", "00"), ("09", "01")]


def test_sliding_windows(clicks, rows):
    df = clicks(("2024-01-10 08:00:10", 1, 1), ("2024-01-10 08:00:40", 2, 1), ("2024-01-10 08:00:40", 2, 2))
    assert rows(ads.sliding_clicks(df, "90 seconds", "30 seconds")) == [
        ("2024-01-10 08:00:30", 1, 1), ("2024-01-10 08:01:00", 1, 2), ("2024-01-10 08:01:00", 2, 1),
        ("2024-01-10 08:01:30", 1, 2), ("2024-01-10 08:01:30", 2, 1), ("2024-01-10 08:02:00", 1, 1),
        ("2024-01-10 08:02:00", 2, 1)]


def plain_windows(data, length, slide):
    """Each click in each window, one by one; times are seconds of one day."""
    out = {}
    for second, ad in data:
        end = (second // slide + 1) * slide
        for e in range(end, end + length, slide):
            out[e, ad] = out.get((e, ad), 0) + 1
    return sorted((str(datetime(2024, 1, 10) + timedelta(seconds=e)), ad, n) for (e, ad), n in out.items())


@pytest.mark.parametrize("length,slide", [(3600, 30), (60, 60), (90, 30)])
def test_sliding_windows_over_days_and_gaps(clicks, rows, length, slide):
    """One ad has most of the clicks; windows go on over midnight and end in gaps."""
    rng = random.Random(8)
    data = [(int(rng.choice([80_000, 86_000, 86_390, 200_000]) + rng.random() * 900), 1) for _ in range(300)]
    data += [(rng.randrange(300_000), 2 + i % 3) for i in range(40)]
    df = clicks(*[(str(datetime(2024, 1, 10) + timedelta(seconds=s)), 1, ad) for s, ad in data])
    assert rows(ads.sliding_clicks(df, f"{length} seconds", f"{slide} seconds")) == plain_windows(data, length, slide)


def test_a_pane_is_two_events_in_the_shuffle(clicks):
    df = clicks(("2024-01-10 08:00:10", 1, 1), ("2024-01-10 08:00:40", 2, 1))
    plan = ads.sliding_clicks(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("explode(sequence(") < plan.index("Exchange hashpartitioning")   # windows come after all shuffles
    assert plan.count("Generate explode(array(") == plan.count("REPARTITION_BY_COL")
    with pytest.raises(ValueError):
        ads.sliding_clicks(df, "100 seconds", "30 seconds")
