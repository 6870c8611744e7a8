import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from footfall import schemas
from footfall.operators import ads
from footfall.sources.clicks import click_records, parse_clicks, rejected_lines, text_stream
from footfall.streaming import ads as streams
from footfall.streaming import screening, users
from footfall.streaming.offsets import offset_report

DAY = "2024-01-10"


class Log:
    """A folder of click lines that grows batch by batch, and the query that reads it."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.base, self.checkpoint = f"{root}/tables", f"{root}/checkpoint"

    def add(self, df):
        click_records(df).coalesce(1).write.mode("append").text(f"{self.root}/log")

    def run(self, start, **options):
        stream = parse_clicks(text_stream(self.spark, f"{self.root}/log", 1))
        query = start(stream, self.base, options.pop("checkpoint", self.checkpoint), trigger=streams.UNTIL_NOW,
                      **options)
        query.awaitTermination()
        return query


@pytest.fixture
def log(spark, tmp_path):
    return Log(spark, str(tmp_path))


def batch(*rows):
    return [(f"{DAY} 08:{m:02}:00", user, ad) for m, user, ad in rows]


BATCHES = [
    batch((0, 7, 1), (1, 7, 1), (2, 8, 1), (3, 8, 2)),
    batch((10, 7, 1), (11, 7, 1), (12, 7, 2), (13, 8, 1), (14, 9, 1), (15, 9, 1), (16, 9, 1), (17, 9, 2), (18, 9, 2),
          (19, 9, 2)),
    batch((20, 7, 1), (21, 7, 3), (22, 8, 1), (23, 8, 1), (24, 9, 3)),
    batch((30, 8, 3), (31, 5, 1)),
]


def model(batches, threshold):
    """The batch by batch rule in plain Python: list a user after the batch that reaches the threshold."""
    counts, listed, kept = Counter(), set(), []
    for rows in batches:
        passed = [r for r in rows if r[1] not in listed]
        keys = Counter((DAY, user, ad) for _, user, ad in passed)
        counts.update(keys)
        listed |= {user for (_, user, ad) in keys if counts[DAY, user, ad] >= threshold}
        kept += passed
    return counts, listed, kept


def sum_rows(counts):
    return sorted((k + (n,) for k, n in counts.items()), key=str)


def test_blacklist_by_batch_follows_the_model(spark, clicks, log, rows):
    for part in BATCHES:
        log.add(clicks(*part))
        log.run(streams.start_blacklist, threshold=3)     # a restart on the checkpoint each time
    counts, listed, _ = model(BATCHES, 3)
    assert rows(streams.read_user_counts(spark, log.base)) == sum_rows(counts)
    assert rows(streams.read_blacklist(spark, log.base)) == sorted((u,) for u in listed) == [(7,), (8,), (9,)]


@pytest.mark.parametrize("sizes", [(4,), (1, 1, 1, 1)])
def test_exact_blacklist_does_not_depend_on_the_batches(spark, clicks, log, rows, sizes):
    everything = clicks(*[r for part in BATCHES for r in part])
    left = list(BATCHES)
    for n in sizes:
        log.add(clicks(*[r for part in left[:n] for r in part]))
        left = left[n:]
    log.run(streams.start_ad_job, threshold=3, exact=True)
    kept = ads.filtered_clicks(everything, 3)
    assert rows(streams.read_user_counts(spark, log.base)) == rows(ads.user_click_counts(kept))
    assert rows(streams.read_blacklist(spark, log.base)) == rows(ads.blacklist(everything, 3))
    assert rows(streams.read_stat(spark, log.base)) == rows(ads.ad_stat(kept))
    assert rows(streams.read_trend(spark, log.base)) == rows(ads.minute_clicks(kept))
    assert rows(streams.read_province_top(spark, log.base)) == rows(ads.province_top_ads(ads.ad_stat(kept)))


@pytest.mark.parametrize("sizes", [(4,), (1, 2, 1)])
def test_screening_with_state(spark, clicks, log, rows, sizes):
    everything = clicks(*[r for part in BATCHES for r in part])
    left = list(BATCHES)
    for n in sizes:
        log.add(clicks(*[r for part in left[:n] for r in part]))
        left = left[n:]
        log.run(screening.start_screening, threshold=3)      # resumes with the state of its checkpoint
        streams.start_user_counts(screening.kept_stream(spark, log.base), log.base, f"{log.root}/counts",
                                  trigger=streams.UNTIL_NOW).awaitTermination()
    kept = ads.filtered_clicks(everything, 3)
    assert rows(screening.read_kept(spark, log.base).drop("listed")) == rows(kept)
    assert rows(screening.read_listed(spark, log.base)) == rows(ads.blacklist(everything, 3)) == [(7,), (8,), (9,)]
    assert rows(streams.read_latest_user_counts(spark, log.base)) == rows(ads.user_click_counts(kept))


def test_screening_of_a_busy_user_and_of_equal_times():
    """Rows beyond the threshold go before the shuffle; clicks of the same instant pass together."""
    at = pd.to_datetime([f"{DAY} 08:00:{s:02}" for s in (0, 1, 2, 2, 3, 4, 5)])
    rows = pd.DataFrame({"ts": at, "province": 1, "city": 1, "userid": 7, "adid": 1, "date": DAY})
    few = pd.concat(users.first_clicks(3)(iter([rows])))
    assert list(few["ts"].dt.second) == [0, 1, 2, 2]

    user = User(users.screen_user(3, 2))
    first = user.step(rows[:2], rows[2:0])
    assert list(first["listed"]) == [False, False] and user.counts() == {(DAY, 1): 2}
    later = rows[:1].assign(date="2024-01-12", ts=pd.Timestamp("2024-01-12"))
    user.step(later)
    assert user.counts() == {("2024-01-12", 1): 1}     # two days on, the first day is forgotten
    assert len(user.step(rows[:1])) == 1 and user.counts() == {("2024-01-12", 1): 1}   # and stays so
    out = user.step(rows)
    assert list(out["ts"].dt.second) == [0, 1, 2, 2] and list(out["listed"]) == [False] * 3 + [True]
    assert user.step(rows) is None and not user.counts()


class User:
    """The state of one user in memory, with a count of the entries a step touches."""

    def __init__(self, processor):
        self.touched, self.values, self.maps, self.processor = 0, {}, {}, processor
        processor.init(self)

    def getValueState(self, name, schema):
        values = self.values

        class Value:
            def exists(self):
                return name in values

            def get(self):
                return values.get(name)

            def update(self, value):
                values[name] = value

            def clear(self):
                values.pop(name, None)
        return Value()

    def getMapState(self, name, key, value):
        user, held = self, self.maps.setdefault(name, {})

        class Map:
            def getValue(self, k):
                user.touched += 1
                return held.get(k)

            def updateValue(self, k, v):
                user.touched += 1
                held[k] = v

            def keys(self):
                user.touched += len(held)
                return iter(list(held))

            def removeKey(self, k):
                del held[k]

            def clear(self):
                held.clear()
        return Map()

    def step(self, *parts):
        out = list(self.processor.handleInputRows((7,), iter(parts), None))
        return pd.concat(out) if out else None

    def counts(self):
        return {k: v[0] for k, v in self.maps["clicks"].items()}


def test_a_batch_touches_its_own_entries_only(monkeypatch):
    """However many days and ads a user has, and however many rows one batch has of them."""
    monkeypatch.setattr(users, "MANY", 1000)
    user = User(users.screen_user(3, None))
    many = pd.DataFrame({"ts": pd.Timestamp(f"{DAY} 08:00:00"), "province": 1, "city": 1, "userid": 7, "adid": range(50_000), "date": DAY})
    assert len(user.step(*[many[i:i + 700] for i in range(0, 50_000, 700)])) == 50_000 and len(user.counts()) == 50_000
    for day in range(11, 20):
        user.touched = 0
        one = many[:1].assign(date=f"2024-01-{day}", ts=pd.Timestamp(f"2024-01-{day}"))
        user.step(one)
        assert user.touched == 2
    assert user.counts()[(DAY, 7)] == 1 and len(user.counts()) == 50_009


def test_whole_batches_and_all_clicks():
    """By batch a user is listed from the next one on; with everything, what does not count comes too."""
    rows = pd.DataFrame({"ts": pd.to_datetime([f"{DAY} 08:00:0{s}" for s in range(5)]), "province": 1, "city": 1, "userid": 7,
                         "adid": [1, 1, 2, 1, 1], "date": DAY})
    user = User(users.screen_user(3, None, exact=False))
    assert list(user.step(rows[:2], rows[2:3])["listed"]) == [False] * 3 and user.counts() == {(DAY, 1): 2, (DAY, 2): 1}
    assert list(user.step(rows[3:4], rows[4:])["listed"]) == [False, True] and user.step(rows) is None
    user = User(users.screen_user(3, None, everything=True))
    out = user.step(rows)
    assert list(out["kept"]) == [True] * 4 + [False] and list(out["listed"]) == [False] * 3 + [True, False]
    assert list(user.step(rows)["kept"]) == [False] * 5


@pytest.mark.parametrize("keep_days", [None, 4, 40])
@pytest.mark.parametrize("exact, everything", [(True, False), (True, True), (False, False), (False, True)])
def test_users_of_a_bucket_are_screened_as_each_alone(keep_days, exact, everything):
    """The same clicks and the same state as by the rule for one user, over batches that overlap and skip days."""
    for seed in range(8):
        some, threshold = random.Random(seed), 2 + seed % 4
        bucket, alone = User(users.screen_users(threshold, keep_days, exact, everything)), {}
        for step in range(6):
            first = 19_700 + step * some.choice([1, 5, 20])
            days = [first + some.randint(-3, 3) for _ in range(some.randint(1, 120))]
            rows = pd.DataFrame({"ts": [pd.Timestamp(86_400 * d + some.randint(0, 5), unit="s") for d in days], "province": 1, "city": range(len(days)),
                                 "userid": [some.randint(1, 12) for _ in days], "adid": [some.randint(1, 3) for _ in days], "date": days})
            cut = some.randint(0, len(rows))
            got = bucket.step(*[part for part in (rows[:cut], rows[cut:]) if len(part)])
            want = []
            for user, own in rows.assign(date=pd.to_datetime(rows["date"], unit="D").dt.strftime("%Y-%m-%d")).groupby("userid"):
                want.append(alone.setdefault(user, User(users.screen_user(threshold, keep_days, exact, everything))).step(own))
            as_rows = lambda df: sorted(df.drop(columns="date", errors="ignore").itertuples(index=False, name=None))
            assert as_rows(pd.concat([rows[:0] if got is None else got])) == as_rows(pd.concat([rows[:0], *want]))
            known = {u: told for (u,), told in bucket.maps["users"].items()}
            assert {u for u, told in known.items() if told[0]} == {u for u, one in alone.items() if "listed" in one.values}
            cells = {}
            for (u, p), (packed,) in bucket.maps["clicks"].items():
                assert p in known[u][2]
                cells.update({(u, str(pd.Timestamp(d, unit="D").date()), ad): n for d, ad, n in np.frombuffer(packed, "<i8").reshape(-1, 3).tolist()
                              if keep_days is None or d > known[u][1] - keep_days})
            assert cells == {(u, *k): n for u, one in alone.items() for k, n in one.counts().items()}


def test_a_bucket_asks_the_state_a_few_times_for_a_user(monkeypatch):
    """However many days and ads its clicks have; and a bucket of many rows is gathered part by part."""
    rows = pd.DataFrame({"ts": pd.Timestamp(f"{DAY} 08:00:00"), "province": 1, "city": 1, "userid": np.arange(6000) % 20, "adid": np.arange(6000) // 20,
                         "date": 19_732 + np.arange(6000) // 20 % 28})   # the days of one period
    rows["date"] -= 19_732 % users.PERIOD
    bucket = User(users.screen_users(2, None))
    monkeypatch.setattr(users, "MANY", 500)
    assert len(bucket.step(*[rows[i:i + 700] for i in range(0, 6000, 700)])) == 6000
    assert bucket.touched <= 3 * 20                   # 300 clicks of each user
    bucket.touched = 0
    out = bucket.step(rows[:20], rows[20:40])
    assert len(out) == 40 and out["listed"].sum() == 20 and bucket.touched <= 3 * 20   # clicks of one instant
    assert not bucket.maps["clicks"] and not len(bucket.step(rows))


def test_a_new_run_knows_what_earlier_ones_counted(spark, clicks, log, rows):
    log.add(clicks((f"{DAY} 08:00:00", 1, 1), (f"{DAY} 08:00:01", 1, 1), (f"{DAY} 08:00:02", 2, 1), *[(f"{DAY} 08:00:0{i}", 3, 1) for i in range(3)]))
    log.run(streams.start_ad_job, threshold=3, exact=True)
    click_records(clicks((f"{DAY} 09:00:00", 1, 1), (f"{DAY} 09:00:01", 1, 1), (f"{DAY} 09:00:02", 2, 1), (f"{DAY} 09:00:03", 3, 2))).write.text(
        f"{log.root}/more")
    new = parse_clicks(text_stream(spark, f"{log.root}/more"))
    for _ in range(2):   # and once more on its own checkpoint
        streams.start_ad_job(new, log.base, f"{log.root}/second", 3, exact=True, trigger=streams.UNTIL_NOW).awaitTermination()
    assert rows(streams.read_user_counts(spark, log.base)) == [(DAY, 1, 1, 3), (DAY, 2, 1, 2), (DAY, 3, 1, 3)]
    assert rows(streams.read_blacklist(spark, log.base)) == [(1,), (3,)]


def test_a_new_run_knows_earlier_users_of_one_bucket(spark, clicks, log, rows, monkeypatch):
    """Listed users and large numbers, which a missing number next to them must not make inexact."""
    monkeypatch.setattr(users, "BUCKETS", 1)
    big = 2**60 + 1
    log.add(clicks(*[(f"{DAY} 08:00:0{i}", 3, 1) for i in range(3)], *[(f"{DAY} 08:00:0{i}", big, big + i % 2) for i in range(3)]))
    log.run(streams.start_ad_job, threshold=3, exact=True)
    click_records(clicks((f"{DAY} 09:00:00", big, big + 1), (f"{DAY} 09:00:01", 3, 2), (f"{DAY} 09:00:02", 4, 2), (f"{DAY} 09:00:03", big, big))).write.text(
        f"{log.root}/more")
    new = parse_clicks(text_stream(spark, f"{log.root}/more"))
    streams.start_ad_job(new, log.base, f"{log.root}/second", 3, exact=True, trigger=streams.UNTIL_NOW).awaitTermination()
    assert rows(streams.read_user_counts(spark, log.base)) == sorted([(DAY, 3, 1, 3), (DAY, 4, 2, 1), (DAY, big, big, 3), (DAY, big, big + 1, 2)], key=str)
    assert rows(streams.read_blacklist(spark, log.base)) == sorted([(3,), (big,)], key=str)


def test_a_user_with_very_many_ads(spark, clicks, log):
    """Through Spark's state store; the second run resumes from the checkpoint and lists the user."""
    ids = spark.range(50_000)
    frame = ids.selectExpr("timestamp_ntz'2024-01-10 08:00:00' AS ts", "1 AS province", "1 AS city", "7 AS userid", "id AS adid")
    log.add(frame.select(*clicks((f"{DAY} 08:00:00", 1, 1)).columns))
    log.run(screening.start_screening, threshold=2)
    log.add(clicks((f"{DAY} 09:00:00", 7, 49_999), (f"{DAY} 10:00:00", 7, 3)))
    log.run(screening.start_screening, threshold=2)
    assert screening.read_kept(spark, log.base).count() == 50_001
    assert [r.userid for r in screening.read_listed(spark, log.base).collect()] == [7]


def test_job_by_batch_and_trend_of_all(spark, clicks, log, rows):
    for part in BATCHES:
        log.add(clicks(*part))
    log.run(streams.start_ad_job, threshold=3, trend_of_all=True)
    _, listed, kept = model(BATCHES, 3)
    everything = clicks(*[r for part in BATCHES for r in part])
    assert rows(streams.read_stat(spark, log.base)) == rows(ads.ad_stat(clicks(*kept)))
    assert rows(streams.read_trend(spark, log.base)) == rows(ads.minute_clicks(everything))


def test_a_batch_run_again_changes_nothing(spark, clicks, log, rows):
    """The step of a batch that failed half way is repeated with the same id and input."""
    for part in BATCHES[:2]:
        log.add(clicks(*part))
    run = str(log.run(streams.start_blacklist, threshold=3).id)
    before = rows(streams.read_user_counts(spark, log.base)), rows(streams.read_blacklist(spark, log.base))
    at = f"{log.base}/{{}}/run={run}/batch_id=1"
    kept = spark.read.parquet(at.format(streams.USER_COUNTS))
    again = kept.selectExpr("explode(sequence(1L, click_count))", "to_timestamp(date) AS ts", "1 AS province", "1 AS city", "userid", "adid").drop("col")
    again = spark.createDataFrame(again.collect(), again.schema)
    listed = spark.createDataFrame(spark.read.parquet(at.format(streams.BLACKLIST)).collect(), schemas.AD_BLACKLIST)
    for _ in range(2):
        streams._record(again, listed, 1, log.base, run)
    after = rows(streams.read_user_counts(spark, log.base)), rows(streams.read_blacklist(spark, log.base))
    assert before == after


def test_running_counts_and_favourites(spark, clicks, log, rows):
    for part in BATCHES:
        log.add(clicks(*part))
        log.run(streams.start_stat)
        log.run(streams.start_province_top, checkpoint=f"{log.root}/top")
    everything = clicks(*[r for part in BATCHES for r in part])
    assert rows(streams.read_latest_stat(spark, log.base)) == rows(ads.ad_stat(everything))
    assert rows(streams.read_province_top(spark, log.base)) == rows(ads.province_top_ads(ads.ad_stat(everything)))


def test_watermark_bounds_the_days_kept(spark, clicks, log, rows):
    log.add(clicks(("2024-01-10 08:00:00", 1, 1)))
    log.add(clicks(("2024-01-20 08:00:00", 1, 1)))
    log.add(clicks(("2024-01-20 07:00:00", 1, 1)))   # an hour late: counted
    log.add(clicks(("2024-01-10 09:00:00", 1, 1)))   # ten days late: dropped
    log.run(streams.start_stat, watermark="1 day")
    assert [(r[0], r[-1]) for r in rows(streams.read_latest_stat(spark, log.base))] == [
        ("2024-01-10", 1), ("2024-01-20", 2)]


def test_minutes(spark, clicks, log, rows):
    parts = [clicks((f"{DAY} 08:00:59.999", 1, 1), (f"{DAY} 07:59:30", 1, 1)),
             clicks((f"{DAY} 08:01:00", 1, 1), (f"{DAY} 08:00:10", 1, 1), (f"{DAY} 08:59:59", 2, 2))]
    for part in parts:
        log.add(part)
    query = log.run(streams.start_minute_clicks)
    trend = streams.read_trend(spark, log.base)
    assert rows(trend) == [(DAY, "07", "59", 1, 1), (DAY, "08", "00", 1, 2), (DAY, "08", "01", 1, 1),
                           (DAY, "08", "59", 2, 1)]
    assert [r[1:3] for r in rows(streams.last_minutes(trend))] == [("08", "00"), ("08", "01"), ("08", "59")]
    report = [r for r in offset_report(query) if r["rows"]]
    assert [r["rows"] for r in report] == [2, 3] and [r["batch_id"] for r in report] == [0, 1]
    assert report[0]["until_offset"] == report[1]["from_offset"]


@pytest.fixture
def zone(spark):
    def use(name):
        spark.conf.set("spark.sql.session.timeZone", name)
    before = spark.conf.get("spark.sql.session.timeZone")
    yield use
    use(before)


def at_millis(spark, *seconds):
    """Clicks at given seconds of the epoch."""
    lines = spark.createDataFrame([(f"{s}000 1 1 1 1",) for s in seconds], "value string")
    return parse_clicks(lines)


def test_a_local_day_is_one_count(spark, zone, log, rows):
    zone("Asia/Shanghai")
    start = 1704816000                       # 2024-01-10 00:00 there
    parts = [(start + 3600,), (start + 10 * 3600, start + 23 * 3600), (start + 24 * 3600,)]
    for part in parts:
        log.add(at_millis(spark, *part))
    log.run(streams.start_stat, watermark="1 hour")
    bounded = ads.ad_stat(at_millis(spark, *[s for part in parts for s in part]))
    assert rows(streams.read_latest_stat(spark, log.base)) == rows(bounded)
    assert [r[-1] for r in rows(bounded)] == [3, 1]


def test_minutes_of_the_hour_a_clock_shows_twice(spark, zone, log, rows):
    zone("America/New_York")
    first = 1730611800                       # 2024-11-03 01:30, and again an hour later
    for s in (first, first + 3600, first + 3601):
        log.add(at_millis(spark, s))
    log.run(streams.start_minute_clicks)
    bounded = ads.minute_clicks(at_millis(spark, first, first + 3600, first + 3601))
    assert rows(streams.read_trend(spark, log.base)) == rows(bounded) == [("2024-11-03", "01", "30", 1, 3)]


def test_late_clicks_count(spark, clicks, log, rows):
    data = [(f"{DAY} 12:00:00", 1, 1), (f"{DAY} 12:30:00", 1, 1), (f"{DAY} 13:00:00", 1, 1), (f"{DAY} 10:30:00", 1, 1)]
    for row in data:
        log.add(clicks(row))
    log.run(streams.start_minute_clicks)
    log.run(streams.start_sliding_clicks, checkpoint=f"{log.root}/sliding")
    assert rows(streams.read_trend(spark, log.base)) == rows(ads.minute_clicks(clicks(*data)))
    assert rows(streams.read_sliding(spark, log.base)) == rows(ads.sliding_clicks(clicks(*data)))
    every = [r for r in rows(streams.read_sliding(spark, log.base)) if f"{DAY} 08:30:00" <= r[0] <= f"{DAY} 09:10:00"]
    some = streams.read_sliding(spark, log.base, since=f"{DAY} 08:30:00", until=f"{DAY} 09:10:00")
    assert rows(some) == every
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "(date" in plan[plan.index("PartitionFilters"):] and DAY in plan[plan.index("PartitionFilters"):]


def test_a_new_checkpoint_adds_to_the_tables(spark, clicks, rows, tmp_path):
    old, new = (Log(spark, str(tmp_path / name)) for name in ("old", "new"))
    new.base = old.base
    first = [(f"{DAY} 08:00:0{i}", 1, 1) for i in range(5)]
    for one, data in ((old, first), (new, [(f"{DAY} 09:00:00", 1, 1)])):
        one.add(clicks(*data))
        one.run(streams.start_ad_job, threshold=6)
    everything = clicks(*first, (f"{DAY} 09:00:00", 1, 1))
    assert rows(streams.read_stat(spark, old.base)) == rows(ads.ad_stat(everything))
    assert rows(streams.read_user_counts(spark, old.base)) == [(DAY, 1, 1, 6)]
    assert rows(streams.read_blacklist(spark, old.base)) == [(1,)]
    assert rows(streams.read_province_top(spark, old.base)) == rows(ads.province_top_ads(ads.ad_stat(everything)))


def test_rankings_that_no_click_touches_stay(spark, clicks, log, rows):
    import pathlib
    log.add(clicks(("2024-01-10 08:00:00", 1, 1)))
    log.run(streams.start_province_top)
    files = {f: f.stat().st_mtime_ns for f in pathlib.Path(log.base, streams.TOP3).rglob("*.parquet")}
    for i in range(3):
        log.add(clicks((f"2024-01-20 08:00:0{i}", 1, 1)))
    log.run(streams.start_province_top)
    assert files and all(f.stat().st_mtime_ns == t for f, t in files.items())
    assert [(r[0], r[-1]) for r in rows(streams.read_province_top(spark, log.base))] == [
        ("2024-01-10", 1), ("2024-01-20", 3)]


def test_sliding_windows_equal_the_bounded_form(spark, clicks, log, rows):
    """All windows that the watermark has closed; a late marker click closes those of the data."""
    data = [(f"{DAY} 08:0{m}:{s:02}", u, u % 2) for m, s, u in
            [(0, 10, 1), (0, 40, 2), (1, 5, 3), (1, 31, 4), (4, 0, 5), (4, 29, 6)]]
    log.add(clicks(*data))
    log.add(clicks(("2024-01-12 00:00:00", 9, 9)))
    stream = parse_clicks(text_stream(spark, f"{log.root}/log", 1))
    query = (streams.sliding_clicks(stream, "2 minutes", "30 seconds", "1 minute").writeStream
             .format("memory").queryName("sliding").outputMode("append")
             .option("checkpointLocation", log.checkpoint).trigger(**streams.UNTIL_NOW).start())
    query.awaitTermination()
    assert rows(spark.table("sliding")) == rows(ads.sliding_clicks(clicks(*data), "2 minutes", "30 seconds"))


def test_bad_lines_go_aside_and_the_stream_goes_on(spark, clicks, log):
    log.add(clicks((f"{DAY} 08:00:00", 1, 1)))
    spark.createDataFrame([("abc 1 2",), ("",)], "value string").coalesce(1).write.mode("append").text(f"{log.root}/log")
    log.add(clicks((f"{DAY} 08:00:01", 1, 1)))
    assert log.run(streams.start_blacklist, threshold=3) is not None
    assert streams.read_user_counts(spark, log.base).first().click_count == 2
    rejects = rejected_lines(text_stream(spark, f"{log.root}/log"))
    query = (rejects.writeStream.format("memory").queryName("rejects").trigger(**streams.UNTIL_NOW)
             .option("checkpointLocation", f"{log.root}/rejects").start())
    query.awaitTermination()
    assert sorted(r.value for r in spark.table("rejects").collect()) == ["", "abc 1 2"]


def test_named_places(spark, log, rows):
    """Province and city may be text; the tables follow."""
    lines = [f"170490720{i}000 Jiangsu {city} 1 {ad}" for i, (city, ad) in enumerate(
        [("Nanjing", 1), ("Nanjing", 2), ("Suzhou", 1)])]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{log.root}/log")
    clicks = parse_clicks(text_stream(spark, f"{log.root}/log"), text_places=True)
    for start, place in ((streams.start_ad_job, "job"), (screening.start_screening, "screening")):
        start(clicks, f"{log.root}/{place}", f"{log.root}/{place}-checkpoint", threshold=9,
              trigger=streams.UNTIL_NOW).awaitTermination()
    stat, top = schemas.like(schemas.AD_STAT, clicks), schemas.like(schemas.AD_PROVINCE_TOP3, clicks)
    expected = [("2024-01-10", "Jiangsu", "Nanjing", 1, 1), ("2024-01-10", "Jiangsu", "Nanjing", 2, 1),
                ("2024-01-10", "Jiangsu", "Suzhou", 1, 1)]
    assert rows(streams.read_stat(spark, f"{log.root}/job", schema=stat)) == expected
    assert rows(streams.read_province_top(spark, f"{log.root}/job", top)) == [
        ("2024-01-10", "Jiangsu", 1, 2), ("2024-01-10", "Jiangsu", 2, 1)]
    kept = screening.read_kept(spark, f"{log.root}/screening", schemas.like(screening.KEPT_CLICK, clicks))
    assert rows(ads.ad_stat(kept)) == expected


def test_stop_while_running(spark, clicks, log):
    log.add(clicks((f"{DAY} 08:00:00", 1, 1)))
    stream = parse_clicks(text_stream(spark, f"{log.root}/log", 1))
    query = streams.start_blacklist(stream, log.base, log.checkpoint, 3, trigger={"processingTime": "0 seconds"},
                                    name="live")
    try:
        query.processAllAvailable()
        log.add(clicks((f"{DAY} 08:00:05", 1, 1)))
        query.processAllAvailable()
        assert query.name == "live" and query.isActive
    finally:
        query.stop()
    assert streams.read_user_counts(spark, log.base).first().click_count == 2


def test_stream_steps_run_where_the_package_is_not(tmp_path):
    """A worker gets the steps by value."""
    import subprocess
    import sys

    from pyspark import cloudpickle
    (tmp_path / "steps").write_bytes(cloudpickle.dumps([users.first_clicks(3), users.screen_user(3, None)]))
    code = "import pickle; print(len(pickle.load(open('steps', 'rb'))))"
    done = subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout.strip() == "2"


def test_a_bucket_is_screened_where_the_package_is_not(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle
    (tmp_path / "step").write_bytes(cloudpickle.dumps(users.screen_users(3, None)))
    subprocess.run([sys.executable, "-I", "-c", "import pickle; pickle.load(open('step', 'rb'))"], cwd=tmp_path, check=True)


def test_map_state_gets_a_store_that_can_hold_it(spark):
    """In a session made by others too; a store of another kind stays."""
    from footfall import runtime
    other = spark.newSession()
    other.conf.unset(runtime.STATE_PROVIDER)
    hdfs = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    for before, after in ((hdfs, runtime.ROCKSDB), (runtime.ROCKSDB, runtime.ROCKSDB), ("own.Provider", "own.Provider")):
        other.conf.set(runtime.STATE_PROVIDER, before)
        runtime.need_map_state(other)
        assert other.conf.get(runtime.STATE_PROVIDER) == after
