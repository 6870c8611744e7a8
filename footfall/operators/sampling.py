"""Hour-proportional sample of sessions, and the actions of the sampled sessions.

Which sessions of an hour are drawn is decided by the order of ``md5(seed || session_id)``, so
a rerun, a retry or a second table drawn from the same sample all agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.times import format_date, format_time, hour_text
from footfall.operators.sessions import NO_FILTER, SessionFilter, kept_sessions, session_rollup, with_task

# A sample never has more rows than 24 * (size + days * extra); a hundred years have this many days.
CALENDAR_DAYS = 36_525
# Rows of one text id that are safe to broadcast (about 100 MB).
BROADCAST_ROWS = 1_000_000


def _with_hour(sessions: DataFrame) -> DataFrame:
    return sessions.select("session_id", "start_time",
                           format_date(F.col("start_time")).alias("date"),
                           hour_text(F.col("start_time")).alias("hour"))


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """Sessions that start in each hour of each day."""
    return _with_hour(sessions).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("session_count"))


def hour_share_of_day(per_hour: DataFrame) -> DataFrame:
    """Each hour's sessions, the day's total and the hour's share of it."""
    day = Window.partitionBy("date")   # at most 24 rows
    return (per_hour.withColumn("day_count", F.sum("session_count").over(day))
            .withColumn("share", F.col("session_count") / F.col("day_count").cast("double")))


def _with_quota(shares: DataFrame, days: Column, sample_size: int, extra: int) -> DataFrame:
    per_day = F.floor(F.lit(sample_size).cast("int") / days)
    wanted = F.floor(F.col("share") * per_day) + F.lit(extra)
    return shares.withColumn("quota", F.least(F.col("session_count"), wanted))


def hour_quota(per_hour: DataFrame, sample_size: int = 100, extra: int = 1) -> DataFrame:
    """How many sessions to draw from each hour.

    ``sample_size`` is spread evenly over the days (whole division), then over the hours of a day
    by their share, cut to a whole number.  ``extra`` sessions more are drawn per hour (1 by
    default, as the original job does; 0 gives the proportional number), never more than there are.
    """
    days = per_hour.agg(F.count_distinct("date")).scalar()
    return _with_quota(hour_share_of_day(per_hour), days, sample_size, extra).select(
        "date", "hour", "session_count", "quota")


def sample_sessions(sessions: DataFrame, sample_size: int = 100, extra: int = 1, seed: str = "") -> DataFrame:
    """``session_id``, ``date`` and ``hour`` of the drawn sessions.

    The drawing order is that of a hash, so its first two digits cut every hour into 256 even parts
    that are in order themselves.  Counting the parts tells in which of them the quota of the hour
    ends; only sessions up to there are put in order, part by part, whatever the size of an hour
    and of the sample.
    """
    drawing = (_with_hour(sessions)
               .select("session_id", "date", "hour",
                       F.md5(F.concat(F.lit(seed), F.col("session_id"))).alias("_draw"))
               # Never NULL: a test for that would set the two uses of the roll-up below apart.
               .withColumn("_part", F.coalesce(F.substring("_draw", 1, 2), F.lit(""))))
    counts = drawing.groupBy("date", "hour", "_part").agg(F.count(F.lit(1)).alias("_n"))
    hour, day = Window.partitionBy("date", "hour"), Window.partitionBy("date")   # 256 and 24 * 256 rows
    earlier = F.sum("_n").over(hour.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = (counts.withColumn("session_count", F.sum("_n").over(hour))
             .withColumn("_before", F.coalesce(earlier, F.lit(0)))
             .withColumn("share", F.col("session_count") / F.sum("_n").over(day).cast("double")))
    days = counts.agg(F.count_distinct("date")).scalar()
    needed = (_with_quota(parts, days, sample_size, extra).where(F.col("_before") < F.col("quota"))
              .select("date", "hour", "_part", "_before", "quota"))
    nth = F.row_number().over(Window.partitionBy("date", "hour", "_part").orderBy("_draw", "session_id"))
    return (drawing.join(needed, ["date", "hour", "_part"]).withColumn("_nth", nth + F.col("_before"))
            .where(F.col("_nth") <= F.col("quota")).select("session_id", "date", "hour"))


def actions_of_sample(actions: DataFrame, sampled: DataFrame, sample_size: int, extra: int) -> DataFrame:
    """The actions of sampled sessions; the sample is broadcast only while its bound allows."""
    ids = sampled.select("session_id")
    if 24 * (sample_size + CALENDAR_DAYS * extra) <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    return actions.join(ids, "session_id", "left_semi")


def session_random_extract(actions: DataFrame, users: DataFrame, sample_size: int = 100, extra: int = 1,
                           seed: str = "", flt: SessionFilter = NO_FILTER,
                           task_id: str | None = None) -> DataFrame:
    """The drawn sessions with start time, search words and clicked categories.

    Words and categories are collected for the drawn sessions only.
    """
    sampled = sample_sessions(kept_sessions(actions, users, flt), sample_size, extra, seed)
    rolled = session_rollup(actions_of_sample(actions, sampled, sample_size, extra), with_sets=True)
    return with_task(rolled.select("session_id", format_time(F.col("start_time")).alias("start_time"),
                                   "search_keywords", "click_category_ids"), task_id)


def session_detail(actions: DataFrame, users: DataFrame, sample_size: int = 100, extra: int = 1,
                   seed: str = "", flt: SessionFilter = NO_FILTER, task_id: str | None = None) -> DataFrame:
    """Every action of the drawn sessions."""
    sampled = sample_sessions(kept_sessions(actions, users, flt), sample_size, extra, seed)
    return with_task(detail_columns(actions_of_sample(actions, sampled, sample_size, extra)), task_id)


def detail_columns(actions: DataFrame) -> DataFrame:
    """The columns of a session detail row."""
    return actions.select(
        "user_id", "session_id", "page_id", format_time(F.col("action_time")).alias("action_time"),
        "search_keyword", "click_category_id", "click_product_id", "order_category_ids",
        "order_product_ids", "pay_category_ids", "pay_product_ids")
