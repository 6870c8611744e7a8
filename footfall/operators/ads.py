"""Ad click analytics over a bounded table of clicks.

A click is ``ts, province, city, userid, adid``; its day comes from ``ts``.  The streaming forms
are in :mod:`footfall.streaming`; these are what their tables add up to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.times import format_date, format_time, hour_text, minute_text
from footfall.runtime import stored

BLACKLIST_THRESHOLD = 100
# Rows of one day, user and ad each that are safe to broadcast (about 50 MB).
BROADCAST_ROWS = 1_000_000
TOP_ADS = 3
USER_KEYS = ["date", "userid", "adid"]
STAT_KEYS = ["date", "province", "city", "adid"]
PROVINCE_KEYS = ["date", "province", "adid"]
TREND_KEYS = ["date", "hour", "minute", "adid"]


def with_day(clicks: DataFrame) -> DataFrame:
    return clicks.withColumn("date", format_date(F.col("ts")))


def click_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("click_count"))


def daily_counts(clicks: DataFrame, keys: list[str]) -> DataFrame:
    """Clicks per day and the other ``keys``; a day is counted as a number and put into words after."""
    days = clicks.withColumn("date", F.to_date("ts"))
    return click_counts(days, keys).withColumn("date", format_date(F.col("date")))


def user_click_counts(clicks: DataFrame) -> DataFrame:
    """Clicks of each user on each ad per day."""
    return daily_counts(clicks, USER_KEYS)


def nth_click(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` clicks of each day, user and ad, numbered in ``_nth``.

    The constant bound keeps at most ``n`` clicks of a key per map task, so a user with very many
    clicks costs no more than another (Spark applies it up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000 by default).
    """
    w = Window.partitionBy("userid", "adid", "date").orderBy("ts")   # numbers first: quicker to sort
    return (rows.select(*USER_KEYS, "ts").withColumn("_nth", F.row_number().over(w))
            .where(F.col("_nth") <= n))


def blacklist_cutoffs(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Users with ``threshold`` clicks on one ad in one day, and when the first such click was.

    Counting tells which days, users and ads get there at all.  As long as these are few, and that
    is checked, only their clicks are put in order.
    """
    rows = clicks.withColumn("date", F.to_date("ts"))
    reached = stored(click_counts(rows, USER_KEYS).where(F.col("click_count") >= threshold)
                     .select(*USER_KEYS), "reached")
    if reached.count() <= BROADCAST_ROWS:
        rows = rows.join(F.broadcast(reached), USER_KEYS, "left_semi")
    return (nth_click(rows, threshold).where(F.col("_nth") == threshold)
            .groupBy("userid").agg(F.min("ts").alias("cutoff")))


def blacklist(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """The users that reach ``threshold`` clicks on one ad in one day, each once."""
    return blacklist_cutoffs(clicks, threshold).select("userid")


def drop_after_cutoff(clicks: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Clicks up to and including the one that put their user on the blacklist."""
    return (clicks.join(cutoffs, "userid", "left")
            .where(F.col("cutoff").isNull() | (F.col("ts") <= F.col("cutoff")))
            .select(*clicks.columns))


def filtered_clicks(clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """All clicks but those a user makes after being blacklisted.

    The cutoffs are written out first.  Spark then knows their true size: while they are small, as
    they should be, the clicks are filtered as they are scanned and are not shuffled for it.
    """
    return drop_after_cutoff(clicks, stored(blacklist_cutoffs(clicks, threshold), "cutoffs"))


def drop_users(clicks: DataFrame, blacklisted: DataFrame) -> DataFrame:
    """All clicks but those of the given users."""
    return clicks.join(blacklisted.select("userid"), "userid", "left_anti").select(*clicks.columns)


def ad_stat(clicks: DataFrame) -> DataFrame:
    """Clicks per day, province, city and ad."""
    return daily_counts(clicks, STAT_KEYS)


def province_counts(stat: DataFrame) -> DataFrame:
    """:func:`ad_stat` with the cities of a province added up."""
    return stat.groupBy(*PROVINCE_KEYS).agg(F.sum("click_count").alias("click_count"))


def top_ads(counts: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """The ads ranked 1 to ``n`` per day and province; ties share a rank."""
    w = Window.partitionBy("date", "province").orderBy(F.desc("click_count"))
    return (counts.withColumn("_rank", F.rank().over(w)).where(F.col("_rank") <= n)
            .select("date", "province", "adid", "click_count"))


def province_top_ads(stat: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """:func:`top_ads` of an :func:`ad_stat` table."""
    return top_ads(province_counts(stat), n)


def province_top_ads_all_days(stat: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """The ``n`` largest day-and-ad counts of each province, over all days."""
    w = Window.partitionBy("province").orderBy(F.desc("click_count"), "date", "adid")
    return (province_counts(stat).withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= n)
            .select("date", "province", "adid", "click_count"))


def minute_columns(ts: Column) -> list[Column]:
    return [format_date(ts).alias("date"), hour_text(ts).alias("hour"), minute_text(ts).alias("minute")]


def minute_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks per minute and ad; the minutes are put into words after counting."""
    # By way of the local time, so that the two hours a clock may show twice count as one.
    minute = F.date_trunc("minute", F.col("ts").cast("timestamp_ntz").cast("timestamp"))
    counts = click_counts(clicks.select(minute.alias("_minute"), "adid"), ["_minute", "adid"])
    return counts.select(*minute_columns(F.col("_minute")), "adid", "click_count")


def click_trend(clicks: DataFrame, minutes: int = 60) -> DataFrame:
    """Clicks per minute and ad over the last ``minutes`` minutes up to the newest click."""
    newest = clicks.agg(F.max("ts")).scalar()
    first = F.date_trunc("minute", newest) - F.expr(f"INTERVAL {minutes - 1} MINUTES")
    return minute_clicks(clicks.where(F.col("ts").cast("timestamp") >= first))


def pane_clicks(clicks: DataFrame, slide: str = "30 seconds") -> DataFrame:
    """Clicks per ad in consecutive panes of the length ``slide``, by the end of the pane."""
    return (clicks.groupBy(F.window(F.col("ts").cast("timestamp"), slide).alias("_pane"), "adid")
            .agg(F.count(F.lit(1)).alias("click_count"))
            .select(F.col("_pane.end").alias("pane_end"), "adid", "click_count"))


def _micros(df: DataFrame, interval: str) -> int:
    return df.sparkSession.sql(f"SELECT unix_micros(TIMESTAMP_SECONDS(0) + INTERVAL {interval})").first()[0]


def sliding_sums(panes: DataFrame, length: str = "60 minutes", slide: str = "30 seconds", since: str | None = None,
                 until: str | None = None) -> DataFrame:
    """:func:`pane_clicks` added up for every window of panes that saw any click.

    A pane adds its clicks at the first window that has it and takes them away after the last one, so it is two events
    whatever the length of a window.  The running sum of an ad's events is the count of every window up to the next event.  It is
    built within days, and what the days before add up to is carried over.  ``since`` and ``until`` (times as text) keep
    the windows that end between them.  ``length`` must be a multiple of ``slide``.
    """
    if _micros(panes, length) % _micros(panes, slide):
        raise ValueError(f"windows of {length} are not made of panes of {slide}")
    last = F.col("pane_end") + F.expr(f"INTERVAL {length}")
    events = panes.select("adid", F.explode(F.array(
        F.struct(F.col("pane_end").alias("_at"), F.col("click_count").alias("_change")),
        F.struct(last.alias("_at"), (-F.col("click_count")).alias("_change")))).alias("_event")).select("adid", "_event.*")
    events = events.withColumn("_day", F.floor(F.unix_seconds("_at") / 86400)).repartition("adid", "_day")
    changes = events.groupBy("adid", "_day", "_at").agg(F.sum("_change").alias("_change"))
    days = events.groupBy("adid", "_day").agg(F.sum("_change").alias("_total"), F.min("_at").alias("_first"))
    by_day, inside = Window.partitionBy("adid").orderBy("_day"), Window.partitionBy("adid", "_day").orderBy("_at")
    days = days.select("adid", "_day", F.lead("_first").over(by_day).alias("_next_day"), F.coalesce(
        F.sum("_total").over(by_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    sums = changes.withColumns({"_sum": F.sum("_change").over(inside), "_next": F.lead("_at").over(inside)}).join(days, ["adid", "_day"])
    sums = sums.select("adid", "_at", (F.col("_sum") + F.col("_before")).alias("click_count"),
                       (F.coalesce("_next", "_next_day") - F.expr(f"INTERVAL {slide}")).alias("_last")).where("click_count > 0")
    windows = sums.select(F.explode(F.sequence("_at", "_last", F.expr(f"INTERVAL {slide}"))).alias("_end"), "adid", "click_count")
    for bound, wanted in ((since, lambda t: F.col("_end") >= t), (until, lambda t: F.col("_end") <= t)):
        windows = windows if bound is None else windows.where(wanted(F.lit(bound).cast("timestamp")))
    return windows.select(format_time(F.col("_end")).alias("window_end"), "adid", "click_count")


def sliding_clicks(clicks: DataFrame, length: str = "60 minutes", slide: str = "30 seconds") -> DataFrame:
    """Clicks per ad in every sliding window that saw any, by the end of the window.

    Clicks are counted per slide first; see :func:`sliding_sums`.
    """
    return sliding_sums(pane_clicks(clicks, slide), length, slide)
