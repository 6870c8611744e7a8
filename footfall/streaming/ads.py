"""Ad click streams: blacklist, running counts, province favourites and the minute trend.

``clicks`` is a streaming DataFrame of ``ts, province, city, userid, adid`` (see
:func:`footfall.sources.clicks.parse_clicks`).  Every function starts one query; its tables lie
below ``base`` and its checkpoint below ``checkpoint``, both in a folder that all executors reach.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from footfall import schemas
from footfall.operators import ads
from footfall.sinks import tables, versions
from footfall.streaming.users import screened

EVERY_5_SECONDS = {"processingTime": "5 seconds"}
UNTIL_NOW = {"availableNow": True}

USER_COUNTS, BLACKLIST, STAT, TOP3, TREND = (
    "ad_user_click_count", "ad_blacklist", "ad_stat", "ad_province_top3", "ad_click_trend")
PROVINCE_COUNTS, PANES = "ad_province_count", "ad_click_panes"
PANE = T.StructType([T.StructField("date", T.StringType()), T.StructField("pane_end", T.TimestampType()),
                     T.StructField("adid", T.LongType()), T.StructField("click_count", T.LongType())])
PANE_KEYS = ["date", "pane_end", "adid"]


# ---- the tables a stream keeps ------------------------------------------------------------

def read_user_counts(spark: SparkSession, base: str, before: int | None = None,
                     run: str = tables.ONE_RUN) -> DataFrame:
    return tables.read_sums(spark, f"{base}/{USER_COUNTS}", schemas.AD_USER_CLICK_COUNT, ads.USER_KEYS,
                            "click_count", before, run)


def read_blacklist(spark: SparkSession, base: str, before: int | None = None,
                   run: str = tables.ONE_RUN) -> DataFrame:
    return tables.read_batches(spark, f"{base}/{BLACKLIST}", schemas.AD_BLACKLIST, before, run).select("userid")


# Tables with places take a schema, for logs that name province and city (see schemas.like).

def read_stat(spark: SparkSession, base: str, before: int | None = None,
              schema: T.StructType = schemas.AD_STAT, run: str = tables.ONE_RUN) -> DataFrame:
    """Counts kept as increments by :func:`start_ad_job`."""
    return tables.read_sums(spark, f"{base}/{STAT}", schema, ads.STAT_KEYS, "click_count", before, run)


def read_latest_user_counts(spark: SparkSession, base: str) -> DataFrame:
    """Counts kept as latest values by :func:`start_user_counts`."""
    return tables.read_latest(spark, f"{base}/{USER_COUNTS}", schemas.AD_USER_CLICK_COUNT, ads.USER_KEYS,
                              "click_count")


def read_latest_stat(spark: SparkSession, base: str, schema: T.StructType = schemas.AD_STAT) -> DataFrame:
    """Counts kept as latest values by :func:`start_stat`."""
    return tables.read_latest(spark, f"{base}/{STAT}", schema, ads.STAT_KEYS, "click_count")


def read_province_top(spark: SparkSession, base: str,
                      schema: T.StructType = schemas.AD_PROVINCE_TOP3) -> DataFrame:
    return tables.read_or_empty(spark, f"{base}/{TOP3}", schema)


def read_trend(spark: SparkSession, base: str) -> DataFrame:
    """Minute counts kept by :func:`start_ad_job` or :func:`start_minute_clicks`."""
    return tables.read_sums(spark, f"{base}/{TREND}", schemas.AD_CLICK_TREND, ads.TREND_KEYS, "click_count")


def read_sliding(spark: SparkSession, base: str, length: str = "60 minutes", slide: str = "30 seconds",
                 since: str | None = None, until: str | None = None) -> DataFrame:
    """Sliding windows over the panes kept by :func:`start_sliding_clicks` with the same ``slide``.

    Of windows that end between ``since`` and ``until`` (times as text) only the days of their panes are opened.
    """
    panes = tables.read_batches(spark, _panes(base, slide), PANE)
    if since is not None:
        first = F.lit(since).cast("timestamp") - F.expr(f"INTERVAL {length}")
        panes = panes.where((F.col("date") >= ads.format_date(first)) & (F.col("pane_end") > first))
    if until is not None:
        last = F.lit(until).cast("timestamp")
        panes = panes.where((F.col("date") <= ads.format_date(last)) & (F.col("pane_end") <= last))
    sums = panes.groupBy(*PANE_KEYS).agg(F.sum("click_count").alias("click_count"))
    return ads.sliding_sums(sums, length, slide, since, until)


def _panes(base: str, slide: str) -> str:
    return f"{base}/{PANES}/{slide.replace(' ', '_')}"


def last_minutes(trend: DataFrame, minutes: int = 60) -> DataFrame:
    """The part of a trend table that lies in the ``minutes`` minutes up to its newest one.

    Days, which are folders, are chosen before minutes are looked at.
    """
    at = F.to_timestamp(F.concat_ws(" ", "date", F.concat_ws(":", "hour", "minute")), "yyyy-MM-dd HH:mm")
    newest = trend.where(F.col("date") == trend.agg(F.max("date")).scalar()).agg(F.max(at).alias("at"))
    first = newest.select(F.col("at") - F.expr(f"INTERVAL {minutes} MINUTES"))
    return trend.where(F.col("date") >= first.select(ads.format_date(F.col(first.columns[0]))).scalar()).where(
        at > first.scalar())


# ---- one batch ----------------------------------------------------------------------------

def _in_days_of(table: DataFrame, rows: DataFrame, most: int = 1000) -> DataFrame:
    """The days of a table that ``rows`` has; days are folders, and others are not opened.

    With more than ``most`` different days, all from the first to the last.
    """
    days = [r[0] for r in rows.select("date").distinct().limit(most + 1).collect()]
    if len(days) <= most:
        return table.where(F.col("date").isin(days))
    return table.where(F.col("date").between(rows.agg(F.min("date")).scalar(), rows.agg(F.max("date")).scalar()))


def _fold(spark: SparkSession, base: str, table: str, schema: T.StructType, keys: list[str], how: str, batch_id: int,
          run: str, every: int) -> None:
    """Now and then fold the batches of a table into its base; tables with days have them as folders."""
    value, days = ("click_count", ["date"]) if how != versions.ROWS else (None, [])
    versions.fold_sometimes(spark, f"{base}/{table}", schema, keys, value, how, batch_id, run, days, every)


def _earlier(clicks: DataFrame, base: str, checkpoint: str) -> DataFrame | None:
    """What other runs have in the tables, for a query that begins; none if there is nothing.

    A query that begins again on its checkpoint has its own state, and its first batch must not see what that batch
    wrote before a failure, so the run of the checkpoint is left out.
    """
    spark, own = clicks.sparkSession, None
    files = versions.Folder(spark, checkpoint)
    if "metadata" in files.names():
        own = json.loads(files.text("metadata"))["id"]
    found = {t: versions.snapshot(spark, f"{base}/{t}").others(own) for t in (USER_COUNTS, BLACKLIST)}
    if not any(at.parts or at.batches for at in found.values()):
        return None
    counts = tables.read_sums(spark, f"{base}/{USER_COUNTS}", schemas.AD_USER_CLICK_COUNT, ads.USER_KEYS, "click_count", at=found[USER_COUNTS])
    listed = tables.read_batches(spark, f"{base}/{BLACKLIST}", schemas.AD_BLACKLIST, at=found[BLACKLIST]).select(
        "userid", F.lit(None).cast("string").alias("date"), F.lit(None).cast("long").alias("adid"), F.lit(None).cast("long").alias("click_count"))
    return counts.select(*listed.columns).unionByName(listed)


def _record(kept: DataFrame, listed: DataFrame, batch_id: int, base: str, run: str = tables.ONE_RUN,
            fold_every: int = versions.FOLD_EVERY) -> None:
    """Add a screened batch to the user counts and the blacklist; a user is listed once, by the state."""
    tables.write_batch(ads.click_counts(ads.with_day(kept), ads.USER_KEYS), f"{base}/{USER_COUNTS}", batch_id, ["date"], run)
    tables.write_batch(listed, f"{base}/{BLACKLIST}", batch_id, run=run)
    _fold(kept.sparkSession, base, USER_COUNTS, schemas.AD_USER_CLICK_COUNT, ads.USER_KEYS, versions.ADD, batch_id, run, fold_every)
    _fold(kept.sparkSession, base, BLACKLIST, schemas.AD_BLACKLIST, ["userid"], versions.ROWS, batch_id, run, fold_every)


def _province_step(changed: DataFrame, counts: DataFrame, base: str, top: int) -> None:
    """Rank anew the days and provinces that a batch touched, and replace them in the table.

    ``counts`` has clicks per day, province and ad, with a folder per day.
    """
    touched = changed.select("date", "province").distinct()
    current = _in_days_of(counts, touched).join(touched, ["date", "province"], "left_semi")
    tables.replace_by_key(ads.top_ads(current, top), f"{base}/{TOP3}", ["date", "province"])


def _each_batch(df: DataFrame, step: Callable[[DataFrame, int, str], None], checkpoint: str, name: str | None,
                trigger: dict | None, mode: str) -> StreamingQuery:
    """Start a query that calls ``step`` with each batch, its number and the id that the checkpoint gives the query."""
    def run(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not query_id:
            raise RuntimeError("the id of the streaming query is not known, so its batches cannot be told from others")
        batch.persist()   # a batch is read several times
        try:
            step(batch, batch_id, query_id)
        finally:
            batch.unpersist()

    writer = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
              .trigger(**(trigger or EVERY_5_SECONDS)).foreachBatch(run))
    return (writer.queryName(name) if name else writer).start()


# ---- queries ------------------------------------------------------------------------------

def start_ad_job(clicks: DataFrame, base: str, checkpoint: str, threshold: int = ads.BLACKLIST_THRESHOLD,
                 exact: bool = False, top: int = ads.TOP_ADS, trend_of_all: bool = False,
                 trigger: dict | None = None, name: str | None = None,
                 fold_every: int = versions.FOLD_EVERY) -> StreamingQuery:
    """All of the ad tables from one reading of the stream.

    Each batch in turn: drop blacklisted users, add to the user counts, extend the blacklist, add
    to the counts per place and per minute, refresh the touched days.  ``trend_of_all`` counts
    the minutes over all clicks, blacklisted or not.  With ``exact`` a user's clicks stop right after the one that
    reaches the threshold, otherwise from the next batch on.

    What a user has clicked so far is looked up in the query's state (:mod:`footfall.streaming.users`), by the
    entries a batch has clicks for; only the counts of the days and provinces it touched are read from a table.
    """
    def step(batch: DataFrame, batch_id: int, run: str) -> None:
        kept = ads.with_day(batch.where("kept") if trend_of_all else batch)
        _record(kept, batch.where("listed").select("userid"), batch_id, base, run, fold_every)
        tables.write_batch(ads.ad_stat(kept), f"{base}/{STAT}", batch_id, ["date"], run)
        tables.write_batch(ads.minute_clicks(batch), f"{base}/{TREND}", batch_id, ["date"], run)
        schema = schemas.like(schemas.AD_STAT, clicks)
        stat = read_stat(batch.sparkSession, base, batch_id + 1, schema, run)
        _province_step(kept, ads.province_counts(stat), base, top)
        _fold(batch.sparkSession, base, STAT, schema, ads.STAT_KEYS, versions.ADD, batch_id, run, fold_every)
        _fold(batch.sparkSession, base, TREND, schemas.AD_CLICK_TREND, ads.TREND_KEYS, versions.ADD, batch_id, run, fold_every)

    passed = screened(clicks, threshold, None, exact, trend_of_all, _earlier(clicks, base, checkpoint))
    return _each_batch(passed, step, checkpoint, name, trigger, "append")


def start_blacklist(clicks: DataFrame, base: str, checkpoint: str, threshold: int = ads.BLACKLIST_THRESHOLD,
                    exact: bool = False, trigger: dict | None = None, name: str | None = None,
                    fold_every: int = versions.FOLD_EVERY) -> StreamingQuery:
    """The blacklist and the user counts only."""
    def step(batch: DataFrame, batch_id: int, run: str) -> None:
        _record(batch, batch.where("listed").select("userid"), batch_id, base, run, fold_every)

    return _each_batch(screened(clicks, threshold, None, exact, False, _earlier(clicks, base, checkpoint)), step, checkpoint, name, trigger, "append")


def start_stat(clicks: DataFrame, base: str, checkpoint: str, watermark: str | None = None,
               trigger: dict | None = None, name: str | None = None,
               fold_every: int = versions.FOLD_EVERY) -> StreamingQuery:
    """Running counts per day, province, city and ad, with the state kept by Spark.

    A batch writes the counts that changed only.  Without a ``watermark`` every count is kept for
    good; with one, days that ended before it leave the state and their late clicks are dropped.
    """
    return _running_counts(clicks, ads.STAT_KEYS, base, STAT, schemas.like(schemas.AD_STAT, clicks), checkpoint, watermark, trigger, name,
                           fold_every)


def start_user_counts(clicks: DataFrame, base: str, checkpoint: str, watermark: str | None = None,
                      trigger: dict | None = None, name: str | None = None,
                      fold_every: int = versions.FOLD_EVERY) -> StreamingQuery:
    """Running counts per day, user and ad, kept like those of :func:`start_stat`."""
    return _running_counts(clicks, ads.USER_KEYS, base, USER_COUNTS, schemas.AD_USER_CLICK_COUNT, checkpoint, watermark, trigger, name,
                           fold_every)


def _running_counts(clicks: DataFrame, keys: list[str], base: str, table: str, schema: T.StructType, checkpoint: str,
                    watermark: str | None, trigger: dict | None, name: str | None, fold_every: int) -> StreamingQuery:
    if watermark:
        # The end of the local day is the event time, so a day is one row of state in any time zone.  It lies up to
        # 25 hours (where clocks go back) after the click, and the watermark waits for as much longer.
        day_end = F.date_trunc("day", F.col("ts").cast("timestamp")) + F.expr("INTERVAL 1 DAY")
        days = ads.with_day(clicks).withColumn("_day_end", day_end).withWatermark("_day_end", f"{watermark} 25 hours")
        counted = ads.click_counts(days, ["_day_end", *keys]).drop("_day_end")
    else:
        counted = ads.daily_counts(clicks, keys)

    def step(batch: DataFrame, batch_id: int, run: str) -> None:
        tables.upsert_set(batch, f"{base}/{table}", batch_id, ["date"], run)
        _fold(batch.sparkSession, base, table, schema, keys, versions.SET, batch_id, run, fold_every)

    return _each_batch(counted, step, checkpoint, name, trigger, "update")


def start_province_top(clicks: DataFrame, base: str, checkpoint: str, top: int = ads.TOP_ADS,
                       trigger: dict | None = None, name: str | None = None,
                       fold_every: int = versions.FOLD_EVERY) -> StreamingQuery:
    """The favourite ads of each day and province, ranked anew when a batch touches them.

    Each batch adds its counts per day, province and ad to a table, reads the days it touched
    from it, and replaces the ranking of the days and provinces it touched; others stay as they are.
    """
    schema = schemas.like(schemas.AD_PROVINCE_TOP3, clicks)

    def step(batch: DataFrame, batch_id: int, run: str) -> None:
        added, path = ads.daily_counts(batch, ads.PROVINCE_KEYS), f"{base}/{PROVINCE_COUNTS}"
        tables.write_batch(added, path, batch_id, ["date"], run)
        counts = tables.read_sums(batch.sparkSession, path, schema, ads.PROVINCE_KEYS, "click_count", batch_id + 1, run)
        _province_step(added, counts, base, top)
        _fold(batch.sparkSession, base, PROVINCE_COUNTS, schema, ads.PROVINCE_KEYS, versions.ADD, batch_id, run, fold_every)

    return _each_batch(clicks, step, checkpoint, name, trigger, "append")


def start_minute_clicks(clicks: DataFrame, base: str, checkpoint: str, trigger: dict | None = None,
                        name: str | None = None,
                        fold_every: int = versions.FOLD_EVERY) -> StreamingQuery:
    """Clicks per minute and ad, however late they come: each batch adds its own counts to the table."""
    def step(batch: DataFrame, batch_id: int, run: str) -> None:
        tables.write_batch(ads.minute_clicks(batch), f"{base}/{TREND}", batch_id, ["date"], run)
        _fold(batch.sparkSession, base, TREND, schemas.AD_CLICK_TREND, ads.TREND_KEYS, versions.ADD, batch_id, run, fold_every)

    return _each_batch(clicks, step, checkpoint, name, trigger, "append")


def start_sliding_clicks(clicks: DataFrame, base: str, checkpoint: str, slide: str = "30 seconds",
                         trigger: dict | None = None, name: str | None = None,
                         fold_every: int = versions.FOLD_EVERY) -> StreamingQuery:
    """Counts per pane of ``slide`` and ad, of which :func:`read_sliding` makes windows; late clicks are added too."""
    def step(batch: DataFrame, batch_id: int, run: str) -> None:
        panes = ads.pane_clicks(batch, slide).withColumn("date", ads.format_date(F.col("pane_end")))
        tables.write_batch(panes, _panes(base, slide), batch_id, ["date"], run)
        versions.fold_sometimes(batch.sparkSession, _panes(base, slide), PANE, PANE_KEYS, "click_count", versions.ADD, batch_id, run,
                                ["date"], fold_every)

    return _each_batch(clicks, step, checkpoint, name, trigger, "append")


def sliding_clicks(clicks: DataFrame, length: str = "60 minutes", slide: str = "30 seconds",
                   watermark: str = "60 minutes") -> DataFrame:
    """Clicks per ad in sliding windows, each emitted once it can no longer change.

    Clicks later than ``watermark`` cannot be in it; :func:`start_sliding_clicks` counts all.

    The windows are built on counts per slide, not on clicks: a click updates one row of state, and
    only the counts are repeated for the windows they are in.
    """
    panes = (clicks.withWatermark("ts", watermark).groupBy(F.window("ts", slide).alias("pane"), "adid")
             .agg(F.count(F.lit(1)).alias("_n")))
    return (panes.groupBy(F.window("pane", length, slide).alias("_w"), "adid")
            .agg(F.sum("_n").alias("click_count"))
            .select(ads.format_time(F.col("_w.end")).alias("window_end"), "adid", "click_count"))
