"""Run a stream over the test clicks, and the keyed sinks over two halves of them.

The clicks are written out as log lines in time order, a part at a time.  After each part the same
query is started again on its checkpoint and runs until it has read everything, so every use of
this also goes through stopping and resuming.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall import schemas
from footfall.operators import ads
from footfall.plans import views
from footfall.runtime import shared_dir
from footfall.sinks import tables
from footfall.sources.clicks import click_records, parse_clicks, text_stream
from footfall.sources.logs import append_log, log_stream, remove_segment, segments
from footfall.streaming import ads as streams
from footfall.streaming.offsets import offset_ranges
from footfall.streaming.screening import kept_stream, start_screening

Start = Callable[..., StreamingQuery]


def time_parts(clicks: DataFrame, parts: int) -> list[DataFrame]:
    """The clicks cut into ``parts`` equal spans of time, oldest first."""
    first, last = clicks.agg(F.min("ts").cast("timestamp_ntz"), F.max("ts").cast("timestamp_ntz")).first()
    at = F.col("ts").cast("timestamp_ntz")
    marks = [first + (last - first) * i / parts for i in range(1, parts)]
    bounds = [None, *marks, None]
    out = []
    for low, high in zip(bounds, bounds[1:]):
        part = clicks if low is None else clicks.where(at >= F.lit(low))
        out.append(part if high is None else part.where(at < F.lit(high)))
    return out


def run_in_parts(spark: SparkSession, clicks: DataFrame, start: Start, parts: int = 2, newest_first: bool = False,
                 **options) -> str:
    """Feed ``clicks`` to the query ``start`` begins, part by part; returns the folder of its tables."""
    root = shared_dir(spark, "stream")
    for part in time_parts(clicks, parts)[::-1 if newest_first else 1]:
        click_records(part).write.mode("append").text(f"{root}/log")
        stream = parse_clicks(text_stream(spark, f"{root}/log"))
        start(stream, f"{root}/tables", f"{root}/checkpoint", trigger=streams.UNTIL_NOW,
              **options).awaitTermination()
    return f"{root}/tables"


# ---- sinks, written twice and read back ---------------------------------------------------

def upsert_add_twice(spark: SparkSession, clicks: DataFrame) -> DataFrame:
    """User counts of two halves added up, the second half written twice as after a failure."""
    path = shared_dir(spark, "sink")
    first, second = time_parts(clicks, 2)
    for batch_id, part in ((0, first), (1, second), (1, second)):
        tables.upsert_add(ads.user_click_counts(part), path, batch_id, ads.USER_KEYS, "click_count", ["date"])
    return tables.read_sums(spark, path, schemas.AD_USER_CLICK_COUNT, ads.USER_KEYS, "click_count")


def upsert_set_twice(spark: SparkSession, clicks: DataFrame) -> DataFrame:
    """Counts per place after the first half, then those the second half changed."""
    path = shared_dir(spark, "sink")
    first, second = time_parts(clicks, 2)
    tables.upsert_set(ads.ad_stat(first), path, 0, ["date"])
    changed = ads.ad_stat(second).select(*ads.STAT_KEYS)
    tables.upsert_set(ads.ad_stat(clicks).join(changed, ads.STAT_KEYS, "left_semi"), path, 1, ["date"])
    return tables.read_latest(spark, path, schemas.AD_STAT, ads.STAT_KEYS, "click_count")


def replace_twice(spark: SparkSession, clicks: DataFrame) -> DataFrame:
    """Province favourites after the first half, then those of the days the second half touched."""
    path = shared_dir(spark, "sink")
    first, second = time_parts(clicks, 2)
    keys = ["date", "province"]
    tables.replace_by_key(ads.province_top_ads(ads.ad_stat(first)), path, keys)
    touched = ads.ad_stat(second).select(*keys).distinct()
    now = ads.province_top_ads(ads.ad_stat(clicks)).join(touched, keys, "left_semi")
    tables.replace_by_key(now, path, keys)
    return tables.read_or_empty(spark, path, schemas.AD_PROVINCE_TOP3)


def table_twice(spark: SparkSession, clicks: DataFrame) -> DataFrame:
    """A catalog table of user counts, written for the first half and then replaced by that of all clicks."""
    name, path = f"user_counts_{uuid.uuid4().hex}", shared_dir(spark, "table")
    for part in (time_parts(clicks, 2)[0], clicks):
        tables.replace_table(ads.user_click_counts(part), name, ["date"], path)
    return spark.table(name).select(*schemas.AD_USER_CLICK_COUNT.names)


def insert_new_twice(spark: SparkSession, clicks: DataFrame) -> DataFrame:
    """Users of the first half, then the users new in the second half, twice."""
    path = shared_dir(spark, "sink")
    first, second = time_parts(clicks, 2)
    for batch_id, part in ((0, first), (1, second), (1, second)):
        tables.insert_new(part.select("userid"), path, batch_id, schemas.AD_BLACKLIST, ["userid"])
    return tables.read_batches(spark, path, schemas.AD_BLACKLIST).select("userid")


def append_twice(spark: SparkSession, clicks: DataFrame) -> DataFrame:
    """Minute counts of two halves in one folder."""
    path = shared_dir(spark, "sink")
    for part in time_parts(clicks, 2):
        tables.append_files(ads.minute_clicks(part), path, partition_by=["date"])
    return tables.read_or_empty(spark, path, schemas.AD_CLICK_TREND)


def stream_tables(spark: SparkSession, sf_dir: str, start: Start, **options) -> str:
    """Run one query over the test clicks."""
    return run_in_parts(spark, views.ad_clicks(spark, sf_dir), start, **options)


def screened_tables(spark: SparkSession, sf_dir: str, threshold: int, start: Start | None = None) -> str:
    """Screen the test clicks and run ``start`` on those that pass, part by part."""
    def both(clicks: DataFrame, base: str, checkpoint: str, trigger: dict) -> StreamingQuery:
        query = start_screening(clicks, base, f"{checkpoint}/screening", threshold, trigger=trigger)
        if start is None:
            return query
        query.awaitTermination()
        return start(kept_stream(spark, base), base, f"{checkpoint}/next", trigger=trigger)

    return run_in_parts(spark, views.ad_clicks(spark, sf_dir), both)


# ---- a partitioned log, written in two halves ----------------------------------------------

def log_halves(spark: SparkSession, clicks: DataFrame, between: Callable[[str], None] = lambda path: None) -> str:
    """The clicks as a log with four partitions by user, a half after the other; ``between`` is called after each."""
    path = f"{shared_dir(spark, 'log')}/clicks"
    for part in time_parts(clicks, 2):
        append_log(click_records(part), path, F.get(F.split("value", " "), 3).cast("long") % 4)
        between(path)
    return path


def _stat_of_log(spark: SparkSession, log: str, root: str, start: str | dict[int, int] = "earliest") -> StreamingQuery:
    query = streams.start_stat(parse_clicks(log_stream(spark, log, start)), f"{root}/tables", f"{root}/checkpoint", trigger=streams.UNTIL_NOW)
    query.awaitTermination()
    return query


def log_resumed(spark: SparkSession, clicks: DataFrame) -> tuple[str, list[tuple[int, int, int, int]]]:
    """Count a log after its first half, and again on the same checkpoint: the tables and the ranges of the batches."""
    root, ranges = shared_dir(spark, "stream"), []
    log_halves(spark, clicks, lambda log: ranges.extend(offset_ranges(_stat_of_log(spark, log, root))))
    return f"{root}/tables", ranges


def log_clamped(spark: SparkSession, clicks: DataFrame) -> str:
    """Count a log from saved offsets of which the oldest segments, the first half, are no longer kept."""
    root, log = shared_dir(spark, "stream"), log_halves(spark, clicks)
    for own in segments(log).values():
        remove_segment(log, own[0][2])
    _stat_of_log(spark, log, root, {p: 5 for p in range(4)})
    return f"{root}/tables"
