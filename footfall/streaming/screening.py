"""Screen a click stream against the dynamic blacklist, with the counts in Spark's state store.

A user's clicks pass up to and including the one that makes ``threshold`` clicks on one ad in one
day; after it the user is on the blacklist and nothing passes any more.  The cost of a batch
depends on the batch and its days: the counts of a user are a map in the state with an entry per period of four weeks, of which a
batch reads and writes the entries it has clicks for, however many periods there were before.

The screened clicks go to a folder through Spark's file sink, which takes every batch exactly
once, and are the source of the counting queries of :mod:`footfall.streaming.ads`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from footfall import schemas
from footfall.operators import ads
from footfall.streaming.ads import EVERY_5_SECONDS
from footfall.streaming.users import KEPT_CLICK, screened

KEPT = "ad_click_kept"


def screened_clicks(clicks: DataFrame, threshold: int = ads.BLACKLIST_THRESHOLD,
                    keep_days: int | None = None) -> DataFrame:
    """The clicks of a stream that pass, with the mark ``listed``.

    The counts of a user's days older than ``keep_days`` before the newest one are forgotten;
    without it they are kept for good.
    """
    return screened(clicks, threshold, keep_days)


def start_screening(clicks: DataFrame, base: str, checkpoint: str, threshold: int = ads.BLACKLIST_THRESHOLD,
                    keep_days: int | None = None, trigger: dict | None = None,
                    name: str | None = None) -> StreamingQuery:
    """Write the clicks that pass to the folder of kept clicks."""
    writer = (screened_clicks(clicks, threshold, keep_days).writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", f"{base}/{KEPT}")
              .trigger(**(trigger or EVERY_5_SECONDS)))
    return (writer.queryName(name) if name else writer).start()


def kept_stream(spark: SparkSession, base: str, schema: T.StructType = KEPT_CLICK) -> DataFrame:
    """The kept clicks as a stream, for further queries."""
    return spark.readStream.schema(schema).parquet(f"{base}/{KEPT}").select(*schemas.AD_CLICK.names)


def read_kept(spark: SparkSession, base: str, schema: T.StructType = KEPT_CLICK) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{base}/{KEPT}")


def read_listed(spark: SparkSession, base: str) -> DataFrame:
    """The blacklist: each user on it once."""
    mark = T.StructType([KEPT_CLICK["userid"], KEPT_CLICK["listed"]])
    return read_kept(spark, base, mark).where("listed").select("userid")
