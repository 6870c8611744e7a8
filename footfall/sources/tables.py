"""Bounded sources: actions, users, products, cities and the result tables of the streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions import present
from footfall.schemas import CITY_INFO, PRODUCT_INFO, USER_INFO, VISIT_ACTION, conform


def read_table(spark: SparkSession, name: str, path: str | None = None, fmt: str = "parquet",
               **options: str) -> DataFrame:
    """The catalog table ``name``, or files under ``path``."""
    return spark.read.table(name) if path is None else spark.read.format(fmt).options(**options).load(path)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A database table; give partitionColumn, lowerBound, upperBound and numPartitions to split it."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def date_range(actions: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """The actions of the days ``start`` to ``end``, both included; a missing end is open.

    The bare column is compared, be it text or a date, so the test prunes a ``date`` partitioned
    table and is pushed into the files of any other.
    """
    if start:
        actions = actions.where(F.col("date") >= start)
    if end:
        actions = actions.where(F.col("date") <= end)
    return actions


def visit_actions(df: DataFrame, start: str | None = None, end: str | None = None,
                  extra: tuple[str, ...] = ()) -> DataFrame:
    """A table of visit actions within a range of days, which is cut on the stored column."""
    return conform(date_range(df, start, end), VISIT_ACTION, extra)


def product_click_columns(actions: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """City and product of the product clicks in a range of days: two columns of the table."""
    return (date_range(actions, start, end).where(present(F.col("click_product_id")))
            .select("city_id", "click_product_id"))


def users(df: DataFrame) -> DataFrame:
    return conform(df, USER_INFO)


def products(df: DataFrame) -> DataFrame:
    return conform(df, PRODUCT_INFO)


def cities(df: DataFrame) -> DataFrame:
    return conform(df, CITY_INFO)


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small table given in the program, such as a list of cities."""
    return spark.createDataFrame(list(rows), schema)
