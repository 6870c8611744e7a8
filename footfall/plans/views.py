"""The library's input tables, derived from the star schema and event table of the test data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.sources import tables as source

# Columns of the test tables, so that reading one does not start with a look into its files.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str, start: str | None, end: str | None) -> DataFrame:
    """Events of the days ``start`` to ``end``, as a range of the stored time column."""
    events = read(spark, sf_dir, "events")
    if start:
        events = events.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        events = events.where(F.col("ts") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    return events


def visit_actions(spark: SparkSession, sf_dir: str, start: str | None = None,
                  end: str | None = None) -> DataFrame:
    """Visit actions: one session per user and day, ``event_id`` as tie-break."""
    events = _events(spark, sf_dir, start, end).selectExpr(
        "*", "CAST(get_json_object(props, '$.k') AS INT) AS k", "date_format(ts, 'yyyy-MM-dd') AS date")
    category, product = "CAST(k % 20 AS STRING)", "CAST(event_id % 50 AS STRING)"
    actions = events.selectExpr(
        "date", "user_id", "concat(CAST(user_id AS STRING), '-', date) AS session_id",
        "CAST(k % 10 AS STRING) AS page_id", "date_trunc('second', ts) AS action_time", "event_id",
        "CASE WHEN event_type = 'view' THEN concat('kw', CAST(k % 10 AS STRING)) ELSE '' END AS search_keyword",
        *[f"CASE WHEN event_type = '{kind}' THEN {value} ELSE '' END AS {name}" for kind, value, name in (
            ("click", category, "click_category_id"), ("click", product, "click_product_id"),
            ("signup", category, "order_category_ids"), ("signup", product, "order_product_ids"),
            ("purchase", category, "pay_category_ids"), ("purchase", product, "pay_product_ids"))],
        "CAST(user_id % 25 AS INT) AS city_id")
    return source.visit_actions(actions, extra=("event_id",))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.users(read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id", "c_name AS username", "c_name AS name",
        "CAST(18 + c_custkey % 50 AS INT) AS age", "c_mktsegment AS professional",
        "CAST(c_nationkey AS STRING) AS city",
        "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source.products(read(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id", "p_name AS product_name", "CAST(p_size % 2 AS STRING) AS extend_info"))


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return source.cities(nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey AS city_id", "n_name AS city_name", "r_name AS area"))


def ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").selectExpr("*", "CAST(user_id % 25 AS INT) AS city")
    return events.join(read(spark, sf_dir, "nation"), F.expr("n_nationkey = city")).selectExpr(
        "CAST(ts AS TIMESTAMP) AS ts", "n_regionkey AS province", "city", "user_id AS userid",
        "CAST(get_json_object(props, '$.k') AS BIGINT) % 5 AS adid")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as scored rows: name = order, class = priority, score = price in cents."""
    return read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS name", "o_orderpriority AS class", "CAST(round(o_totalprice * 100) AS BIGINT) AS score")
