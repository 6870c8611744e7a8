"""The most clicked products of each area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import present
from footfall.operators.sessions import with_task


def product_clicks(actions: DataFrame) -> DataFrame:
    """City and product of every product click."""
    return (actions.where(present(F.col("click_product_id")))
            .select("city_id", F.col("click_product_id").try_cast("long").alias("product_id")))


def city_product_clicks(actions: DataFrame) -> DataFrame:
    """Clicks of each product in each city."""
    return (product_clicks(actions).groupBy("city_id", "product_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def joined_city_counts(c: Column) -> Column:
    """The distinct ``city:count`` texts of a group, each behind a bar, in sorted order."""
    return F.concat(F.lit("|"), F.array_join(F.array_sort(F.collect_set(c)), "|"))


def area_product_counts(actions: DataFrame, products: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks of each known product in each area, with the list of its cities' counts.

    Clicks are counted per city and product before the joins, so what is joined no longer grows
    with the click volume.  The list of a group is bounded by the cities of its area.
    """
    counted = (city_product_clicks(actions)
               .join(products.select("product_id", "product_name", "extend_info"), "product_id")
               .join(cities, "city_id"))
    city_count = F.concat(F.col("city_name"), F.lit(":"), F.col("click_count").cast("string"))
    return counted.groupBy("area", "product_id").agg(
        F.sum("click_count").alias("click_count"), joined_city_counts(city_count).alias("city_counts"))


def area_top_products(actions: DataFrame, products: DataFrame, cities: DataFrame, n: int = 3,
                      task_id: str | None = None) -> DataFrame:
    """The products ranked 1 to ``n`` in each area; ties share a rank, so there may be more."""
    w = Window.partitionBy("area").orderBy(F.desc("click_count"))
    top = (area_product_counts(actions, products, cities)
           .withColumn("_rank", F.rank().over(w)).where(F.col("_rank") <= n)
           .select("area", "product_id", "click_count", "city_counts"))
    return with_task(top, task_id)
