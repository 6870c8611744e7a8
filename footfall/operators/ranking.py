"""Ranks and running aggregates within groups, by falling score.

Filters such as "the first of each group" are plain window filters: Spark then keeps only the
first rows of a group per map task.  Functions that number *every* row of a group instead work on
the ranges of :mod:`footfall.operators.ranges`: local results plus what the ranges before add up to.  They
read the input twice, for the sample and for the pass, and write the local results out once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.operators.ranges import RANGES, ordered, part, with_carried, within
from footfall.runtime import stored


def _numbers(keys: list[str], score: str, name: str) -> dict[str, Column]:
    by_row, by_score = ordered(keys, score, name), ordered(keys, score)
    return {"_row": F.row_number().over(by_row), "_rank": F.rank().over(by_score), "_dense": F.dense_rank().over(by_score),
            "_n": F.count(F.lit(1)).over(part(keys))}


def _rank() -> Column:
    """The rank in the group: that of the ranges before where the same score goes on from there."""
    goes_on = F.coalesce("_tie", F.lit(False)) & (F.col("_rank") == 1)
    return F.when(goes_on, F.col("_start")).otherwise(F.col("_rank") + F.coalesce("_n_before", F.lit(0)))


def _neighbours(score: str, offset: int, default: int) -> tuple[Column, Column]:
    """The scores ``offset`` rows before and after, taken from the next ranges at the ends of this one."""
    first, last = F.col("_row") <= offset, F.col("_row") > F.col("_n") - offset
    kept = F.coalesce(F.size("_before"), F.lit(0))
    to_left = kept - offset + F.col("_row") - 1             # from 0
    to_right = F.col("_row") + offset - F.col("_n") - 1
    there = F.coalesce(F.size("_after"), F.lit(0))
    lag = F.when(~first, F.col("_lag")).when(to_left >= 0, F.get("_before", to_left.cast("int"))).otherwise(F.lit(default))
    lead = F.when(~last, F.col("_lead")).when(to_right < there, F.get("_after", to_right.cast("int"))).otherwise(F.lit(default))
    return lag, lead


def window_suite(df: DataFrame, keys: list[str], score: str, name: str, ranges: int = RANGES, default: int = 0) -> DataFrame:
    """Every row with the common window functions over its group, best score first.

    ``rank``, ``dense_rank``, ``row_number``, running ``count``/``sum``/``min``/``max``/``avg``,
    ``first_value`` and ``last_value`` of ``name``, and the score of the row before and after
    (``default`` at the ends).  Rows of equal score are ordered by ``name``, which must be unique in
    a group.
    """
    by_row = ordered(keys, score, name)
    running = by_row.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = with_carried(within(df, keys, score, name, {
        **_numbers(keys, score, name), "_sum": F.sum(score).over(running), "_min": F.min(score).over(running),
        "_max": F.max(score).over(running), "_first": F.first(name).over(running),
        "_lag": F.lag(score).over(by_row), "_lead": F.lead(score).over(by_row)}, ranges), keys, score, name)
    count = F.col("_row") + F.coalesce("_n_before", F.lit(0))
    total = F.when(F.col("_sum").isNull() | F.col("_sum_before").isNull(), F.coalesce("_sum", "_sum_before")).otherwise(
        F.col("_sum") + F.col("_sum_before"))
    lag, lead = _neighbours(score, 1, default)
    return rows.select(
        *keys, name, score,
        _rank().cast("long").alias("rank"),
        (F.col("_dense") + F.coalesce("_scores_before", F.lit(0))).cast("long").alias("dense_rank"),
        count.cast("long").alias("row_number"),
        count.cast("long").alias("running_count"),
        total.alias("running_sum"),
        F.least("_min", "_low_before").alias("running_min"),
        F.greatest("_max", "_high_before").alias("running_max"),
        (total.cast("double") / count).alias("running_avg"),
        F.when(F.coalesce("_goes_on", F.lit(False)), F.col("_top_before")).otherwise(F.col("_first")).alias("first_value"),
        F.col(name).alias("last_value"),
        lag.alias("lag_score"), lead.alias("lead_score"))


def _numbered(df: DataFrame, keys: list[str], score: str, name: str, ranges: int) -> DataFrame:
    return with_carried(within(df, keys, score, name, _numbers(keys, score, name), ranges), keys, score, name)


def rank_per_group(df: DataFrame, keys: list[str], score: str, name: str, ranges: int = RANGES) -> DataFrame:
    """Every row with its rank in the group (ties share a rank, gaps follow)."""
    return _numbered(df, keys, score, name, ranges).select(name, *keys, score, _rank().alias("rank"))


def row_number_per_group(df: DataFrame, keys: list[str], score: str, name: str, ranges: int = RANGES) -> DataFrame:
    """Every row with its number in the group, ties in order of ``name``."""
    number = F.col("_row") + F.coalesce("_n_before", F.lit(0))
    return _numbered(df, keys, score, name, ranges).select(name, *keys, score, number.alias("rank"))


def lag_lead_per_group(df: DataFrame, keys: list[str], score: str, name: str, offset: int = 1,
                       default: int = 0, ranges: int = RANGES) -> DataFrame:
    """Every row with the scores ``offset`` rows before and after it in its group.

    A range hands the ``offset`` scores at its ends to the ranges next to it.
    """
    by_row = ordered(keys, score, name)
    rows = with_carried(within(df, keys, score, name, {
        **_numbers(keys, score, name), "_lag": F.lag(score, offset).over(by_row), "_lead": F.lead(score, offset).over(by_row)},
        ranges), keys, score, name, offset)
    lag, lead = _neighbours(score, offset, default)
    return rows.select(name, *keys, score, lag.alias("lag_score"), lead.alias("lead_score"))


def top_per_group(df: DataFrame, keys: list[str], score: str, name: str, n: int = 1) -> DataFrame:
    """The rows ranked 1 to ``n`` in their group, ties included."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score))
    return (df.select(name, *keys, score).withColumn("rank", F.rank().over(w))
            .where(F.col("rank") <= n))


def max_per_group(df: DataFrame, keys: list[str], score: str) -> DataFrame:
    """The best score of each group."""
    return df.groupBy(*keys).agg(F.max(score).alias("max_score"))


def max_join_back(df: DataFrame, keys: list[str], score: str, name: str) -> DataFrame:
    """The rows that reach the best score of their own group."""
    return df.select(name, *keys, score).join(_best(df, keys, score), [*keys, score]).select(
        name, *keys, F.col(score).alias("max_score"))


def max_join_back_loose(df: DataFrame, keys: list[str], score: str, name: str) -> DataFrame:
    """The rows that reach the best score of *any* group, with the group that score is best in."""
    return df.select(name, score).join(_best(df, keys, score), score).select(
        name, *keys, F.col(score).alias("max_score"))


def _best(df: DataFrame, keys: list[str], score: str) -> DataFrame:
    """The best score of each group, written out so that the join knows its true size.

    With few groups the rows are matched as they are scanned; with many Spark shuffles both sides.
    """
    return stored(max_per_group(df, keys, score).withColumnRenamed("max_score", score), "best")


def group_totals(df: DataFrame, keys: list[str], score: str, name: str) -> DataFrame:
    """Every row with aggregates over its whole group and the number of all rows.

    Aggregated first and joined back, so no group is gathered in one task.  The totals are written
    out, so that the join knows their true size.
    """
    totals = stored(df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("group_count"), F.sum(score).alias("group_sum"),
        F.min(score).alias("group_min"), F.max(score).alias("group_max")), "totals")
    everything = totals.agg(F.sum("group_count")).scalar()
    return (df.select(name, *keys, score).join(totals, keys)
            .withColumn("group_avg", F.col("group_sum").cast("double") / F.col("group_count"))
            .withColumn("all_count", everything))
