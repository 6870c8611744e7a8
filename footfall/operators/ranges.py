"""Cut a table into ranges of one order over its groups, so that no group is a task of its own.

The order is by group and then by any columns, for rankings by falling score, then name.  Bounds between ranges are read off a sample of the rows, and a
row finds its range by comparing itself with them; a range ends inside a group where that group is large, also in the
middle of equal scores.  Window functions then run within the rows of a group in a range, and for groups that
a bound cuts, what the ranges before add up to is carried over.  At most two cut groups are in a range, which bounds
everything that is carried and broadcast here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.runtime import stored

RANGES = 128
# Sampled rows a range, and how many of one task at least and at most (the most that Spark limits per task).
PER_RANGE, LEAST, MOST = 64, 4, 1000


def falling(df: DataFrame, score: str) -> list[Column]:
    """Columns that rise as the score falls; NaN before all numbers, null last."""
    kind, c = df.schema[score].dataType, F.col(score)
    if isinstance(kind, T.IntegralType):
        return [c.isNull(), F.bitwise_not(c)]
    return [c.isNull(), ~F.isnan(c), -c] if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else [c.isNull(), -c]


def spot(keys: list[str], order: list[Column]) -> Column:
    """A row's place in the order, as a value that compares like it."""
    group = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]) if keys else F.struct(F.lit(0).alias("k0"))
    return F.struct(group.alias("g"), *[c.alias(f"s{i}") for i, c in enumerate(order)])


def bounds(df: DataFrame, keys: list[str], order: list[Column], ranges: int = RANGES) -> Column:
    """The first places of all ranges but the first, in order, as an array; from one reading of the rows.

    Every task gives the rows with its smallest hashes, of which fewer are used the more tasks there are.  How small
    these hashes are tells how many rows the task has, which is what a row of the sample stands for.
    """
    rows = df.select(spot(keys, order).alias("_spot")).withColumn("_task", F.spark_partition_id())
    rows = rows.withColumn("_hash", F.xxhash64("_spot").bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53)))
    by_task = Window.partitionBy("_task").orderBy("_hash")
    few = stored(rows.withColumn("_nth", F.row_number().over(by_task)).where(F.col("_nth") <= MOST), "sample")
    tasks = max(1, few.where(F.col("_nth") == 1).count())
    most = min(MOST, max(LEAST, -(-3 * ranges * PER_RANGE // tasks)))
    task, sample = Window.partitionBy("_task"), few.where(F.col("_nth") <= most)
    sample = sample.withColumn("_weight", F.when(F.max("_nth").over(task) < most, 1.0).otherwise(
        1 / F.greatest(F.max("_hash").over(task), F.lit(1e-15))))
    # The sample is bounded by the ranges and the number of tasks, so it is put in order as a whole.
    in_order = Window.orderBy("_spot")
    so_far = F.sum("_weight").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = sample.withColumns({"_sum": so_far, "_all": F.sum("_weight").over(Window.partitionBy())})
    placed = placed.withColumn("_part", F.floor((F.col("_sum") - F.col("_weight") / 2) * ranges / F.col("_all")))
    firsts = placed.withColumn("_before", F.lag("_part", 1, 0).over(in_order)).where(F.col("_part") > F.col("_before"))
    return stored(firsts.select("_spot"), "bounds").agg(F.sort_array(F.collect_set("_spot"))).scalar()


def in_ranges(df: DataFrame, keys: list[str], score: str, name: str, ranges: int = RANGES) -> DataFrame:
    """:func:`cut` by falling score, then name."""
    return cut(df, keys, [*falling(df, score), F.col(name)], ranges)


def cut(df: DataFrame, keys: list[str], order: list[Column], ranges: int = RANGES) -> DataFrame:
    """``df`` with ``_range``, rising with ``order`` in each group, and ``_cut`` where a bound may go through the row's group.

    Rows of one group that are equal in ``order`` are in one range.
    """
    out = df.withColumns({"_bounds": bounds(df, keys, order, ranges), "_spot": spot(keys, order), "_range": F.lit(0)})
    # Binary search, a step per column: _range ends as the number of bounds that are not above the row.
    step = 1 << (max(1, ranges).bit_length() - 1)
    while step:
        at = F.get("_bounds", F.col("_range") + (step - 1))
        out = out.withColumn("_range", F.col("_range") + F.when(at <= F.col("_spot"), step).otherwise(0))
        step //= 2
    group = F.col("_spot.g")
    through = F.get("_bounds", F.col("_range"))["g"].eqNullSafe(group) | F.get("_bounds", F.col("_range") - 1)["g"].eqNullSafe(group)
    return out.withColumn("_cut", through).drop("_spot", "_bounds")


def within(df: DataFrame, keys: list[str], score: str, name: str, columns: dict[str, Column], ranges: int = RANGES) -> DataFrame:
    """``df`` in ranges with window ``columns`` over the rows of a group in a range, written out."""
    return stored(in_ranges(df.select(*dict.fromkeys([*keys, name, score])), keys, score, name, ranges).withColumns(columns), "ranges")


def part(keys: list[str]):
    return Window.partitionBy(*keys, "_range")


def ordered(keys: list[str], score: str, name: str | None = None):
    """By falling score, and by ``name`` if given."""
    return part(keys).orderBy(F.desc_nulls_last(score), *([F.asc_nulls_first(name)] if name else []))


def carried(local: DataFrame, keys: list[str], score: str, name: str, offset: int = 1) -> DataFrame:
    """For each cut group and range what lies before and after, from rows with ``_row``, ``_rank``, ``_dense`` and ``_n``.

    ``_tie`` says that the scores go on from the range before, and ``_start`` is the rank they have there.  ``_before``
    and ``_after`` are the up to ``offset`` scores next to the range.
    """
    near = F.struct("_row", F.col(score).alias("_score"))
    totals = local.where("_cut").groupBy(*keys, "_range").agg(
        F.count(F.lit(1)).alias("_rows"), F.max("_dense").alias("_scores"), F.max("_rank").alias("_last_rank"),
        F.sum(score).alias("_sum_of"), F.max(score).alias("_high"), F.min(score).alias("_low"),
        F.min_by(name, "_row").alias("_top"), F.min_by(score, "_row").alias("_first"), F.max_by(score, "_row").alias("_last"),
        F.sort_array(F.collect_list(F.when(F.col("_row") <= offset, near))).alias("_heads"),
        F.sort_array(F.collect_list(F.when(F.col("_row") > F.col("_n") - offset, near))).alias("_tails"))
    order = Window.partitionBy(*keys).orderBy("_range")
    ahead = order.rowsBetween(Window.unboundedPreceding, -1)
    tie = F.lag(F.lit(True), 1, False).over(order) & F.lag("_last").over(order).eqNullSafe(F.col("_first"))
    rows = totals.withColumns({"_n_before": F.coalesce(F.sum("_rows").over(ahead), F.lit(0)), "_tie": tie})
    rows = rows.withColumn("_run", F.min(F.col("_n_before") + F.col("_last_rank")).over(Window.partitionBy(*keys, "_last")))
    new = F.col("_scores") - F.col("_tie").cast("int")
    before = F.flatten(F.collect_list("_tails").over(order.rowsBetween(-offset, -1)))
    after = F.flatten(F.collect_list("_heads").over(order.rowsBetween(1, offset)))
    return rows.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col("_range").alias("_at"), "_n_before", "_tie",
        F.lag("_run").over(order).alias("_start"),
        (F.coalesce(F.sum(new).over(ahead), F.lit(0)) - F.col("_tie").cast("int")).alias("_scores_before"),
        F.sum("_sum_of").over(ahead).alias("_sum_before"), F.max("_high").over(ahead).alias("_high_before"),
        F.min("_low").over(ahead).alias("_low_before"), F.first("_top").over(ahead).alias("_top_before"),
        F.lag(F.lit(True), 1, False).over(order).alias("_goes_on"),
        F.transform(F.slice(before, F.greatest(F.size(before) - offset + 1, F.lit(1)), offset), lambda s: s["_score"]).alias("_before"),
        F.transform(F.slice(after, 1, offset), lambda s: s["_score"]).alias("_after"))


def with_carried(local: DataFrame, keys: list[str], score: str, name: str, offset: int = 1) -> DataFrame:
    """``local`` with the columns of :func:`carried`, null where no range of the group lies before."""
    carry = carried(local, keys, score, name, offset)
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    on = F.col("_range") == F.col("_at")
    for c in same:
        on = on & c
    return local.join(F.broadcast(carry), on, "left")
