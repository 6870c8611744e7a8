"""Page-to-page conversion along a target flow.

Consecutive pages of a session need the session's actions in time order.  To keep a session of
any length out of a single task the actions are cut into ranges of that order (:mod:`footfall.operators.ranges`): the order is
built within the rows of a session in a range first, then across the ranges, of which only the first and last page
remain.  The actions are read twice, for the sample and for the pass, also if one session has most of them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import as_list, flow_pairs, ratio
from footfall.operators.ranges import RANGES, cut
from footfall.operators.sessions import with_task
from footfall.runtime import stored


def _in_ranges(actions: DataFrame, tiebreak: Iterable[str], ranges: int) -> DataFrame:
    """Each action with the page after it in its range, and whether it is the first or last of its session in the range.

    Without a ``tiebreak`` the actions of one instant stay in one range.
    """
    w = Window.partitionBy("session_id", "_range").orderBy("action_time", *tiebreak)
    rows = actions.select("session_id", "page_id", "action_time", *tiebreak)
    return (cut(rows, ["session_id"], [F.col("action_time"), *map(F.col, tiebreak)], ranges)
            .select("session_id", "_range", "_cut", "page_id",
                    F.lead("page_id").over(w).alias("_next"),
                    (F.row_number().over(w) == 1).alias("_first"),
                    F.lead(F.lit(1)).over(w).isNull().alias("_last")))


def _edges() -> list[Column]:
    return [F.max(F.when(F.col("_first"), F.col("page_id"))).alias("_first_page"),
            F.max(F.when(F.col("_last"), F.col("page_id"))).alias("_last_page")]


def _next_range_page() -> Column:
    return F.lead("_first_page").over(Window.partitionBy("session_id").orderBy("_range"))


def session_page_pairs(actions: DataFrame, tiebreak: Iterable[str] = (), ranges: int = RANGES) -> DataFrame:
    """``(session_id, from_page, to_page)`` for every two consecutive actions of a session."""
    rows = stored(_in_ranges(actions, tuple(tiebreak), ranges), "pages")
    inside = rows.where(~F.col("_last")).select(
        "session_id", F.col("page_id").alias("from_page"), F.col("_next").alias("to_page"))
    across = rows.where("_cut").groupBy("session_id", "_range").agg(*_edges()).select(
        "session_id", F.col("_last_page").alias("from_page"), _next_range_page().alias("to_page"),
        F.lead("_range").over(Window.partitionBy("session_id").orderBy("_range")).alias("_more"))
    return inside.unionByName(across.where(F.col("_more").isNotNull()).drop("_more"))


def start_page_views(actions: DataFrame, flow: str | Iterable[object]) -> DataFrame:
    """How many actions are on the first page of the flow."""
    return actions.agg(F.count_if(F.col("page_id") == as_list(flow)[0]).alias("start_pv"))


def _flow_totals(actions: DataFrame, flow: str | Iterable[object], tiebreak: Iterable[str],
                 ranges: int) -> DataFrame:
    """One row: views of the start page, and the count of each step's pair (``n1``, ``n2``, ...).

    The counts of a session in a range ride along with its first and last page, so the second shuffle carries one
    row of these each.
    """
    pairs = flow_pairs(flow)
    rows = _in_ranges(actions, tuple(tiebreak), ranges)
    parts = rows.groupBy("session_id", "_range").agg(
        F.count_if(F.col("page_id") == pairs[0][1]).alias("start_pv"),
        *[F.count_if((F.col("page_id") == a) & (F.col("_next") == b)).alias(f"n{i}") for i, a, b in pairs],
        *_edges())
    joined = parts.withColumn("_next", _next_range_page())
    return joined.agg(
        F.expr("coalesce(sum(start_pv), 0) AS start_pv"),
        *[(F.expr(f"coalesce(sum(n{i}), 0)")
           + F.count_if((F.col("_last_page") == a) & (F.col("_next") == b))).alias(f"n{i}")
          for i, a, b in pairs])


def page_pair_counts(actions: DataFrame, flow: str | Iterable[object], tiebreak: Iterable[str] = (),
                     ranges: int = RANGES) -> DataFrame:
    """How often each consecutive pair of the flow occurs, with its step; 0 for a missing pair."""
    totals = _flow_totals(actions, flow, tiebreak, ranges)
    steps = [F.struct(F.lit(i).alias("step"), F.lit(f"{a}_{b}").alias("page_pair"),
                      F.col(f"n{i}").alias("pair_count"),
                      F.col("start_pv" if i == 1 else f"n{i - 1}").alias("previous_count"))
             for i, a, b in flow_pairs(flow)]
    return totals.select(F.inline(F.array(*steps)))


def page_convert_rate(actions: DataFrame, flow: str | Iterable[object], tiebreak: Iterable[str] = (),
                      ranges: int = RANGES, task_id: str | None = None) -> DataFrame:
    """The rate of each step: its pair count over the count of the step before.

    The first step is measured against the views of the start page.  A step after an empty one
    has no rate (NULL).
    """
    counts = page_pair_counts(actions, flow, tiebreak, ranges)
    return with_task(counts.select("step", "page_pair",
                                   ratio("pair_count", "previous_count").alias("rate")), task_id)
