"""Popular categories and the sessions most active in them.

The functions named ``kept_...`` take all actions and the users, and count actions before the counts meet the users,
so a join on ``user_id`` never carries raw actions.  The others work on actions that were chosen already.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import present, split_ids
from footfall.operators.sessions import NO_FILTER, SessionFilter, kept_actions, kept_user_ids, with_task
from footfall.runtime import stored

KINDS = ("click", "order", "pay")


def category_actions(actions: DataFrame, explode_ids: bool = False, also: Iterable[str] = ()) -> DataFrame:
    """``(category_id, action)`` of each action that concerns a category, with the columns ``also``.

    An action counts once: as a click, else as a payment, else as an order.  A payment or order
    may name several categories (``"1,2,3"``): by default such a list is one category value, with
    ``explode_ids`` each id counts.
    """
    click, pay, order = (F.col(c) for c in ("click_category_id", "pay_category_ids", "order_category_ids"))
    kind = F.when(present(click), "click").when(present(pay), "pay").when(present(order), "order")
    value = F.when(present(click), click).when(present(pay), pay).when(present(order), order)
    rows = actions.select(value.alias("category_id"), kind.alias("action"), *also).where(F.col("action").isNotNull())
    if explode_ids:
        rows = rows.select(F.explode(split_ids(F.col("category_id"))).alias("category_id"), "action", *also)
    return rows


def category_action_counts(actions: DataFrame, explode_ids: bool = False) -> DataFrame:
    """Rows per category and action."""
    return (category_actions(actions, explode_ids).groupBy("category_id", "action")
            .agg(F.count(F.lit(1)).alias("action_count")))


def kept_category_counts(actions: DataFrame, users: DataFrame, flt: SessionFilter = NO_FILTER,
                         explode_ids: bool = False, by_session: bool = False) -> DataFrame:
    """Rows per category and action (and session) over the sessions that pass ``flt``.

    Without behaviour filters the actions are counted per user first and only the counts meet the users.  A
    behaviour filter needs the sessions first (:func:`footfall.operators.sessions.kept_actions`).
    """
    keys = ["category_id", "action", *(["session_id"] if by_session else [])]
    if flt.on_actions():
        rows = category_actions(kept_actions(actions, users, flt), explode_ids, keys[2:])
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("action_count"))
    per_user = (category_actions(actions, explode_ids, ["user_id", *keys[2:]]).groupBy("user_id", *keys)
                .agg(F.count(F.lit(1)).alias("action_count")))
    return (per_user.join(kept_user_ids(users, flt), "user_id", "left_semi")
            .groupBy(*keys).agg(F.sum("action_count").alias("action_count")))


def category_pivot(actions: DataFrame, explode_ids: bool = False) -> DataFrame:
    """Click, order and pay counts of each category, in one aggregation."""
    return category_actions(actions, explode_ids).groupBy("category_id").agg(
        *[F.count_if(F.col("action") == kind).alias(f"{kind}_count") for kind in KINDS])


def pivot_counts(counts: DataFrame) -> DataFrame:
    """:func:`category_pivot` from counts per category and action."""
    return counts.groupBy("category_id").agg(*[
        F.sum(F.when(F.col("action") == kind, F.col("action_count")).otherwise(0)).alias(f"{kind}_count")
        for kind in KINDS])


def _first(pivot: DataFrame, n: int) -> DataFrame:
    return pivot.orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), "category_id").limit(n)


def top_categories(actions: DataFrame, n: int = 10, explode_ids: bool = False,
                   task_id: str | None = None) -> DataFrame:
    """The first ``n`` categories by clicks, then orders, then payments, then id."""
    return with_task(_first(category_pivot(actions, explode_ids), n), task_id)


def kept_top_categories(actions: DataFrame, users: DataFrame, flt: SessionFilter = NO_FILTER, n: int = 10,
                        explode_ids: bool = False, task_id: str | None = None) -> DataFrame:
    """:func:`top_categories` over the sessions that pass ``flt``."""
    return with_task(_first(pivot_counts(kept_category_counts(actions, users, flt, explode_ids)), n), task_id)


def session_category_clicks(actions: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """Clicks of each session in each category; ``categories`` (a top-n result) limits which."""
    clicks = (actions.where(present(F.col("click_category_id")))
              .select(F.col("click_category_id").alias("category_id"), "session_id"))
    if categories is not None:
        clicks = clicks.join(F.broadcast(categories.select("category_id")), "category_id", "left_semi")
    return clicks.groupBy("category_id", "session_id").agg(F.count(F.lit(1)).alias("click_count"))


def _session_clicks(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("action") == "click").select(
        "category_id", "session_id", F.col("action_count").alias("click_count"))


def kept_session_category_clicks(actions: DataFrame, users: DataFrame, flt: SessionFilter = NO_FILTER) -> DataFrame:
    """:func:`session_category_clicks` over the sessions that pass ``flt``."""
    return _session_clicks(kept_category_counts(actions, users, flt, by_session=True))


def _most_active(clicks: DataFrame, n_sessions: int) -> DataFrame:
    """The rank filter is a constant, so a map task forwards at most that many rows of a category."""
    w = Window.partitionBy("category_id").orderBy(F.desc("click_count"), "session_id")
    return (clicks.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= n_sessions)
            .select("category_id", "session_id", "click_count"))


def top_sessions(actions: DataFrame, n_sessions: int = 10, n_categories: int = 10,
                 task_id: str | None = None) -> DataFrame:
    """The ``n_sessions`` sessions with most clicks in each of the top categories.

    The top categories are ``n_categories`` rows by construction, which is what makes their
    broadcast safe.
    """
    clicks = session_category_clicks(actions, top_categories(actions, n_categories))
    return with_task(_most_active(clicks, n_sessions), task_id)


def kept_top_sessions(actions: DataFrame, users: DataFrame, flt: SessionFilter = NO_FILTER, n_sessions: int = 10,
                      n_categories: int = 10, task_id: str | None = None) -> DataFrame:
    """:func:`top_sessions` over the sessions that pass ``flt``.

    Categories and sessions come from one table of counts, so the actions are read once.  That table is written
    to the shared folder while this is called.
    """
    counts = stored(kept_category_counts(actions, users, flt, by_session=True), "category-counts")
    top = _first(pivot_counts(counts), n_categories).select("category_id")
    clicks = _session_clicks(counts).join(F.broadcast(top), "category_id", "left_semi")
    return with_task(_most_active(clicks, n_sessions), task_id)
