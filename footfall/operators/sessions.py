"""Session roll-up, session filters and the visit / step length distribution.

One shuffle on ``session_id`` with map-side partial aggregates carries everything: a session
that holds a large part of the table reaches its reducer as one small row per map task.  Word
and category sets are never collected to test a filter; a flag per session is enough.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import as_list, bucket_count, joined_set, ratio
from footfall.functions.times import seconds_between

# Label, first and last second of each visit length bucket.  A session of zero
# seconds is in none of them.
VISIT_BUCKETS = [
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
]
# Label, smallest and largest number of actions of each step length bucket.
STEP_BUCKETS = [
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
]

Values = str | Iterable[object] | None


@dataclass(frozen=True)
class SessionFilter:
    """Which sessions to keep; an empty field is no constraint.

    Ages are inclusive.  ``keywords`` and ``category_ids`` ask for a session that searched for,
    or clicked on, at least one of the values.  Lists may be given as ``"a,b"``.
    """

    start_age: int | None = None
    end_age: int | None = None
    professionals: Values = None
    cities: Values = None
    sex: Values = None
    keywords: Values = None
    category_ids: Values = None

    def on_users(self) -> list[Column]:
        tests = []
        if self.start_age not in (None, ""):
            tests.append(F.col("age") >= int(self.start_age))
        if self.end_age not in (None, ""):
            tests.append(F.col("age") <= int(self.end_age))
        for column, values in (("professional", self.professionals), ("city", self.cities), ("sex", self.sex)):
            if as_list(values):
                tests.append(F.col(column).isin(as_list(values)))
        return tests

    def on_actions(self) -> list[tuple[str, Column]]:
        """Named tests of which a session must pass each with at least one action."""
        tests = []
        for name, column, values in (("_keyword_hit", "search_keyword", self.keywords),
                                     ("_category_hit", "click_category_id", self.category_ids)):
            if as_list(values):
                tests.append((name, F.col(column).isin(as_list(values))))
        return tests


NO_FILTER = SessionFilter()


def _where_all(df: DataFrame, tests: list[Column]) -> DataFrame:
    for test in tests:
        df = df.where(test)
    return df


def session_rollup(actions: DataFrame, with_sets: bool = False, flt: SessionFilter = NO_FILTER) -> DataFrame:
    """One row per session: user, start and end time, visit seconds, number of actions.

    ``with_sets`` adds the joined search words and clicked categories: ask for them on few
    sessions only.  The behaviour half of ``flt`` is applied here.
    """
    hits = flt.on_actions()
    aggs = [
        F.min("user_id").alias("user_id"),
        F.min("action_time").alias("start_time"),
        F.max("action_time").alias("end_time"),
        F.count(F.lit(1)).alias("step_length"),
    ]
    if with_sets:
        aggs += [joined_set(F.col("search_keyword")).alias("search_keywords"),
                 joined_set(F.col("click_category_id")).alias("click_category_ids")]
    aggs += [F.bool_or(test).alias(name) for name, test in hits]
    rolled = _where_all(actions.groupBy("session_id").agg(*aggs), [F.col(name) for name, _ in hits])
    return (rolled.drop(*[name for name, _ in hits])
            .withColumn("visit_length", seconds_between(F.col("end_time"), F.col("start_time"))))


def join_users(sessions: DataFrame, users: DataFrame, flt: SessionFilter = NO_FILTER) -> DataFrame:
    """Sessions with the attributes of their user; sessions of unknown users drop out.

    The join is left to Spark: it broadcasts ``users`` only where their size allows, and
    otherwise splits a user with very many sessions at run time.
    """
    return sessions.join(_where_all(users, flt.on_users()), "user_id", "inner")


def kept_user_ids(users: DataFrame, flt: SessionFilter = NO_FILTER) -> DataFrame:
    """The users that pass the user half of ``flt``."""
    return _where_all(users, flt.on_users()).select("user_id")


def kept_sessions(actions: DataFrame, users: DataFrame, flt: SessionFilter = NO_FILTER) -> DataFrame:
    """The sessions that pass ``flt``, rolled up and without user attributes.

    A session is taken to belong to one user; of one with several users the smallest id decides.
    """
    return session_rollup(actions, flt=flt).join(kept_user_ids(users, flt), "user_id", "left_semi")


def kept_actions(actions: DataFrame, users: DataFrame, flt: SessionFilter = NO_FILTER) -> DataFrame:
    """The actions of the sessions that pass ``flt``.

    A session is taken to belong to one user, so a filter on users alone is a semi join on ``user_id``
    with no session shuffle at all; only behaviour filters need the sessions first.  Of a session with
    several users the actions of those that pass are kept.
    """
    kept = actions.join(kept_user_ids(users, flt), "user_id", "left_semi").select(*actions.columns)
    hits = flt.on_actions()
    if not hits:
        return kept
    wanted = (kept.groupBy("session_id").agg(*[F.bool_or(test).alias(name) for name, test in hits]))
    wanted = _where_all(wanted, [F.col(name) for name, _ in hits]).select("session_id")
    return kept.join(wanted, "session_id", "left_semi").select(*actions.columns)


def visit_buckets(sessions: DataFrame) -> DataFrame:
    """One row: session count, sessions of zero seconds, and the count of each visit bucket."""
    return sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        F.count_if(F.col("visit_length") == 0).alias("visit_0s_count"),
        *[bucket_count("visit_length", lo, hi, f"visit_{label}_count") for label, lo, hi in VISIT_BUCKETS])


def step_buckets(sessions: DataFrame) -> DataFrame:
    """One row: session count and the count of each step bucket."""
    return sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        *[bucket_count("step_length", lo, hi, f"step_{label}_count") for label, lo, hi in STEP_BUCKETS])


def session_aggr_stat(actions: DataFrame, users: DataFrame, flt: SessionFilter = NO_FILTER,
                      task_id: str | None = None) -> DataFrame:
    """One row: session count and the share of each visit and step bucket, two decimals.

    No session at all gives count 0 and NULL shares.
    """
    named = ([(f"visit_length_{label}_ratio", "visit_length", lo, hi) for label, lo, hi in VISIT_BUCKETS]
             + [(f"step_length_{label}_ratio", "step_length", lo, hi) for label, lo, hi in STEP_BUCKETS])
    counted = kept_sessions(actions, users, flt).agg(
        F.count(F.lit(1)).alias("session_count"),
        *[bucket_count(column, lo, hi, name) for name, column, lo, hi in named])
    shares = [ratio(name, "session_count").alias(name) for name, *_ in named]
    return with_task(counted.select("session_count", *shares), task_id)


def with_task(df: DataFrame, task_id: str | None) -> DataFrame:
    """Put the id of the run in front, when there is one."""
    return df if task_id is None else df.select(F.lit(task_id).alias("task_id"), "*")


def with_row_id(df: DataFrame) -> DataFrame:
    """Put a random id of its own in front of each row."""
    return df.select(F.expr("uuid()").alias("task_id"), "*")
