"""Number helpers as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column, scale: int) -> Column:
    """Half-up rounding on the decimal text of a double (Spark's ``round`` does just that)."""
    return F.round(c.cast("double"), scale)


def ratio(n: str, d: str, scale: int = 2) -> Column:
    """Column ``n`` over column ``d``, rounded half up; NULL where ``d`` is 0."""
    return F.expr(f"CASE WHEN {d} <> 0 THEN round(CAST({n} AS DOUBLE) / {d}, {scale}) END")


def bucket_count(column: str, low: int, high: int | None, name: str) -> Column:
    """How many values of ``column`` lie in ``low..high`` (both included; no ``high`` = open end)."""
    test = f">= {low}" if high is None else f"BETWEEN {low} AND {high}"
    return F.expr(f"count_if({column} {test}) AS {name}")
