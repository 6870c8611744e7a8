"""Time helpers as Column functions; nothing here leaves the JVM.

``action_time``-like arguments may be timestamps or text in ``TIME_FORMAT``: use
:func:`parse_time` on text first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of the data model.
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_KEY_FORMAT = "yyyyMMdd"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"
DATE_MINUTE_FORMAT = "yyyy-MM-dd HH:mm"


def pad_two(c: Column) -> Column:
    """``"7"`` to ``"07"``; anything that is not one character stays (lpad would cut it)."""
    return F.when(F.length(c) == 1, F.concat(F.lit("0"), c)).otherwise(c)


def parse_time(c: Column) -> Column:
    return F.to_timestamp(c, TIME_FORMAT)


def parse_date_key(c: Column) -> Column:
    return F.to_date(c, DATE_KEY_FORMAT)


def before(a: Column, b: Column) -> Column:
    """Whether time text ``a`` is strictly before ``b``."""
    return parse_time(a) < parse_time(b)


def after(a: Column, b: Column) -> Column:
    return before(b, a)


def seconds_between(end: Column, start: Column) -> Column:
    """Whole seconds from ``start`` to ``end``, as a long."""
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def minus_seconds(end: Column, start: Column) -> Column:
    """:func:`seconds_between` as an int."""
    return seconds_between(end, start).cast("int")


def format_date(c: Column) -> Column:
    return F.date_format(c, DATE_FORMAT)


def format_time(c: Column) -> Column:
    return F.date_format(c, TIME_FORMAT)


def format_date_key(c: Column) -> Column:
    return F.date_format(c, DATE_KEY_FORMAT)


def format_minute_key(c: Column) -> Column:
    return F.date_format(c, MINUTE_KEY_FORMAT)


def date_hour(c: Column) -> Column:
    """``yyyy-MM-dd_HH`` of a timestamp."""
    return F.date_format(c, DATE_HOUR_FORMAT)


def date_hour_of_text(c: Column) -> Column:
    """``yyyy-MM-dd_HH`` of time text, without parsing it."""
    return F.concat(F.split_part(c, F.lit(" "), F.lit(1)), F.lit("_"),
                    F.split_part(F.split_part(c, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1)))


def today() -> Column:
    return format_date(F.current_date())


def yesterday() -> Column:
    return format_date(F.date_sub(F.current_date(), 1))


def millis_to_time(c: Column) -> Column:
    return F.timestamp_millis(c)


def day_of_millis(c: Column) -> Column:
    return format_date(millis_to_time(c))


def minute_of_millis(c: Column) -> Column:
    return F.date_format(millis_to_time(c), DATE_MINUTE_FORMAT)


def hour_text(c: Column) -> Column:
    return F.date_format(c, "HH")


def minute_text(c: Column) -> Column:
    return F.date_format(c, "mm")
