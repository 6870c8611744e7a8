from datetime import datetime

import pytest
from pyspark.sql import functions as F

from footfall import schemas
from footfall.functions import as_list, flow_pairs, joined_set, ratio, round_half_up, split_ids, times
from footfall.operators.regions import joined_city_counts


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_pad_two_leaves_longer_text(spark):
    assert one(spark, *[times.pad_two(F.lit(t)) for t in ("7", "12", "123", "")]) == ("07", "12", "123", "")


def test_time_compare_is_strict(spark):
    a, b = F.lit("2024-01-10 10:00:00"), F.lit("2024-01-10 10:00:01")
    assert one(spark, times.before(a, b), times.before(a, a), times.after(b, a), times.after(a, b)) == (
        True, False, True, False)


def test_seconds_and_minus(spark):
    a, b = (times.parse_time(F.lit(t)) for t in ("2024-01-10 10:00:00", "2024-01-11 10:00:30"))
    assert one(spark, times.seconds_between(b, a), times.minus_seconds(a, b)) == (86430, -86430)
    assert spark.range(1).select(times.minus_seconds(a, b).alias("m")).dtypes == [("m", "int")]


def test_formats(spark):
    at = F.lit(datetime(2017, 10, 31, 20, 27, 53))
    assert one(spark, times.format_date(at), times.format_time(at), times.format_date_key(at),
               times.format_minute_key(at), times.date_hour(at), times.hour_text(at), times.minute_text(at)) == (
        "2017-10-31", "2017-10-31 20:27:53", "20171031", "201710312027", "2017-10-31_20", "20", "27")
    assert one(spark, times.date_hour_of_text(F.lit("2017-10-31 20:27:53"))) == ("2017-10-31_20",)
    assert str(one(spark, times.parse_date_key(F.lit("20171031")))[0]) == "2017-10-31"
    assert one(spark, times.parse_time(F.lit("2017-10-31 20:27:53"))) == (datetime(2017, 10, 31, 20, 27, 53),)


def test_today_and_yesterday(spark):
    today, yesterday, gap = one(spark, times.today(), times.yesterday(),
                                F.datediff(F.to_date(times.today()), F.to_date(times.yesterday())))
    assert gap == 1 and len(today) == len(yesterday) == 10


def test_millis(spark):
    millis = F.lit(1704067199999)
    assert one(spark, times.day_of_millis(millis), times.minute_of_millis(millis)) == (
        "2023-12-31", "2023-12-31 23:59")


def test_rounding_is_half_up_on_the_decimal_text(spark):
    assert one(spark, round_half_up(F.lit(0.285), 2), round_half_up(F.lit(1.005), 2),
               round_half_up(F.lit(0.125), 2), round_half_up(F.lit(2.0), 2)) == (0.29, 1.01, 0.13, 2.0)
    assert one(spark, ratio("57", "200"), ratio("1", "0"), ratio("2", "3")) == (
        0.29, None, 0.67)


def test_ids_and_sets(spark):
    assert one(spark, split_ids(F.lit("1,2, 3,,45")), split_ids(F.lit("10"))) == (["1", "2", "3", "45"], ["10"])
    df = spark.createDataFrame([("b",), ("",), (None,), ("a",), ("b",)], "x string")
    assert df.agg(joined_set(F.col("x"))).first()[0] == "a|b"


def test_city_list_is_an_exact_sorted_set_behind_bars(spark):
    df = spark.createDataFrame([("x:12",), ("x:1",), ("x:1",)], "c string")
    assert df.agg(joined_city_counts(F.col("c"))).first()[0] == "|x:1|x:12"


def test_parameters():
    assert as_list(None) == as_list("") == [] and as_list("a, b") == ["a", "b"] and as_list([1, 2]) == ["1", "2"]
    assert flow_pairs("1,2,3") == [(1, "1", "2"), (2, "2", "3")]
    with pytest.raises(ValueError):
        flow_pairs("1")


def test_conform_parses_text_and_reports_missing_columns(spark):
    df = spark.createDataFrame([("7", "u", "n", "31", "job", "3", "male", "more")],
                               "user_id string, username string, name string, age string, professional string, "
                               "city string, sex string, other string")
    out = schemas.conform(df, schemas.USER_INFO)
    assert out.columns == schemas.USER_INFO.names and out.first().age == 31 and out.first().user_id == 7
    with pytest.raises(ValueError, match="age"):
        schemas.conform(df.drop("age"), schemas.USER_INFO)
    values = {f.name: "" for f in schemas.VISIT_ACTION} | {
        "date": "2018-11-08", "user_id": "0", "action_time": "2018-11-08 09:03:17", "city_id": "6"}
    text = spark.createDataFrame([tuple(values.values())], ", ".join(f"{c} string" for c in values))
    row = schemas.conform(text, schemas.VISIT_ACTION).first()
    assert row.action_time == datetime(2018, 11, 8, 9, 3, 17) and row.city_id == 6 and row.user_id == 0
