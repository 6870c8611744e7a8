import json
import re

from footfall.sources import clicks as source
from footfall.sources import tables
from footfall.schemas import CITY_INFO

LINES = ["1704067199999 1 2 3 4", "abc 1 2", "", "1704067200000 x 2 3 4", "1704067200000 1 2 3 4 more"]


def test_records(spark, rows):
    lines = spark.createDataFrame([(x,) for x in LINES], "value string")
    good = source.parse_clicks(lines)
    assert [(f.name, f.dataType.simpleString()) for f in good.schema] == [
        ("ts", "timestamp"), ("province", "int"), ("city", "int"), ("userid", "bigint"), ("adid", "bigint")]
    assert [r[1:] for r in rows(good)] == [(1, 2, 3, 4), (1, 2, 3, 4)]
    assert {r.value for r in source.rejected_lines(lines).collect()} == {"abc 1 2", "", LINES[3]}
    named = source.parse_clicks(lines, text_places=True)
    assert {r.province for r in named.collect()} == {"1", "x"}
    assert {r.value for r in source.rejected_lines(lines, text_places=True).collect()} == {"abc 1 2", ""}
    back = {r.value for r in source.click_records(good).collect()}
    assert back == {LINES[0], "1704067200000 1 2 3 4"}


def test_times_out_of_range_are_rejected(spark):
    bad = ["9223372036854775807 1 2 3 4", "-9223372036854775808 1 2 3 4", "253402300800000 1 2 3 4"]
    lines = spark.createDataFrame([(v,) for v in [*bad, "253402300799999 1 2 3 4"]], "value string")
    assert {r.value for r in source.rejected_lines(lines).collect()} == set(bad)
    assert source.parse_clicks(lines).count() == 1


def test_kafka_options():
    assert json.loads(source.starting_offsets("ads", {1: 20, 0: 7})) == {"ads": {"0": 7, "1": 20}}
    new = source.kafka_options("h1:9092,h2:9092", "ads")
    assert new["startingOffsets"] == "latest" and new["failOnDataLoss"] == "false" and new["subscribe"] == "ads"
    resumed = source.kafka_options("h:9092", "ads", {0: 7}, 1000)
    assert json.loads(resumed["startingOffsets"]) == {"ads": {"0": 7}} and resumed["maxOffsetsPerTrigger"] == "1000"


def test_date_range_keeps_both_ends(actions):
    df = actions([("s", d * 86400, {}) for d in range(4)])   # 10th to 13th
    assert [r.date for r in tables.date_range(df, "2024-01-11", "2024-01-12").orderBy("date").collect()] == [
        "2024-01-11", "2024-01-12"]
    assert tables.date_range(df).count() == 4 and tables.date_range(df, end="2024-01-10").count() == 1


def test_scan_of_a_table_prunes_days_and_columns_and_pushes_the_filter(spark, actions, tmp_path):
    df = actions([("s", d * 86400, {"click_product_id": "5" if d else ""}) for d in range(3)])
    df.write.partitionBy("date").parquet(str(tmp_path / "days"))
    df.write.parquet(str(tmp_path / "flat"))

    def plan(name):
        table = tables.read_table(spark, "", str(tmp_path / name))
        clicks = tables.product_click_columns(tables.visit_actions(table, "2024-01-11", "2024-01-12"))
        assert clicks.count() == 2
        return clicks._jdf.queryExecution().executedPlan().toString()

    days, flat = plan("days"), plan("flat")
    assert "PushedFilters: [IsNotNull(click_product_id), Not(EqualTo(click_product_id,))]" in days
    assert "ReadSchema: struct<click_product_id:string,city_id:int>" in days.replace(
        "struct<city_id:int,click_product_id:string>", "struct<click_product_id:string,city_id:int>")
    assert re.search(r"PartitionFilters: \[isnotnull\(date#\d+\), \(date#\d+ >= 2024-01-11\)", days)
    assert "GreaterThanOrEqual(date,2024-01-11)" in flat and "action_time" not in flat


def test_literal_table(spark):
    table = tables.literal_table(spark, [(0, "x", "y")], CITY_INFO)
    assert tables.cities(table).first().area == "y"
