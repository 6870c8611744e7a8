"""Every query by name, over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import numbers, present, times
from footfall.operators import ads, categories, funnel, ranking, regions, sampling, sessions
from footfall.plans import replay, views
from footfall.schemas import CITY_INFO
from footfall.sources import tables as source
from footfall.sources.clicks import click_records, parse_clicks
from footfall.streaming import ads as streams
from footfall.streaming import screening

Query = Callable[[SparkSession, str], DataFrame]

# The range of the range queries; all others read their tables whole.
START, END = "2024-01-05", "2024-01-25"
FLOW = "1,2,3,4,5,6,7"
SAMPLE, LARGE_SAMPLE = 100, 3000
THRESHOLD = 3
FILTER = sessions.SessionFilter(
    start_age=20, end_age=60, professionals="HOUSEHOLD,MACHINERY,BUILDING", sex="male,female",
    cities=[str(i) for i in range(20)], keywords="kw1,kw2,kw3,kw4", category_ids="1,2,3,4,5,6,7,8")
USER_FILTER = sessions.SessionFilter(start_age=20, end_age=50, sex="male")
CLASS, SCORE, NAME = ["class"], "score", "name"
TIE = ("event_id",)


def _actions_date_range(spark, d):
    rows = views.visit_actions(spark, d, START, END)
    return rows.withColumn("action_time", times.format_time(F.col("action_time")))


def _actions_clicks_pruned(spark, d):
    return source.product_click_columns(views.visit_actions(spark, d, START, END), START, END)


def _rollup(spark, d):
    rows = sessions.session_rollup(views.visit_actions(spark, d), with_sets=True)
    return (rows.withColumn("start_time", times.format_time(F.col("start_time")))
            .withColumn("end_time", times.format_time(F.col("end_time"))))


def _kept(spark, d, flt=sessions.NO_FILTER):
    return sessions.kept_sessions(views.visit_actions(spark, d), views.users(spark, d), flt)


def _sessions_filtered(spark, d):
    return _kept(spark, d, FILTER).select("session_id", "user_id", "visit_length", "step_length")


def _session_user_join(spark, d):
    rows = sessions.join_users(sessions.session_rollup(views.visit_actions(spark, d)), views.users(spark, d),
                               USER_FILTER)
    return rows.select("session_id", "user_id", "step_length", "visit_length", "age", "professional", "city", "sex")


def _kept_actions(spark, d, flt=sessions.NO_FILTER):
    return sessions.kept_actions(views.visit_actions(spark, d), views.users(spark, d), flt)


def _of_users(step):
    return lambda spark, d: step(views.visit_actions(spark, d), views.users(spark, d))


def _packed_ids(actions: DataFrame) -> DataFrame:
    """Orders and payments that name a second category, ``c<page>``, in the same field."""
    for name in ("order_category_ids", "pay_category_ids"):
        c = F.col(name)
        actions = actions.withColumn(name, F.when(present(c), F.concat(c, F.lit(",c"), "page_id")).otherwise(c))
    return actions


def _session_aggr_stat(spark, d):
    return sessions.session_aggr_stat(views.visit_actions(spark, d), views.users(spark, d))


def _per_hour(spark, d):
    return sampling.sessions_per_hour(_kept(spark, d))


def _random_extract(size, extra):
    return lambda spark, d: sampling.session_random_extract(
        views.visit_actions(spark, d), views.users(spark, d), size, extra)


def _session_detail(spark, d):
    return sampling.session_detail(views.visit_actions(spark, d), views.users(spark, d), SAMPLE)


def _page_pairs_all(spark, d):
    pairs = funnel.session_page_pairs(views.visit_actions(spark, d), TIE)
    return pairs.groupBy("from_page", "to_page").agg(F.count(F.lit(1)).alias("pair_count"))


def _area(step, with_dims=True):
    def run(spark, d):
        dims = (views.products(spark, d), views.cities(spark, d)) if with_dims else ()
        return step(views.visit_actions(spark, d), *dims)
    return run


def _score_query(step, **options):
    def run(spark, d):
        out = step(views.scores(spark, d), CLASS, SCORE, NAME, **options)
        return out.withColumn("rank", F.col("rank").cast("long")) if "rank" in out.columns else out
    return run


def _clicks_query(step):
    return lambda spark, d: step(views.ad_clicks(spark, d))


def _filtered(spark, d):
    return ads.filtered_clicks(views.ad_clicks(spark, d), THRESHOLD)


def _filtered_query(step):
    return lambda spark, d: step(_filtered(spark, d))


def _click_rows(clicks):
    return clicks.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("clicked_at"),
                         "province", "city", "userid", "adid")


def _parsed_clicks(spark, d):
    parsed = parse_clicks(click_records(views.ad_clicks(spark, d)))
    return parsed.withColumn("ts", F.unix_millis("ts"))


def _time_functions(spark, d):
    ts = F.col("ts").cast("timestamp")
    text = times.format_time(ts)
    later = times.format_time(ts + F.expr("INTERVAL 90 SECONDS"))
    millis = F.unix_millis(ts)
    return views.read(spark, d, "events").select(
        "event_id", times.format_date(ts).alias("day"), text.alias("time_text"),
        times.format_date_key(ts).alias("date_key"), times.format_minute_key(ts).alias("minute_key"),
        times.date_hour(ts).alias("date_hour"), times.date_hour_of_text(text).alias("date_hour_of_text"),
        times.day_of_millis(millis).alias("day_of_millis"),
        times.minute_of_millis(millis).alias("minute_of_millis"),
        times.before(text, later).alias("is_before"), times.after(text, later).alias("is_after"),
        times.seconds_between(times.parse_time(later), times.parse_time(text)).alias("seconds"),
        times.minus_seconds(times.parse_time(text), times.parse_time(later)).cast("long").alias("minus"),
        times.format_date(times.parse_date_key(times.format_date_key(ts))).alias("key_parsed"),
        times.hour_text(ts).alias("hour_text"), times.minute_text(ts).alias("minute_text"),
        times.pad_two((F.col("event_id") % 120).cast("string")).alias("padded"))


def _round_half_up(spark, d):
    per_user = views.read(spark, d, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "click").alias("clicks"), F.count(F.lit(1)).alias("events"))
    return per_user.withColumn("click_share", numbers.ratio("clicks", "events"))


def _stream(table, start, **options):
    return lambda spark, d: table(spark, replay.stream_tables(spark, d, start, **options))


def _screened(table, start=None):
    return lambda spark, d: table(spark, replay.screened_tables(spark, d, THRESHOLD, start))


def _sink(step):
    return lambda spark, d: step(spark, views.ad_clicks(spark, d))


# A dimension given in the program instead of a table.
CITY_ROWS = [(i, f"city{i:02}", f"area{i % 7}") for i in range(25)]


def _area_literal(spark, d):
    cities = source.literal_table(spark, CITY_ROWS, CITY_INFO)
    return regions.area_top_products(views.visit_actions(spark, d), views.products(spark, d), cities, task_id="run-1")


QUERIES: dict[str, Query] = {
    # scans and filters
    "actions_date_range": _actions_date_range,
    "actions_clicks_pruned": _actions_clicks_pruned,
    "user_scan": views.users,
    "product_scan": views.products,
    "city_scan": views.cities,
    "sessions_filtered": _sessions_filtered,
    "kept_actions": lambda s, d: _kept_actions(s, d, FILTER).select("event_id", "session_id", "user_id"),
    # sessions
    "session_rollup": _rollup,
    "session_user_join": _session_user_join,
    "session_visit_buckets": lambda s, d: sessions.visit_buckets(_kept(s, d)),
    "session_step_buckets": lambda s, d: sessions.step_buckets(_kept(s, d)),
    "session_aggr_stat": _session_aggr_stat,
    "session_aggr_stat_task": lambda s, d: sessions.session_aggr_stat(
        views.visit_actions(s, d), views.users(s, d), task_id="run-1"),
    "sessions_per_hour": _per_hour,
    "hour_share_of_day": lambda s, d: sampling.hour_share_of_day(_per_hour(s, d)),
    "hour_quota": lambda s, d: sampling.hour_quota(_per_hour(s, d), SAMPLE),
    "session_random_extract": _random_extract(SAMPLE, 1),
    "session_random_extract_exact": _random_extract(LARGE_SAMPLE, 0),
    "session_detail": _session_detail,
    # categories
    "category_action_counts": _of_users(categories.kept_category_counts),
    "category_pivot": _of_users(lambda a, u: categories.pivot_counts(categories.kept_category_counts(a, u))),
    "top10_category": _of_users(categories.kept_top_categories),
    "top10_category_exploded": _of_users(
        lambda a, u: categories.kept_top_categories(_packed_ids(a), u, explode_ids=True)),
    "session_category_clicks": _of_users(categories.kept_session_category_clicks),
    "top10_session": _of_users(categories.kept_top_sessions),
    # page flow
    "start_page_pv": lambda s, d: funnel.start_page_views(views.visit_actions(s, d), FLOW),
    "session_page_pairs": _page_pairs_all,
    "page_pair_counts": lambda s, d: funnel.page_pair_counts(views.visit_actions(s, d), FLOW, TIE),
    "page_convert_rate": lambda s, d: funnel.page_convert_rate(views.visit_actions(s, d), FLOW, TIE),
    # areas
    "city_product_clicks": _area(regions.city_product_clicks, with_dims=False),
    "area_product_citycounts": _area(regions.area_product_counts),
    "area_top3_product": _area(regions.area_top_products),
    "area_top3_literal_cities": _area_literal,
    # ranking
    "rank_per_group": _score_query(ranking.rank_per_group),
    "row_number_per_group": _score_query(ranking.row_number_per_group),
    "lag_lead_per_group": _score_query(ranking.lag_lead_per_group, offset=3, default=-1),
    "top1_per_group": _score_query(ranking.top_per_group),
    "max_per_group": lambda s, d: ranking.max_per_group(views.scores(s, d), CLASS, SCORE),
    "max_join_back": _score_query(ranking.max_join_back),
    "max_join_back_loose": _score_query(ranking.max_join_back_loose),
    "window_agg_suite": _score_query(ranking.window_suite),
    "group_totals": _score_query(ranking.group_totals),
    # ad clicks, bounded
    "ad_click_records": _parsed_clicks,
    "ad_user_click_count": _filtered_query(ads.user_click_counts),
    "ad_blacklist": lambda s, d: ads.blacklist(views.ad_clicks(s, d), THRESHOLD),
    "ad_filtered_clicks": _filtered_query(_click_rows),
    "ad_stat": _filtered_query(ads.ad_stat),
    "ad_stat_unfiltered": _clicks_query(ads.ad_stat),
    "ad_province_counts": _filtered_query(lambda c: ads.province_counts(ads.ad_stat(c))),
    "ad_province_top3": _filtered_query(lambda c: ads.province_top_ads(ads.ad_stat(c))),
    "ad_province_top3_rownum": _filtered_query(lambda c: ads.province_top_ads_all_days(ads.ad_stat(c))),
    "ad_minute_clicks": _filtered_query(ads.minute_clicks),
    "ad_click_trend": _filtered_query(ads.click_trend),
    "ad_click_trend_unfiltered": _clicks_query(ads.click_trend),
    "ad_click_sliding": _filtered_query(ads.sliding_clicks),
    # ad clicks, streaming
    "stream_ad_stat": _stream(streams.read_latest_stat, streams.start_stat),
    "stream_ad_stat_watermark": _stream(streams.read_latest_stat, streams.start_stat, watermark="1 day"),
    "stream_compacted_stat": _stream(streams.read_latest_stat, streams.start_stat, parts=7, fold_every=2),
    "stream_log_stat": lambda s, d: streams.read_latest_stat(s, replay.log_resumed(s, views.ad_clicks(s, d))[0]),
    "stream_log_ranges": lambda s, d: s.createDataFrame(
        replay.log_resumed(s, views.ad_clicks(s, d))[1], "batch_id long, log_partition long, from_offset long, until_offset long"),
    "stream_log_clamped": lambda s, d: streams.read_latest_stat(s, replay.log_clamped(s, views.ad_clicks(s, d))),
    "stream_ad_minute_clicks": _stream(streams.read_trend, streams.start_minute_clicks),
    "stream_ad_late_minutes": _stream(streams.read_trend, streams.start_minute_clicks, newest_first=True),
    "stream_ad_sliding": _screened(streams.read_sliding, streams.start_sliding_clicks),
    "stream_ad_job_stat": _stream(streams.read_stat, streams.start_ad_job, threshold=THRESHOLD, exact=True),
    "stream_ad_job_user_click_count": _stream(streams.read_user_counts, streams.start_ad_job, threshold=THRESHOLD,
                                              exact=True),
    "stream_ad_job_province_top3": _stream(streams.read_province_top, streams.start_ad_job, threshold=THRESHOLD,
                                           exact=True),
    "stream_ad_job_trend_unfiltered": _stream(lambda s, base: streams.last_minutes(streams.read_trend(s, base)),
                                              streams.start_ad_job, threshold=THRESHOLD, trend_of_all=True),
    "stream_ad_job_stat_by_batch": _stream(streams.read_stat, streams.start_ad_job, threshold=THRESHOLD),
    "stream_ad_blacklist_by_batch": _stream(streams.read_blacklist, streams.start_blacklist, threshold=THRESHOLD),
    "stream_ad_blacklist": _screened(screening.read_listed),
    "stream_ad_filtered_clicks": _screened(
        lambda s, base: _click_rows(screening.read_kept(s, base))),
    "stream_ad_user_click_count": _screened(streams.read_latest_user_counts, streams.start_user_counts),
    "stream_ad_province_top3": _screened(streams.read_province_top, streams.start_province_top),
    # sinks
    "sink_append": _sink(replay.append_twice),
    "sink_upsert_add": _sink(replay.upsert_add_twice),
    "sink_upsert_set": _sink(replay.upsert_set_twice),
    "sink_replace_by_key": _sink(replay.replace_twice),
    "sink_insert_new": _sink(replay.insert_new_twice),
    "sink_replace_table": _sink(replay.table_twice),
    # scalar functions
    "time_functions": _time_functions,
    "round_half_up": _round_half_up,
}
