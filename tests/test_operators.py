from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import reference_model as model
from wavecount.functions.eventtime import display_time, utc_millis
from wavecount.operators.changelog import changelog
from wavecount.operators.filters import keep_behavior, keep_page_requests
from wavecount.operators.ranking import item_report, page_report, top_n
from wavecount.operators.windows import sliding_counts, tumbling_counts


def test_filter_behavior_is_case_sensitive_and_drops_null(spark):
    rows = spark.createDataFrame([("pv",), ("PV",), ("buy",), (None,)], "behavior string")
    assert [r[0] for r in keep_behavior(rows).collect()] == ["pv"]


@pytest.mark.parametrize("method,url,kept", [
    ("GET", "/a/page.html", True),
    ("get", "/x.css?v=1", True),
    ("Get", "/x.PNG", True),
    ("GET", "/a/b.png", False),
    ("GET", "/favicon.ico", False),
    ("GET", "/a.js/b", True),
    ("GET", "/js", True),
    ("POST", "/a/page.html", False),
])
def test_filter_page_requests(spark, method, url, kept):
    rows = spark.createDataFrame([(method, url)], "method string, url string")
    assert (keep_page_requests(rows).count() == 1) is kept


@pytest.mark.parametrize("size,slide", [(3600, 300), (600, 5), (10, 10), (10, 4), (7, 3), (3, 10), (1, 1)])
def test_sliding_counts_match_the_model(spark, size, slide):
    rng = random.Random(size * 31 + slide)
    rows = [(rng.choice("abc"), rng.randrange(-2 * size, 30 * size)) for _ in range(150)]
    rows += [("hot", 5 * size + 1)] * 40 + [("edge", k * slide) for k in range(-3, 4)]
    table = spark.createDataFrame(rows, "key string, ts bigint")
    result = sliding_counts(table, ["key"], F.col("ts"), size, slide).collect()
    assert len(result) == len({r[:2] for r in result})
    assert {(r.key, r.window_end): r.cnt for r in result} == dict(model.counts(rows, size, slide))


def test_row_on_a_window_edge_belongs_to_the_window_that_starts_there(spark):
    table = spark.createDataFrame([("a", 20)], "key string, ts bigint")
    assert [r.window_end for r in sliding_counts(table, ["key"], F.col("ts"), 10, 10).collect()] == [30]
    assert [r.window_end for r in tumbling_counts(table, ["key"], F.col("ts"), 10).collect()] == [30]


def test_tumbling_counts_without_key(spark):
    table = spark.createDataFrame([(0,), (9,), (10,), (-1,)], "ts bigint")
    result = tumbling_counts(table, [], F.col("ts"), 10).collect()
    assert {tuple(r) for r in result} == {(10, 2), (20, 1), (0, 1)}


def test_ties_go_to_the_smaller_key_and_short_windows_keep_all(spark):
    counts = spark.createDataFrame(
        [(3, 100, 7), (1, 100, 7), (2, 100, 9), (4, 100, 1), (9, 200, 1)], "item_id int, window_end int, cnt int")
    result = top_n(counts, "item_id", 3).collect()
    assert {tuple(r) for r in result} == {(2, 100, 9, 1), (1, 100, 7, 2), (3, 100, 7, 3), (9, 200, 1, 1)}


@pytest.mark.parametrize("ms,zone,text", [
    (1511658300000, "UTC", "2017-11-26 01:05:00.0"),
    (1511658300000, "Asia/Shanghai", "2017-11-26 09:05:00.0"),
    (120, "UTC", "1970-01-01 00:00:00.12"),
    (-1, "UTC", "1969-12-31 23:59:59.999"),
])
def test_display_time(spark, ms, zone, text):
    assert spark.range(1).select(display_time(F.lit(ms).cast("bigint"), zone)).first()[0] == text


def test_utc_millis_floors_and_ignores_the_session_zone(spark):
    query = "select timestamp_ntz'2024-03-10 02:30:00.123999' a, timestamp_ntz'1969-12-31 23:59:59.9999' b"
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = spark.sql(query).select(utc_millis(F.col("a")), utc_millis(F.col("b"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (1710037800123, -1)


def test_item_report_text(spark):
    ranked = spark.createDataFrame(
        [(11, 1511658300000, 4, 2), (10, 1511658300000, 5, 1)], "item_id bigint, window_end bigint, cnt bigint, row_num int")
    bar = "=" * 36
    assert item_report(ranked).first().report == (
        f"{bar}\n窗口结束时间：2017-11-26 01:05:00.0\nNO 1: 商品id = 10 热门度 = 5\n"
        f"NO 2: 商品id = 11 热门度 = 4\n{bar}\n\n")


def test_page_report_text(spark):
    ranked = spark.createDataFrame(
        [("/a", 1511658300000, 5, 1)], "url string, window_end bigint, cnt bigint, row_num int")
    bar = "=" * 36
    assert page_report(ranked).first().report == (
        f"{bar}\n窗口结束时间：2017-11-26 01:05:00.0\nNO 1: 热门度 = 5 被访问url = /a\n{bar}\n")


def test_report_lines_beyond_nine_stay_in_rank_order(spark):
    ranked = spark.createDataFrame(
        [(k, 0, 50 - k, k) for k in range(1, 13)], "item_id bigint, window_end bigint, cnt bigint, row_num int")
    text = item_report(ranked).first().report
    assert [int(line[3:].split(":")[0]) for line in text.split("\n") if line.startswith("NO ")] == list(range(1, 13))


def test_changelog(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, name string")
    new = spark.createDataFrame([(2, "b"), (3, None), (1, "c")], "id int, name string")
    assert {tuple(r) for r in changelog(old, new).collect()} == {(False, 1, "a"), (True, 1, "c")}
    assert changelog(new, new).count() == 0
