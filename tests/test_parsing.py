from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wavecount.sources.access_log import ROLLING, parse_access_log
from wavecount.sources.behavior import parse_behavior, render_behavior


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_behavior_fields(spark):
    row = parse_behavior(lines(spark, "1001,501,7,pv,1511658000,ignored")).first()
    assert row[:5] == (1001, 501, 7, "pv", 1511658000)
    millis = parse_behavior(lines(spark, "1,2,3,pv,1511658000")).selectExpr("unix_millis(ts)").first()[0]
    assert millis == 1511658000000


def test_behavior_round_trip(spark):
    text = ["1,2,3,pv,4", "5,6,7,buy,8"]
    again = render_behavior(parse_behavior(lines(spark, *text)))
    assert sorted(r[0] for r in again.collect()) == text


@pytest.mark.parametrize("bad", ["1,2,3,pv", "x,2,3,pv,4", "1,2,3,pv,", "1,2,99999999999,pv,4", "", "1,2.5,3,pv,4"])
def test_malformed_behavior(spark, bad):
    good = "1,2,3,pv,4"
    assert parse_behavior(lines(spark, good, bad), "permissive").count() == 1
    with pytest.raises(Exception, match="malformed line"):
        parse_behavior(lines(spark, good, bad)).collect()


def test_malformed_field_that_no_query_reads_still_fails(spark):
    with pytest.raises(Exception, match="malformed line"):
        parse_behavior(lines(spark, "1,2,x,pv,4")).select("item_id").collect()


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        parse_behavior(lines(spark, ""), "lenient")


def test_access_log_fields(spark):
    text = "10.0.0.1 alice - 17/05/2015:10:05:03 +0200 get /a/page.html HTTP/1.1"
    row = parse_access_log(lines(spark, text)).first()
    assert (row.ip, row.user_id, row.method, row.url) == ("10.0.0.1", "alice", "get", "/a/page.html")
    assert row.ts == dt.datetime(2015, 5, 17, 10, 5, 3)


def test_access_log_zone_is_a_parameter(spark):
    text = lines(spark, "h u - 17/05/2015:10:05:03 +0000 GET /")
    utc = parse_access_log(text).selectExpr("unix_millis(ts)").first()[0]
    shanghai = parse_access_log(text, zone="Asia/Shanghai").selectExpr("unix_millis(ts)").first()[0]
    assert utc - shanghai == 8 * 3600 * 1000


def test_access_log_does_not_depend_on_the_session_zone(spark):
    text = lines(spark, "h u - 17/05/2015:10:05:03 +0000 GET /")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert parse_access_log(text).selectExpr("unix_millis(ts)").first()[0] == 1431857103000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("bad", [
    "h u -",
    "h u - 31/02/2015:10:05:03 +0000 GET /",
    "h u - 17/05/2015 +0000 GET /",
    "h u - 17/05/2015:10:05:03 +0000 GET ",
])
def test_malformed_log(spark, bad):
    good = "h u - 17/05/2015:10:05:03 +0000 GET /"
    assert parse_access_log(lines(spark, good, bad), "permissive").count() == 1
    with pytest.raises(Exception, match="malformed line"):
        parse_access_log(lines(spark, good, bad)).collect()


def test_times_out_of_range_are_malformed(spark):
    far = ["1,2,3,pv,99999999999999", "1,2,3,pv,-99999999999999"]
    rows = parse_behavior(lines(spark, "1,2,3,pv,4", *far), "permissive")
    assert [r.ts_sec for r in rows.select("ts_sec", F.unix_millis("ts")).collect()] == [4]
    with pytest.raises(Exception, match="malformed line"):
        parse_behavior(lines(spark, far[0])).collect()


def _rolled(year, month, day, hour, minute, second):
    """Months first, then everything else as one length of time."""
    first = dt.datetime(year + (month - 1) // 12, (month - 1) % 12 + 1, 1)
    return first + dt.timedelta(days=day - 1, hours=hour, minutes=minute, seconds=second)


def test_rolling_dates_over_every_month_end(spark):
    cases = [(y, m, d, h, 59, 61) for y in (1900, 2000, 2015, 2016) for m in range(-1, 15) for d in (-1, 0, 1, 28, 29, 30, 31, 32, 62)
             for h in (-1, 0, 23, 24)]
    text = ["h u%d - %d/%d/%d:%d:%d:%d +0000 GET /" % (k, d, m, y, h, mi, s) for k, (y, m, d, h, mi, s) in enumerate(cases)]
    got = {r.user_id: r.ts for r in parse_access_log(lines(spark, *text), dates=ROLLING).collect()}
    assert got == {f"u{k}": _rolled(*case) for k, case in enumerate(cases)}


def test_rolling_and_strict_agree_on_possible_dates(spark):
    text = lines(spark, "h u - 29/02/2016:10:05:03 +0000 GET /", "h u - 1/3/2015:0:0:0 +0000 GET /", "h u - 31/12/1969:23:59:59 +0000 GET /")
    for zone in ("UTC", "Asia/Shanghai", "America/New_York"):
        assert sorted(parse_access_log(text, zone=zone, dates=ROLLING).collect()) == sorted(parse_access_log(text, zone=zone).collect())


@pytest.mark.parametrize("bad", ["17/05/2015", "x/05/2015:1:1:1", "1/1/99999:1:1:1", "1/1/0:0:0:0", "999999999/1/9999:0:0:0", "32/12/9999:0:0:0", ""])
def test_no_rolling_date(spark, bad):
    text = lines(spark, f"h u - {bad} +0000 GET /", "h u - 30/02/2015:10:05:03 +0000 GET /")
    assert [r.ts for r in parse_access_log(text, "permissive", dates=ROLLING).collect()] == [dt.datetime(2015, 3, 2, 10, 5, 3)]
    with pytest.raises(Exception, match="malformed line"):
        parse_access_log(text, dates=ROLLING).collect()


def test_unknown_kind_of_dates(spark):
    with pytest.raises(ValueError):
        parse_access_log(lines(spark, ""), dates="loose")
