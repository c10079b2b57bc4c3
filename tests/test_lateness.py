from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import reference_model as model
from wavecount.operators import lateness
from wavecount.operators.lateness import FIRST_COUNT, FIRST_RANKING, arrival_order, lost_after
from wavecount.plans.hot_pages import Replay, replay_requests
from wavecount.sources.access_log import parse_access_log

SCHEMA = "key string, ts bigint, arrival bigint, id bigint"


def order():
    return arrival_order(F.col("arrival"), F.col("id"))


def replay(spark, rows, **settings):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return Replay(table, table, "key", order(), F.col("ts"), **settings)


def as_counts(frame):
    rows = frame.collect()
    assert len(rows) == len({r[:2] for r in rows})
    return {(r.key, r.window_end): r.cnt for r in rows}


def stream(seed, n, span, jitter, bursts=False):
    """Random out-of-order rows; bursts give many rows one arrival and ids out of time order."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        ts = rng.randrange(span)
        arrival = ts + rng.choice([0, 0, rng.randrange(jitter), rng.randrange(3 * jitter)])
        rows.append((rng.choice("abc"), ts, arrival // 500 * 500 if bursts else arrival, i))
    return rows


CASES = [
    # size, slide, delay, lateness, rows
    (600_000, 5_000, 1_000, 60_000, stream(1, 250, 3_000_000, 400_000)),
    (600_000, 5_000, 1_000, 60_000, stream(2, 250, 900_000, 1_500_000, bursts=True)),
    (3_600, 300, 1, 0, stream(3, 300, 20_000, 3_000)),
    (1_000, 1_000, 0, 500, stream(4, 300, 20_000, 2_000)),
    (1_000, 300, 100, 250, stream(5, 300, 20_000, 2_000, bursts=True)),
    (300, 1_000, 10, 50, stream(6, 200, 20_000, 900)),
    # far apart groups: gaps much longer than a window, and one time far ahead
    (600, 50, 100, 70, stream(7, 80, 3_000, 900)
     + [(k, ts + 10_000_000, a + 10_000_000, i + 1_000) for k, ts, a, i in stream(8, 80, 3_000, 900)]
     + [("a", 4_000_000_000_000, 10_001_000, 5_000)]),
    (600, 50, 100, 70, [("a", 40, 0, 0)]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_replay_matches_the_model(spark, case):
    size, slide, delay, allowed, rows = CASES[case]
    run = replay(spark, rows, size=size, slide=slide, delay=delay, lateness=allowed)
    assert as_counts(run.counts_on_time()) == dict(model.replay(rows, size, slide, delay, FIRST_COUNT))
    final = model.replay(rows, size, slide, delay, lost_after(allowed))
    assert as_counts(run.counts_final()) == dict(final)
    assert {r.id for r in run.late().collect()} == model.late(rows, size, slide, delay, allowed)
    first = model.ranked(model.replay(rows, size, slide, delay, FIRST_RANKING), 2)
    assert {tuple(r) for r in run.top_n_on_time(2).collect()} == first
    assert {tuple(r) for r in run.top_n_final(2).collect()} == model.ranked(final, 2)


def test_replay_without_broadcast(spark):
    """One plan at every size: Spark alone decides how to join, with the same result."""
    size, slide, delay, allowed, rows = CASES[0]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        run = replay(spark, rows, size=size, slide=slide, delay=delay, lateness=allowed)
        counts = run.counts_on_time()
        plan = counts._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert as_counts(counts) == dict(model.replay(rows, size, slide, delay, FIRST_COUNT))
        assert {r.id for r in run.late().collect()} == model.late(rows, size, slide, delay, allowed)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_replay_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(lateness, "_CHUNK_WINDOWS", 3)
    for case in (4, 6):
        size, slide, delay, allowed, rows = CASES[case]
        run = replay(spark, rows, size=size, slide=slide, delay=delay, lateness=allowed)
        assert as_counts(run.counts_on_time()) == dict(model.replay(rows, size, slide, delay, FIRST_COUNT))
        assert {r.id for r in run.late().collect()} == model.late(rows, size, slide, delay, allowed)


BOUNDARIES = [
    # watermark minus window end -> counted first, ranked first, counted in the end, late
    (-2, (True, True, True, False)),
    (-1, (False, True, True, False)),
    (0, (False, True, True, False)),
    (1, (False, False, True, False)),
    (-1 + 59_999, (False, False, True, False)),
    (-1 + 60_000, (False, False, False, True)),
]


def test_boundaries_to_the_millisecond(spark):
    """One row per case just below the end of its window, each after a row that sets the watermark."""
    rows, expected = [], {}
    for n, (offset, outcome) in enumerate(BOUNDARIES):
        end = 1_000_000 * (n + 1)
        rows += [("mover", end + offset + 1_000, 2 * n, 2 * n), (f"row{n}", end - 1, 2 * n + 1, 2 * n + 1)]
        expected[f"row{n}"] = outcome
    run = replay(spark, rows, size=10_000, slide=10_000, delay=1_000, lateness=60_000)
    outputs = [{r.key for r in frame.collect()} for frame in (
        run.counts_on_time(), run.top_n_on_time(), run.counts_final(), run.late())]
    assert {key: tuple(key in output for output in outputs) for key in expected} == expected


def test_row_lost_for_its_first_window_only_is_not_late(spark):
    rows = [("mover", 130_000, 1, 1), ("row", 59_999, 2, 2)]
    run = replay(spark, rows, size=20_000, slide=10_000, delay=1_000, lateness=60_000)
    assert [k for k in as_counts(run.counts_final()) if k[0] == "row"] == [("row", 70_000)]
    assert run.late().count() == 0


def test_whole_second_log_separates_first_count_from_first_ranking(spark):
    text = "h u - 17/05/2015:10:{} +0000 {} {}"
    lines = [(text.format("00:01", "GET", "/a"), 1), (text.format("00:06", "POST", "/x"), 2),
             (text.format("00:02", "GET", "/b"), 3)]
    parsed = parse_access_log(spark.createDataFrame(lines, "value string, n bigint"), carry=("n",))
    run = replay_requests(parsed, arrival_order(F.col("n"), F.col("n")))
    end = 1431856805000  # 10:00:05, the watermark after the second line
    assert {r.url for r in run.counts_on_time().filter(F.col("window_end") == end).collect()} == {"/a"}
    assert {r.url for r in run.top_n_on_time().filter(F.col("window_end") == end).collect()} == {"/a", "/b"}


def test_dropped_requests_move_the_watermark(spark):
    text = "h u - 17/05/2015:{} +0000 {} /a"
    lines = [(text.format("12:00:00", "POST"), 1), (text.format("10:00:00", "GET"), 2)]
    parsed = parse_access_log(spark.createDataFrame(lines, "value string, n bigint"), carry=("n",))
    run = replay_requests(parsed, arrival_order(F.col("n"), F.col("n")))
    assert [r.n for r in run.late().collect()] == [2]
    assert run.counts_final().count() == 0


def test_arrival_order_keeps_every_bit(spark):
    big = 2**63 - 1
    pairs = [(0, 0), (0, big), (1, 0), (1_700_000_000_000, big), (1_700_000_000_001, 0)]
    table = spark.createDataFrame(pairs, "arrival bigint, id bigint")
    assert [tuple(r)[:2] for r in table.orderBy(order()).collect()] == pairs
    assert table.select(order().alias("o")).distinct().count() == len(pairs)
