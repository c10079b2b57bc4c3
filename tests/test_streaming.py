from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import reference_model as model
from wavecount.plans.hot_items_sql import hot_items_sql
from wavecount.sources.access_log import parse_access_log
from wavecount.sources.behavior import parse_behavior
from wavecount.sources.lines import stream_lines
from wavecount.streaming import jobs
from wavecount.streaming.replay import replay_in_drops
from wavecount.streaming.sinks import BatchFolder, CommittedFolders, OpenSpans, Progress, console, labelled

HOUR = 3_600_000


def behavior_lines(spark, *drops):
    """(item, seconds) rows per drop, all of them views."""
    rows = [(f"1,{item},7,pv,{sec}", number) for number, drop in enumerate(drops) for item, sec in drop]
    return spark.createDataFrame(rows, "value string, drop int")


def log_line(ms, url, method="GET"):
    sec = ms // 1000
    return f"h u - 01/01/1970:{sec // 3600:02}:{sec // 60 % 60:02}:{sec % 60:02} +0000 {method} {url}"


def test_page_views_emit_each_closed_hour_once(spark, tmp_path):
    drops = [[(1, 10), (2, 3599)], [(1, 3600), (1, 7200)], [(3, 7300), (3, 99_999)]]
    replay_in_drops(
        behavior_lines(spark, *drops), "drop", str(tmp_path / "in"),
        lambda live: jobs.stream_page_views(
            parse_behavior(live), str(tmp_path / "out"), str(tmp_path / "state"), available_now=True))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {tuple(r) for r in rows} == {("pv", HOUR, 2), ("pv", 2 * HOUR, 1), ("pv", 3 * HOUR, 2)}
    assert len(rows) == 3


def test_hot_items_stream_equals_the_model(spark, tmp_path):
    drops = [[(1, 100), (2, 200), (2, 250)], [(1, 4000), (3, 5000)], [(9, 10_000_000)]]
    out = BatchFolder(str(tmp_path / "out"), jobs.RANKED_ITEMS)
    replay_in_drops(
        behavior_lines(spark, *drops), "drop", str(tmp_path / "in"),
        lambda live: jobs.stream_hot_items(
            parse_behavior(live), out, str(tmp_path / "state"), available_now=True, n=2))
    rows = [(item, sec * 1000) for drop in drops[:2] for item, sec in drop]
    expected = model.ranked(model.counts(rows, HOUR, 300_000), 2)
    result = [tuple(r) for r in out.read(spark).drop("batch_id").collect()]
    assert set(result) == expected and len(result) == len(expected)


def test_dropped_rows_move_the_watermark_of_a_stream(spark, tmp_path):
    lines = spark.createDataFrame([("1,5,7,pv,100", 0), ("1,6,7,buy,9999999", 1)], "value string, drop int")
    out = BatchFolder(str(tmp_path / "out"), jobs.RANKED_ITEMS)
    replay_in_drops(
        lines, "drop", str(tmp_path / "in"),
        lambda live: jobs.stream_hot_items(parse_behavior(live), out, str(tmp_path / "state"), available_now=True))
    assert {r.item_id for r in out.read(spark).collect()} == {5}
    assert out.read(spark).count() == 12


def test_changelog_of_each_batch_leads_to_its_ranking(spark, tmp_path):
    drops = [[(1, 1000), (2, 1100), (2, 1150)], [(1, 1200), (1, 1210), (1, 1220)], [(3, 1300)]]
    out = BatchFolder(str(tmp_path / "out"), jobs.ITEM_CHANGES)
    store, progress = OpenSpans(str(tmp_path / "spans"), "item_id", "bigint"), Progress(str(tmp_path / "progress"))
    replay_in_drops(
        behavior_lines(spark, *drops), "drop", str(tmp_path / "in"),
        lambda live: jobs.stream_hot_items_changelog(
            parse_behavior(live), store, progress, out, str(tmp_path / "state"), available_now=True, n=1))
    changes, batches = out.read(spark).collect(), set()
    ranking = set()
    for batch in sorted({c.batch_id for c in changes}):
        for change in sorted((c for c in changes if c.batch_id == batch), key=lambda c: c.insert):
            row = (change.item_id, change.window_end, change.cnt, change.row_num)
            (ranking.add if change.insert else ranking.remove)(row)
        batches.add(batch)
    rows = [(item, sec * 1000) for drop in drops for item, sec in drop]
    assert ranking == model.ranked(model.counts(rows, HOUR, 300_000), 1)
    assert any(not c.insert for c in changes)


def test_hot_pages_refine_a_closed_window(spark, tmp_path):
    """A row that comes within the allowed lateness changes a ranking that was already out."""
    drops = [[(1_000, "/a"), (2_000, "/b")], [(12_500, "/c")], [(3_000, "/b"), (30_000, "/c")], [(500_000, "/c")]]
    rows = [(log_line(ms, url), n) for n, drop in enumerate(drops) for ms, url in drop]
    rows += [(log_line(499_000, "/x.png"), 3), (log_line(499_000, "/p", "POST"), 3)]
    out = BatchFolder(str(tmp_path / "out"), jobs.RANKED_PAGES)
    store, progress = OpenSpans(str(tmp_path / "spans"), "url", "string"), Progress(str(tmp_path / "progress"))
    replay_in_drops(
        spark.createDataFrame(rows, "value string, drop int"), "drop", str(tmp_path / "in"),
        lambda live: jobs.stream_hot_pages(
            parse_access_log(live), store, progress, out, str(tmp_path / "state"), available_now=True,
            size=10_000, slide=10_000))
    first_window = out.read(spark).filter("window_end = 10000").collect()
    by_batch = {}
    for r in first_window:
        by_batch.setdefault(r.batch_id, set()).add((r.url, r.cnt, r.row_num))
    emissions = [by_batch[b] for b in sorted(by_batch)]
    assert emissions == [{("/a", 1, 1), ("/b", 1, 2)}, {("/b", 2, 1), ("/a", 1, 2)}]
    latest = {tuple(r) for r in jobs.latest_ranking(out, spark).select("url", "window_end", "cnt", "row_num").collect()}
    assert latest == {("/b", 10_000, 2, 1), ("/a", 10_000, 1, 2), ("/c", 20_000, 1, 1), ("/c", 40_000, 1, 1)}


def test_late_requests_against_earlier_batches(spark, tmp_path):
    drops = [
        [(1_000, "/a", "GET"), (700_000, "/b", "POST")],     # nothing is late in the first batch
        [(30_000, "/lost", "GET"), (39_000, "/lost", "GET"), (40_000, "/taken", "GET"),
         (30_000, "/x.png", "GET"), (30_000, "/posted", "POST")],
    ]
    rows = [(log_line(ms, url, method), n) for n, drop in enumerate(drops) for ms, url, method in drop]
    out = BatchFolder(str(tmp_path / "out"), jobs.LATE_REQUESTS)
    progress = Progress(str(tmp_path / "progress"))
    replay_in_drops(
        spark.createDataFrame(rows, "value string, drop int"), "drop", str(tmp_path / "in"),
        lambda live: jobs.stream_late_requests(
            parse_access_log(live), progress, out, str(tmp_path / "state"), available_now=True))
    # watermark 699000: late when last end - 1 + 60000 <= 699000, so last end <= 639001
    late = out.read(spark).select("url", F.unix_millis("ts")).collect()
    assert sorted(tuple(r) for r in late) == [("/lost", 30_000), ("/lost", 39_000)]


def test_all_rows_move_the_watermark_of_hot_pages(spark, tmp_path):
    rows = [(log_line(1_000, "/a"), 0), (log_line(500_000, "/p", "POST"), 1), (log_line(501_000, "/x.png"), 2)]
    out = BatchFolder(str(tmp_path / "out"), jobs.RANKED_PAGES)
    store, progress = OpenSpans(str(tmp_path / "spans"), "url", "string"), Progress(str(tmp_path / "progress"))
    replay_in_drops(
        spark.createDataFrame(rows, "value string, drop int"), "drop", str(tmp_path / "in"),
        lambda live: jobs.stream_hot_pages(
            parse_access_log(live), store, progress, out, str(tmp_path / "state"), available_now=True, size=10_000, slide=5_000))
    assert {(r.url, r.window_end) for r in out.read(spark).collect()} == {("/a", 5_000), ("/a", 10_000)}


def test_finish_ranks_what_is_still_open(spark, tmp_path):
    drops = [[(1, 10), (2, 3599)], [(1, 3700)]]
    lines = behavior_lines(spark, *drops)
    replay_in_drops(
        lines, "drop", str(tmp_path / "in"),
        lambda live: jobs.stream_page_views(parse_behavior(live), str(tmp_path / "out"), str(tmp_path / "state"), available_now=True))
    jobs.finish_page_views(spark, str(tmp_path / "rest"), str(tmp_path / "state"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "rest")).collect()} == {("pv", 2 * HOUR, 1)}
    out = BatchFolder(str(tmp_path / "items"), jobs.RANKED_ITEMS)
    replay_in_drops(
        lines, "drop", str(tmp_path / "in2"),
        lambda live: jobs.stream_hot_items(parse_behavior(live), out, str(tmp_path / "state2"), available_now=True))
    jobs.finish_hot_items(spark, out, str(tmp_path / "state2"))
    rows = [(item, sec * 1000) for drop in drops for item, sec in drop]
    assert {tuple(r) for r in out.read(spark).drop("batch_id").collect()} == model.ranked(model.counts(rows, HOUR, 300_000), 5)


def test_a_batch_killed_between_its_outputs_leaves_neither(spark, tmp_path, monkeypatch):
    drops = [[(1_000, "/a"), (700_000, "/b")], [(30_000, "/lost"), (900_000, "/c")], [(40_000, "/lost2"), (990_000, "/d")]]
    lines = spark.createDataFrame([(log_line(ms, url), n) for n, drop in enumerate(drops) for ms, url in drop], "value string, drop int")
    together = CommittedFolders(str(tmp_path / "out"), {"ranking": jobs.RANKED_PAGES, "late": jobs.LATE_REQUESTS})
    store, progress = OpenSpans(str(tmp_path / "spans"), "url", "string"), Progress(str(tmp_path / "progress"))
    out, late = together["ranking"], together["late"]
    assert out.read(spark).collect() == [] and together.newest(spark) is None

    def start(rows):
        return jobs.stream_hot_pages(
            parse_access_log(rows), store, progress, out, str(tmp_path / "state"), available_now=True, late=late,
            together=together)

    written = out.write

    def stopped(rows, batch_id):
        if batch_id == 1:
            raise RuntimeError("lost between the outputs")
        written(rows, batch_id)

    monkeypatch.setattr(out, "write", stopped)
    with pytest.raises(Exception, match="lost between the outputs"):
        replay_in_drops(lines, "drop", str(tmp_path / "in"), start)
    spark.streams.resetTerminated()  # or whoever waits for any stream of this session gets the error again
    assert (tmp_path / "out" / "late" / "batch_id=1").exists()
    assert together.newest(spark) == 0
    assert {r.batch_id for r in out.read(spark).unionByName(late.read(spark), allowMissingColumns=True).collect()} <= {0}
    assert late.read(spark).collect() == []

    monkeypatch.setattr(out, "write", written)
    start(stream_lines(spark, str(tmp_path / "in") + "/*/*", max_files_per_trigger=1).select("value")).awaitTermination()
    assert together.newest(spark) == 2 and len(list((tmp_path / "out" / "_commits").glob("[0-9]*"))) == 1
    assert {(r.batch_id, r.url) for r in late.read(spark).collect()} == {(1, "/lost"), (2, "/lost2")}
    assert {(r.url, r.cnt) for r in jobs.latest_ranking(out, spark).collect()} == {("/a", 1), ("/b", 1), ("/c", 1)}
    assert together.done(spark, 2) and not together.done(spark, 3)
    with pytest.raises(ValueError, match="another run"):
        together.done(spark, 0)


def test_rerun_of_a_batch_leaves_the_same_rows(spark, tmp_path):
    out = BatchFolder(str(tmp_path / "out"), "id bigint")
    progress = Progress(str(tmp_path / "progress"))
    for _ in range(2):
        out.write(spark.range(3), 0)
        assert progress.advance(spark.range(5), "id", 0) == 4
    assert out.read(spark).count() == 3
    assert progress.before(spark, 0) is None and progress.before(spark, 1) == 4
    assert progress.advance(spark.range(2), "id", 1) == 4


def test_open_spans_hold_what_is_needed_and_one_version_more(spark, tmp_path):
    store = OpenSpans(str(tmp_path / "spans"), "url", "string")
    for batch in range(50):
        spans = spark.createDataFrame([("/a", batch, batch + 3, 1), ("/b", batch, batch + 3, 2)], store.schema)
        for _ in range(2):  # a repeated batch leaves the same rows
            merged = store.add(spans, batch, F.col("last_end") > batch)
        assert merged.count() == 2 * min(batch + 1, 4)
    live = {(r.url, r.first_end, r.n) for r in store.before(spark, 50).collect()}
    assert live == {(u, k, n) for k in (47, 48, 49) for u, n in (("/a", 1), ("/b", 2))}
    assert sorted(p.name for p in (tmp_path / "spans").iterdir()) == ["batch_id=48", "batch_id=49"]


def test_console_prints_every_row(spark, tmp_path, capsys):
    rows = spark.createDataFrame([("/a",)], "url string")
    assert labelled(rows, "late data").collect() == [("late data", "/a")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("".join(f"row {n}\n" for n in range(60)))
    live = spark.readStream.text(str(tmp_path / "in"))
    query = console(live, label="late data").option("checkpointLocation", str(tmp_path / "state")).trigger(
        availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None
    printed = [line for line in capsys.readouterr().out.split("\n") if line.startswith("late data> row ")]
    assert len(printed) == 60


def test_sql_form_on_lines(spark):
    lines = spark.createDataFrame([("1,5,7,pv,100",), ("1,5,7,buy,100",)], "value string")
    assert hot_items_sql(parse_behavior(lines)).count() == 12
