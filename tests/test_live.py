"""Live rankings decided row by row, their state, and the folding of changes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import reference_model as model
from test_streaming import log_line
from wavecount.operators.changelog import fold
from wavecount.session import materialise, scratch
from wavecount.sources.access_log import parse_access_log
from wavecount.sources.behavior import parse_behavior
from wavecount.sources.lines import FILE_PLACE
from wavecount.streaming import jobs, live
from wavecount.streaming.replay import replay_in_drops
from wavecount.streaming.sinks import BatchFolder, FoldedChanges, HandOver, Progress

SIZE, SLIDE, DELAY, LATENESS = 20_000, 5_000, 1_000, 10_000


def run_pages(spark, folder, rows, drop_of, progress=None):
    """(url, ms, method) rows in order of arrival -> final rankings, late rows and the progress of the counting stream."""
    windows = live.page_windows(SIZE, SLIDE, DELAY, LATENESS)
    lines = [(log_line(ms, url, method), drop_of(k), k) for k, (url, ms, method) in enumerate(rows)]
    taken, late = HandOver(f"{folder}/taken", windows.spans), BatchFolder(f"{folder}/late", jobs.LATE_REQUESTS)
    replay_in_drops(
        spark.createDataFrame(lines, "value string, drop int, k int"), "drop", f"{folder}/in",
        lambda rows: live.stream_taken(parse_access_log(rows, carry=FILE_PLACE), windows, taken, Progress(f"{folder}/progress"),
                                       f"{folder}/state", available_now=True, late=late),
        order=("k",), with_place=True)
    live.finish_taken(spark, windows, taken)
    out = BatchFolder(f"{folder}/out", windows.ranked)
    query = live.stream_ranking(spark, windows, taken, BatchFolder(f"{folder}/kept", windows.ranked), out, f"{folder}/ranking",
                                available_now=True, n=2, max_files_per_trigger=4)
    query.awaitTermination()
    if progress is not None:
        progress += query.recentProgress
    ranking = {tuple(r) for r in jobs.latest_ranking(out, spark).select("url", "window_end", "cnt", "row_num").collect()}
    return ranking, sorted((r.url, r.ms) for r in late.read(spark).select("url", F.unix_millis("ts").alias("ms")).collect())


def disordered(seed, n):
    """Requests that often come up to a minute late; a few move the watermark without being counted."""
    rng, rows, now = random.Random(seed), [], 100_000
    for _ in range(n):
        now += rng.choice([0, 1_000, 3_000, 9_000])
        ms = now - rng.choice([0, 0, 0, 2_000, 15_000, 35_000, 60_000])
        rows.append((rng.choice(["/a", "/b", "/c"]), ms, rng.choice(["GET", "get", "GET", "POST"])))
    return rows


def expected(rows):
    tagged = [(url, ms, k, k) for k, (url, ms, _) in enumerate(rows)]
    kept = {k for k, (_, _, method) in enumerate(rows) if method.lower() == "get"}
    after = LATENESS - 1
    counts = model.Counter((row[0], end) for row, wm in model.watermarks(tagged, DELAY) if row[3] in kept
                           for end in model.window_ends(row[1], SIZE, SLIDE) if wm is None or wm < end + after)
    late = model.late(tagged, SIZE, SLIDE, DELAY, LATENESS) & kept
    return model.ranked(counts, 2), sorted((rows[k][0], rows[k][1]) for k in late)


@pytest.mark.parametrize("cut", ["one batch", "a batch for each row", "uneven batches"])
def test_batches_do_not_matter(spark, tmp_path, cut):
    rows = disordered(1, 16 if cut == "a batch for each row" else 120)
    drop_of = {"one batch": lambda k: 0, "a batch for each row": lambda k: k, "uneven batches": lambda k: [0, 1, 1, 1, 4, 7][k // 20]}[cut]
    ranking, late = run_pages(spark, str(tmp_path), rows, drop_of)
    want, want_late = expected(rows)
    assert ranking == want and late == want_late
    if cut != "a batch for each row":
        assert late  # rows of the same batch have made them late


def test_state_work_follows_the_batch(spark, tmp_path):
    """Many urls are open; batches that touch one of them write for one, not for all."""
    rows = [(f"/{k}", 100_000, "GET") for k in range(200)] + [("/one", 100_500 + k, "GET") for k in range(6)]
    progress = []
    run_pages(spark, str(tmp_path), rows, lambda k: 0 if k < 200 else k - 199, progress)
    written = [(p.numInputRows, sum(s.numRowsUpdated for s in p.stateOperators)) for p in progress if p.numInputRows]
    assert written[0][1] >= 3 * 200  # the first batch: two changes and what is told, for each url
    assert all(n <= 6 for _, n in written[1:])  # the others: those of one url, with 201 open
    ranked = BatchFolder(str(tmp_path / "out"), live.page_windows().ranked).read(spark)
    assert ranked.filter("url = '/one'").agg(F.max("cnt")).first()[0] == 6


def test_no_state_is_left_when_nothing_can_change(spark, tmp_path):
    progress = []
    run_pages(spark, str(tmp_path), disordered(2, 60), lambda k: k // 20, progress)
    state = spark.read.format("statestore").option("stateVarName", "changes").load(f"{tmp_path}/ranking")
    assert state.count() == 0


def test_counts_of_touched_windows_alone_come_out(spark, tmp_path):
    """A batch ranks from the counts it changes: 12 windows for each item it touches, whatever else is open."""
    windows = live.item_windows()
    taken, seen = HandOver(str(tmp_path / "taken"), windows.spans), []
    rows = [(f"1,{item},7,pv,{1_000 + item}", 0, item) for item in range(50)] + [("1,3,7,pv,1500", 1, 0), ("1,4,7,pv,1501", 1, 1)]
    replay_in_drops(
        spark.createDataFrame(rows, "value string, drop int, k int"), "drop", str(tmp_path / "in"),
        lambda r: live.stream_taken(parse_behavior(r, carry=FILE_PLACE), windows, taken, Progress(str(tmp_path / "progress")),
                                    str(tmp_path / "state"), available_now=True), order=("k",), with_place=True)
    taken.finish(spark)
    files = [len(list(p.glob("*.parquet"))) for p in sorted((tmp_path / "taken/ready").iterdir())]
    changes = BatchFolder(str(tmp_path / "changes"), jobs.ITEM_CHANGES)
    real = live._brought_up_to_date

    def counted(updates, before, key, n):
        seen.append((updates.count(), before.count()))
        return real(updates, before, key, n)

    live._brought_up_to_date = counted
    try:
        live.stream_ranking_changes(spark, windows, taken, BatchFolder(str(tmp_path / "kept"), windows.ranked), changes,
                                    str(tmp_path / "ranking"), available_now=True, max_files_per_trigger=max(files)).awaitTermination()
    finally:
        live._brought_up_to_date = real
    assert sum(u for u, _ in seen) == 50 * 12 + 2 * 12
    assert max(kept for _, kept in seen) <= 14 * 5  # the best five of each of the 14 windows, not fifty
    table = FoldedChanges(str(tmp_path / "table"), ["item_id", "window_end", "cnt", "row_num"], changes)
    items = [(int(v.split(",")[1]), int(v.split(",")[4]) * 1_000) for v, _, _ in rows]
    assert {tuple(r) for r in table.read(spark).collect()} == model.ranked(model.counts(items, 3_600_000, 300_000), 5)


def test_fold_of_changes(spark):
    def changes(*rows):
        return spark.createDataFrame([(b, i, k) for b, i, k in rows], "batch_id bigint, insert boolean, k bigint")

    good = changes((0, True, 1), (0, True, 2), (1, False, 1), (2, True, 1), (2, False, 2), (2, False, 2), (0, True, 1))
    assert [r.k for r in fold(good, ["k"]).collect()] == [1]
    base = spark.createDataFrame([(5,)], "k bigint")
    assert sorted(r.k for r in fold(changes((3, True, 6)), ["k"], base).collect()) == [5, 6]
    assert fold(changes((3, False, 5)), ["k"], base).collect() == []
    for bad in (changes((0, False, 1)), changes((0, True, 1), (1, True, 1)), changes((0, True, 2), (1, False, 1), (2, True, 1))):
        with pytest.raises(Exception, match="that is (not )?there"):
            fold(bad, ["k"]).collect()


def test_folded_table_is_compacted(spark, tmp_path):
    out = BatchFolder(str(tmp_path / "changes"), "insert boolean, k bigint")
    table = FoldedChanges(str(tmp_path / "table"), ["k"], out)
    for batch in range(6):
        rows = [(True, batch)] + ([(False, batch - 2)] if batch > 1 else [])
        out.write(spark.createDataFrame(rows, out.schema), batch)
        assert {r.k for r in table.read(spark).collect()} == {k for k in (batch - 1, batch) if k >= 0}
        if batch % 2:
            table.compact(spark)
            table.compact(spark)
            assert {r.k for r in table.read(spark).collect()} == {batch - 1, batch}
    assert [p.name for p in (tmp_path / "changes").iterdir()] == ["batch_id=5"]
    assert [p.name for p in (tmp_path / "table").iterdir()] == ["batch_id=4"]


def test_a_repeated_batch_is_handed_over_once(spark, tmp_path):
    handed = HandOver(str(tmp_path), "k bigint")
    for k, batch in ((1, 0), (2, 0), (3, 1), (4, 1), (5, 2)):  # batches 0 and 1 run twice
        handed.write(spark.createDataFrame([(k,)], "k bigint"), batch)
    ready = {p.name for p in (tmp_path / "ready").iterdir()}
    assert ready == {"batch_id=0", "batch_id=1"}
    handed.end(spark.createDataFrame([(9,)], "k bigint"))
    handed.finish(spark)
    got = spark.read.schema("k bigint").parquet(*[str(p) for p in (tmp_path / "ready").iterdir()])
    assert sorted(r.k for r in got.collect()) == [2, 4, 5, 9]


def test_a_replay_starts_once_and_keeps_the_order(spark, tmp_path):
    rows = [(f"{drop}-{k}", drop, k) for drop in (3, 10, 11, 40) for k in (2, 1)]
    seen, starts = [], []

    def start(live_lines):
        starts.append(1)
        return jobs.for_each_batch(live_lines, lambda batch, n: seen.append([r.value for r in batch.collect()]), "append",
                                   str(tmp_path / "state"), available_now=True)

    replay_in_drops(spark.createDataFrame(rows, "value string, drop int, k int"), "drop", str(tmp_path / "in"), start, order=("k",))
    assert len(starts) == 1
    assert seen == [[f"{drop}-1", f"{drop}-2"] for drop in (3, 10, 11, 40)]
    seen.clear()
    many = spark.createDataFrame([(f"{k}", k % 3) for k in range(30)] + [("only", 3)], "value string, drop int")
    replay_in_drops(many, "drop", str(tmp_path / "in2"), lambda r: jobs.for_each_batch(
        r, lambda batch, n: seen.append({x.value for x in batch.collect()}), "append", str(tmp_path / "state2"), available_now=True), parts=4)
    assert seen == [{f"{k}" for k in range(30) if k % 3 == d} for d in range(3)] + [{"only"}]


def test_scratch_tables_go(spark, tmp_path):
    with scratch(spark):
        inside = materialise(spark.range(3), "inside")
        path = inside.inputFiles()[0]
    outside = materialise(spark.range(3), "outside")
    assert outside.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(path.rsplit("/", 1)[0]).count()


def test_any_session_can_rank_live_input(spark, tmp_path):
    """Rankings run where the session has Spark's default state store, and leave that setting as it is."""
    setting, default = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    ours = spark.conf.get(setting)
    spark.conf.set(setting, default)
    try:
        rows = disordered(3, 30)
        assert run_pages(spark, str(tmp_path), rows, lambda k: k // 15) == expected(rows)
        assert spark.conf.get(setting) == default
    finally:
        spark.conf.set(setting, ours)
