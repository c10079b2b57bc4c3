"""Rankings of live input that are decided row by row.

Two streams in a row. The first takes a micro-batch in its order of arrival and decides
for every row which windows still take it, as the batch replay does: what a row of the
batch has closed is closed for the rows after it, and what earlier batches have closed
for all. How the input is cut into batches does not matter. It hands on a few counts per
key, however many rows a key has, and writes late rows.

The second keeps the counts of open windows per key (``OpenWindows``) and ranks. Counts
only grow, so the best n of a window are among its best n so far and the keys whose
count changed: a ranking is brought up to date from these alone, and of a window only n
rows are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wavecount.operators.changelog import changelog
from wavecount.operators.filters import is_behavior, is_page_request
from wavecount.operators.lateness import (
    ALLOWED_LATENESS, ASCENDING_DELAY, BOUNDED_DELAY, FIRST_COUNT, batch_late_rows, batch_spans, lost_after)
from wavecount.operators.ranking import TOP_N, top_n
from wavecount.plans import hot_items, hot_pages
from wavecount.session import scratch, ship_package, with_column_families
from wavecount.sources.lines import FILE_PLACE
from wavecount.streaming.jobs import for_each_batch
from wavecount.streaming.open_windows import SPANS, window_counts
from wavecount.streaming.sinks import BatchFolder, HandOver, Progress

#: A time after all others; as a watermark it closes every window.
_END_MS = 253_370_764_800_000


@dataclass(frozen=True)
class Windows:
    """What is counted, in which windows, and how long they take rows."""

    key: str
    key_type: str
    kept: Callable[[], Column]
    size: int
    slide: int
    delay: int
    after: int

    @property
    def spans(self) -> str:
        return f"{self.key} {self.key_type}, {SPANS}"

    @property
    def ranked(self) -> str:
        return f"{self.key} {self.key_type}, window_end bigint, cnt bigint, row_num int"


def page_windows(size: int = hot_pages.SIZE, slide: int = hot_pages.SLIDE, delay: int = BOUNDED_DELAY,
                 lateness: int = ALLOWED_LATENESS) -> Windows:
    return Windows("url", "string", is_page_request, size, slide, delay, lost_after(lateness))


def item_windows(size: int = hot_items.SIZE, slide: int = hot_items.SLIDE) -> Windows:
    return Windows("item_id", "bigint", is_behavior, size, slide, ASCENDING_DELAY, FIRST_COUNT)


def _passed(ms: int) -> Column:
    """A watermark as an event time.

    Spark drops rows that are not above the watermark and counts it in whole
    milliseconds; the odd microseconds keep rows of a batch that moved nothing. Times
    before 1970 wait at the first millisecond, which changes when a ranking comes out first.
    """
    return F.timestamp_micros(F.lit(max(ms, 0) * 1000 + 999))


def stream_taken(rows: DataFrame, windows: Windows, handed: HandOver, progress: Progress, checkpoint: str,
                 available_now: bool = False, place: Sequence[str] = FILE_PLACE, late: BatchFolder | None = None,
                 handle_late: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Hand on the spans of windows that take the kept rows; write late ones with the columns of ``late``.

    ``rows`` is a parsed stream with ``ts`` and the ``place`` columns; rows that are not
    kept move the watermark, too.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ts_ms, order = F.unix_millis("ts"), F.col("_arrival")
        ordered = batch.withColumn("_arrival", F.struct(*place, F.monotonically_increasing_id().alias("line")))
        before = progress.before(spark, batch_id)
        now = progress.advance(batch.select(ts_ms.alias("ts_ms")), "ts_ms", batch_id)
        kept = ordered.filter(windows.kept())
        args = ts_ms, windows.size, windows.slide
        with scratch(spark):
            spans, closings = batch_spans(ordered, kept, [windows.key], order, *args, windows.delay, windows.after, before)
            if late is not None:
                lost = batch_late_rows(kept, order, *args, closings, windows.delay, windows.after, before)
                late.write(lost.select(*[c.split()[0] for c in late.schema.split(", ")]), batch_id)
            counts = spans.groupBy(windows.key, "first_end", "last_end").agg(F.count(F.lit(1)).alias("n"))
            handed.write(_to_hand_on(spark, counts, windows, None if now is None else now - windows.delay), batch_id)
        if late is not None and handle_late:
            handle_late(late.read_batch(spark, batch_id), batch_id)

    return for_each_batch(rows, handle, "append", checkpoint, available_now)


def _to_hand_on(spark: SparkSession, counts: DataFrame | None, windows: Windows, passed: int | None) -> DataFrame:
    """Counts of a batch, and one row without any that tells the watermark in any case."""
    mark = spark.createDataFrame([(None, 0, 0, 0)], f"{windows.key} {windows.key_type}, first_end bigint, last_end bigint, n bigint")
    rows = mark if counts is None else counts.unionByName(mark)
    return rows.withColumn("passed", _passed(0 if passed is None else passed)).coalesce(spark.sparkContext.defaultParallelism)


def finish_taken(spark: SparkSession, windows: Windows, handed: HandOver) -> None:
    """Hand over the rest of a stopped ``stream_taken`` and close all windows. Only for input that has ended."""
    handed.end(_to_hand_on(spark, None, windows, _END_MS))


def _brought_up_to_date(updates: DataFrame, before: DataFrame, key: str, n: int) -> DataFrame:
    """The best n of every window in ``updates``, from its best n before and the counts that changed."""
    old = before.join(updates.select("window_end").distinct(), "window_end", "left_semi")
    old = old.join(updates, [key, "window_end"], "left_anti")
    return top_n(updates.unionByName(old.select(key, "window_end", "cnt")), key, n)


def stream_ranking(spark: SparkSession, windows: Windows, handed: HandOver, kept: BatchFolder, out: BatchFolder, checkpoint: str,
                   available_now: bool = False, n: int = TOP_N, handle_ranking: Callable[[DataFrame, int], None] | None = None,
                   max_files_per_trigger: int | None = None) -> StreamingQuery:
    """The ranking of every window when it closes, and again whenever a late row changes it."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        ranked, rest = _ranked(spark, batch, batch_id, windows, kept, n)
        out.write(ranked, batch_id)
        kept.write(out.read_batch(spark, batch_id).unionByName(rest), batch_id)
        kept.forget(spark, batch_id - 2)
        if handle_ranking:
            handle_ranking(out.read_batch(spark, batch_id), batch_id)

    return _start(spark, windows, handed, handle, checkpoint, available_now, True, max_files_per_trigger)


def stream_ranking_changes(spark: SparkSession, windows: Windows, handed: HandOver, kept: BatchFolder, out: BatchFolder, checkpoint: str,
                           available_now: bool = False, n: int = TOP_N, handle_changes: Callable[[DataFrame, int], None] | None = None,
                           max_files_per_trigger: int | None = None) -> StreamingQuery:
    """The running ranking of all windows as insert and delete rows per batch."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        ranked, rest = _ranked(spark, batch, batch_id, windows, kept, n)
        kept.write(ranked.unionByName(rest), batch_id)
        touched = batch.select("window_end").distinct()
        old, new = (t.join(touched, "window_end", "left_semi") for t in (
            _kept_before(spark, kept, batch_id, windows), kept.read_batch(spark, batch_id)))
        out.write(changelog(old, new).select(*[c.split()[0] for c in out.schema.split(", ")]), batch_id)
        kept.forget(spark, batch_id - 2)
        if handle_changes:
            handle_changes(out.read_batch(spark, batch_id), batch_id)

    return _start(spark, windows, handed, handle, checkpoint, available_now, False, max_files_per_trigger)


def _kept_before(spark: SparkSession, kept: BatchFolder, batch_id: int, windows: Windows) -> DataFrame:
    return kept.read_batch(spark, batch_id - 1) if batch_id else spark.createDataFrame([], windows.ranked)


def _ranked(spark: SparkSession, batch: DataFrame, batch_id: int, windows: Windows, kept: BatchFolder, n: int) -> tuple[DataFrame, DataFrame]:
    """The rankings a batch changes, and those it leaves as they are and that may change later."""
    before = _kept_before(spark, kept, batch_id, windows)
    updates = batch.select(windows.key, "window_end", "cnt").filter("cnt > 0")
    watermark = batch.agg(F.max("watermark_ms")).first()[0]
    rest = before.join(updates.select("window_end").distinct(), "window_end", "left_anti").select(*before.columns)
    if watermark is not None:
        rest = rest.filter(F.col("window_end") + windows.after > watermark)
    return _brought_up_to_date(updates, before, windows.key, n), rest


def _start(spark: SparkSession, windows: Windows, handed: HandOver, handle: Callable[[DataFrame, int], None], checkpoint: str,
           available_now: bool, on_close: bool, max_files_per_trigger: int | None) -> StreamingQuery:
    ship_package(spark)
    counts = window_counts(handed.stream(spark, max_files_per_trigger), windows.key, windows.size, windows.slide, windows.after, on_close)
    with with_column_families(spark):
        return for_each_batch(counts, handle, "update", checkpoint, available_now)
