"""Streaming queries: each returns a started ``StreamingQuery``.

``rows`` and ``requests`` are parsed streams with a ``ts`` timestamp. ``checkpoint``
and the output folders belong on storage shared by all executors. With
``available_now`` a query handles what has arrived and stops; started again on the
same checkpoint it continues where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from wavecount.functions.eventtime import first_window_end, interval, last_end_reached, last_window_end
from wavecount.operators.changelog import changelog
from wavecount.operators.filters import is_behavior, keep_above_watermark, keep_page_requests
from wavecount.operators.lateness import (
    ALLOWED_LATENESS, ASCENDING_DELAY, BOUNDED_DELAY, FIRST_COUNT, FIRST_RANKING, lost_after)
from wavecount.operators.ranking import TOP_N, top_n
from wavecount.operators.windows import stream_window_counts, unroll_spans
from wavecount.plans import hot_items, hot_pages, page_views
from wavecount.streaming.sinks import BatchFolder, CommittedFolders, OpenSpans, Progress

RANKED_ITEMS = "item_id bigint, window_end bigint, cnt bigint, row_num int"
RANKED_PAGES = "url string, window_end bigint, cnt bigint, row_num int"
ITEM_CHANGES = "insert boolean, " + RANKED_ITEMS
LATE_REQUESTS = "ip string, user_id string, ts timestamp, method string, url string"


def _start(writer: DataStreamWriter, checkpoint: str, available_now: bool) -> StreamingQuery:
    """Start on a checkpoint.

    The number of state partitions is ``spark.sql.shuffle.partitions`` of the first
    start, for good: choose it for the cluster that the stream may grow to.
    """
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def for_each_batch(rows: DataFrame, handle: Callable[[DataFrame, int], None], output_mode: str,
                   checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Start a query that gives each micro-batch, held for its time, to ``handle``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            handle(batch, batch_id)
        finally:
            batch.unpersist()

    return _start(rows.writeStream.foreachBatch(run).outputMode(output_mode), checkpoint, available_now)


def page_views_counts(rows: DataFrame, size: int = page_views.SIZE) -> DataFrame:
    """metric, window_end, cnt of every hour that the watermark has passed."""
    counts = stream_window_counts(rows.withWatermark("ts", interval(0)), [], size)
    return counts.select(F.lit(page_views.METRIC).alias("metric"), "window_end", "cnt")


def stream_page_views(rows: DataFrame, out: str, checkpoint: str, available_now: bool = False,
                      size: int = page_views.SIZE) -> StreamingQuery:
    """Hourly volume appended to a parquet folder, each hour once."""
    writer = page_views_counts(rows, size).writeStream.format("parquet").option("path", out).outputMode("append")
    return _start(writer, checkpoint, available_now)


def _unfinished(spark: SparkSession, checkpoint: str, keys: list[str]) -> DataFrame:
    """keys, window_end, cnt of the windows which a stopped append query still holds."""
    state = spark.read.format("statestore").load(checkpoint)
    named = {k: f for f in state.schema["key"].dataType.names for k in keys if f == k}
    window = next(f for f in state.schema["key"].dataType.names if f not in named)
    count = state.schema["value"].dataType.names[0]
    return state.select(*[F.col("key")[k].alias(k) for k in keys],
                        F.unix_millis(F.col("key")[window]["end"]).alias("window_end"), F.col("value")[count].alias("cnt"))


def finish_page_views(spark: SparkSession, rest: str, checkpoint: str) -> None:
    """Write the hours that are still open to ``rest``. Only for input that has ended: a later start would count on.

    ``checkpoint`` is that of a stopped ``stream_page_views``; its own output folder lists
    what the query has committed, so the rest has a folder beside it.
    """
    left = _unfinished(spark, checkpoint, [])
    left.select(F.lit(page_views.METRIC).alias("metric"), "window_end", "cnt").write.mode("overwrite").parquet(rest)


def finish_hot_items(spark: SparkSession, out: BatchFolder, checkpoint: str, n: int = TOP_N) -> None:
    """Rank the windows that are still open, as one more batch. Only for input that has ended."""
    last = out.read(spark).agg(F.max("batch_id")).first()[0]
    out.write(top_n(_unfinished(spark, checkpoint, ["item_id"]), "item_id", n), (last or 0) + 1)


def item_counts_stream(rows: DataFrame, size: int = hot_items.SIZE, slide: int = hot_items.SLIDE) -> DataFrame:
    """item_id, window_end, cnt of viewed items; every row moves the watermark."""
    views = keep_above_watermark(rows.withWatermark("ts", interval(0)), is_behavior())
    return stream_window_counts(views, ["item_id"], size, slide)


def stream_hot_items(rows: DataFrame, out: BatchFolder, checkpoint: str, available_now: bool = False,
                     n: int = TOP_N, size: int = hot_items.SIZE, slide: int = hot_items.SLIDE) -> StreamingQuery:
    """The top items of every closed window.

    In append mode all counts of a window leave the state in the same micro-batch,
    so the ranking inside a batch is complete.
    """
    return for_each_batch(
        item_counts_stream(rows, size, slide),
        lambda counts, batch_id: out.write(top_n(counts, "item_id", n), batch_id),
        "append", checkpoint, available_now)


def _spans(rows: DataFrame, key: str, size: int, slide: int, before: int | None, after: int) -> DataFrame:
    """key, first_end, last_end, n: what the rows of a batch add to windows that still take rows.

    ``before`` is the watermark that the batch meets; a window takes rows until it
    reaches the window's end plus ``after``.
    """
    ts_ms = F.unix_millis("ts")
    first = first_window_end(ts_ms, size, slide)
    if before is not None:
        lost = F.lit(before - after).cast("bigint")
        first = F.greatest(first, last_end_reached(lost, size, slide) + slide)
    spans = rows.select(key, first.alias("first_end"), last_window_end(ts_ms, size, slide).alias("last_end"))
    return spans.filter("first_end <= last_end").groupBy(key, "first_end", "last_end").agg(F.count(F.lit(1)).alias("n"))


def _touched(spans: DataFrame, slide: int) -> DataFrame:
    """The windows that the spans of a batch change."""
    distinct = spans.select("first_end", "last_end").distinct()
    return distinct.select(F.explode(F.sequence("first_end", "last_end", F.lit(slide).cast("bigint"))).alias("window_end")).distinct()


def stream_hot_items_changelog(rows: DataFrame, store: OpenSpans, progress: Progress, out: BatchFolder, checkpoint: str,
                               available_now: bool = False, n: int = TOP_N, size: int = hot_items.SIZE,
                               slide: int = hot_items.SLIDE,
                               handle_changes: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """The running top items as insert and delete rows, per micro-batch.

    Only the windows a batch touched are ranked, before and after it. The store holds
    spans of windows that the watermark has not passed.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = progress.before(spark, batch_id)
        now = progress.advance(batch.select(F.unix_millis("ts").alias("ts_ms")), "ts_ms", batch_id)
        seen = None if before is None else before - ASCENDING_DELAY
        spans = _spans(batch.filter(is_behavior()), "item_id", size, slide, seen, FIRST_COUNT)
        old_spans = store.before(spark, batch_id)
        needed = F.lit(True) if now is None else F.col("last_end") + FIRST_COUNT > now - ASCENDING_DELAY
        new_spans = store.add(spans, batch_id, needed)
        touched = _touched(spans, slide)
        old, new = (top_n(unroll_spans(s, ["item_id"], size, slide).join(touched, "window_end", "left_semi"), "item_id", n)
                    for s in (old_spans, new_spans))
        out.write(changelog(old, new).select("insert", "item_id", "window_end", "cnt", "row_num"), batch_id)
        if handle_changes:
            handle_changes(out.read_batch(spark, batch_id), batch_id)

    return for_each_batch(rows, handle, "append", checkpoint, available_now)


def _rank_pages(counts: DataFrame, n: int) -> DataFrame:
    return top_n(counts.select("url", "window_end", "cnt"), "url", n)


def stream_hot_pages(requests: DataFrame, store: OpenSpans, progress: Progress, out: BatchFolder,
                     checkpoint: str, available_now: bool = False, n: int = TOP_N, size: int = hot_pages.SIZE,
                     slide: int = hot_pages.SLIDE, delay: int = BOUNDED_DELAY,
                     lateness: int = ALLOWED_LATENESS, late: BatchFolder | None = None,
                     handle_ranking: Callable[[DataFrame, int], None] | None = None,
                     together: CommittedFolders | None = None) -> StreamingQuery:
    """The top pages of a window when it closes, and again whenever a late row changes it.

    Every row moves the watermark, also one that is no page request. What is ranked in
    a batch is every window that the on-time watermark passed since the last batch,
    and every window passed before that the batch touched. Requests and windows are
    compared with the watermark of the earlier batches; a request that all its windows
    lost goes to ``late``. The store holds one row per url and slide interval. With
    ``together``, which ``out`` and ``late`` are of, both appear at once.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if together and together.done(spark, batch_id):
            return
        before = progress.before(spark, batch_id)
        now = progress.advance(batch.select(F.unix_millis("ts").alias("ts_ms")), "ts_ms", batch_id)
        seen = None if before is None else before - delay
        kept = keep_page_requests(batch)
        if late is not None:
            late.write(_late(kept, seen, size, slide, lateness), batch_id)
        spans = _spans(kept, "url", size, slide, seen, lost_after(lateness))
        passed = None if now is None else now - delay
        needed = F.lit(True) if passed is None else F.col("last_end") + lost_after(lateness) > passed
        merged = store.add(spans, batch_id, needed)
        if passed is None:
            ranked = spark.createDataFrame([], RANKED_PAGES)
        else:
            closed = F.col("window_end") <= passed - FIRST_RANKING
            news = F.lit(True) if seen is None else F.col("window_end") > seen - FIRST_RANKING
            touched = _touched(spans, slide).withColumn("touched", F.lit(True))
            counts = unroll_spans(merged, ["url"], size, slide).filter(closed).join(touched, "window_end", "left")
            ranked = _rank_pages(counts.filter(F.col("touched") | news), n)
        out.write(ranked, batch_id)
        if together:
            together.commit(spark, batch_id)
        if handle_ranking:
            handle_ranking(out.read_batch(spark, batch_id), batch_id)

    return for_each_batch(requests, handle, "append", checkpoint, available_now)


def finish_hot_pages(spark: SparkSession, store: OpenSpans, progress: Progress, out: BatchFolder, n: int = TOP_N,
                     size: int = hot_pages.SIZE, slide: int = hot_pages.SLIDE, delay: int = BOUNDED_DELAY,
                     together: CommittedFolders | None = None) -> None:
    """Rank the windows that have not closed yet, as one more batch. Only for input that has ended."""
    last = out.read(spark).agg(F.max("batch_id")).first()[0]
    now = None if last is None else progress.before(spark, last + 1)
    if now is None:
        return
    counts = unroll_spans(store.before(spark, last + 1), ["url"], size, slide)
    out.write(_rank_pages(counts.filter(F.col("window_end") > now - delay - FIRST_RANKING), n), last + 1)
    if together:
        together.commit(spark, last + 1)


def latest_ranking(out: BatchFolder, spark: SparkSession) -> DataFrame:
    """The newest ranking of every window from the output of ``stream_hot_pages``."""
    ranked = out.read(spark)
    newest = ranked.groupBy("window_end").agg(F.max("batch_id").alias("batch_id"))
    return ranked.join(newest, ["window_end", "batch_id"]).drop("batch_id")


def _late(kept: DataFrame, seen: int | None, size: int, slide: int, lateness: int) -> DataFrame:
    if seen is None:
        kept = kept.filter(F.lit(False))
    else:
        kept = kept.filter(last_window_end(F.unix_millis("ts"), size, slide) + lost_after(lateness) <= seen)
    return kept.select("ip", "user_id", "ts", "method", "url")


def stream_late_requests(requests: DataFrame, progress: Progress, out: BatchFolder, checkpoint: str,
                         available_now: bool = False, size: int = hot_pages.SIZE, slide: int = hot_pages.SLIDE,
                         delay: int = BOUNDED_DELAY, lateness: int = ALLOWED_LATENESS) -> StreamingQuery:
    """Page requests that arrive after all their windows were closed for good.

    The watermark is that of the earlier micro-batches; rows of the same batch do
    not make each other late.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        before = progress.before(batch.sparkSession, batch_id)
        progress.advance(batch.select(F.unix_millis("ts").alias("ts_ms")), "ts_ms", batch_id)
        out.write(_late(keep_page_requests(batch), None if before is None else before - delay, size, slide, lateness), batch_id)

    return for_each_batch(requests, handle, "append", checkpoint, available_now)
