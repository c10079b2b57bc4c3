"""Counts per key and event-time window.

A row lies in ``size / slide`` sliding windows. Emitting it once per window would
multiply the input by 12 or 120 ahead of the shuffle. Instead rows are counted
once per span of windows (all rows of one slide interval share their span), each
span becomes two changes of a running count - plus n at its first window, minus n
after its last - and the running count is unrolled into windows at the very end.
What is shuffled is then two small rows per key and slide interval.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavecount.functions.eventtime import align_down, first_window_end, interval, last_window_end

# Time covered by one (key, block) group of the running count, in window sizes. It
# bounds a group whatever the key's row count, and splits a hot key over tasks.
BLOCK_SIZES = 8


def sliding_counts(rows: DataFrame, keys: Sequence[str], ts_ms: Column, size: int, slide: int) -> DataFrame:
    """keys, window_end (epoch ms), cnt for windows of ``size`` ms every ``slide`` ms."""
    spans = rows.select(
        *keys,
        first_window_end(ts_ms, size, slide).alias("first_end"),
        last_window_end(ts_ms, size, slide).alias("last_end"),
    )
    return count_spans(spans, keys, size, slide)


def count_spans(spans: DataFrame, keys: Sequence[str], size: int, slide: int) -> DataFrame:
    """Count rows per window, where a row covers the ends ``first_end`` to ``last_end``.

    The columns are ``keys``, ``first_end`` and ``last_end``; a row whose span is
    empty counts nowhere. No span may be longer than ``size``.
    """
    if slide > size:
        spans = spans.filter("first_end <= last_end")
    return unroll_spans(spans.groupBy(*keys, "first_end", "last_end").agg(F.count(F.lit(1)).alias("n")), keys, size, slide)


def unroll_spans(per_span: DataFrame, keys: Sequence[str], size: int, slide: int) -> DataFrame:
    """Count rows per window from ``n`` rows for each key and span."""
    block = -(-BLOCK_SIZES * size // slide) * slide
    return _unroll(_changes(per_span, keys, size, slide, block), keys, slide, block)


def _changes(per_span: DataFrame, keys: Sequence[str], size: int, slide: int, block: int) -> DataFrame:
    """Rows (keys, block_start, at, delta): how the running count of a block changes.

    A span that crosses into the next block starts again at that block's first
    window, so each block is complete in itself.
    """
    phase = size % slide  # window ends are multiples of the slide plus this
    starts, stops = F.col("first_end"), F.col("last_end") + slide
    own = align_down(starts - phase, block) + phase
    after = align_down(stops - phase, block) + phase
    crosses = (after > own) & (stops > after)
    changes = F.array(
        _change(own, starts, F.col("n")),
        _change(after, after, F.when(crosses, F.col("n"))),
        _change(after, stops, F.when((after == own) | crosses, -F.col("n"))),
    )
    return per_span.select(*keys, F.inline(changes)).filter(F.col("delta").isNotNull())


def _change(block_start: Column, at: Column, delta: Column) -> Column:
    return F.struct(block_start.alias("block_start"), at.alias("at"), delta.alias("delta"))


def _unroll(changes: DataFrame, keys: Sequence[str], slide: int, block: int) -> DataFrame:
    """Running count per block, repeated for every window until its next change."""
    order = Window.partitionBy(*keys, "block_start").orderBy("at")
    runs = changes.select(
        *keys,
        "at",
        F.sum("delta").over(order).alias("cnt"),  # range frame: includes all changes at this instant
        F.lead("at").over(order).alias("next_at"),
        (F.col("block_start") + block).alias("block_stop"),
    ).filter((F.col("cnt") > 0) & (F.col("next_at").isNull() | (F.col("next_at") > F.col("at"))))
    until = F.coalesce("next_at", "block_stop") - slide
    ends = F.sequence("at", until, F.lit(slide).cast("bigint"))
    return runs.select(*keys, F.explode(ends).alias("window_end"), "cnt")


def tumbling_counts(rows: DataFrame, keys: Sequence[str], ts_ms: Column, size: int) -> DataFrame:
    """keys, window_end, cnt for back-to-back windows: one partially combined aggregate."""
    return rows.select(*keys, last_window_end(ts_ms, size, size).alias("window_end")).groupBy(
        *keys, "window_end").agg(F.count(F.lit(1)).alias("cnt"))


def stream_window_counts(rows: DataFrame, keys: Sequence[str], size: int, slide: int | None = None) -> DataFrame:
    """The streaming form on a watermarked column ``ts``; state is one row per key and window."""
    window = F.window("ts", interval(size), interval(slide)) if slide else F.window("ts", interval(size))
    counts = rows.groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.select(*keys, F.unix_millis("w.end").alias("window_end"), "cnt")
