"""Out-of-order input: watermarks, allowed lateness and the late output.

The contract. Rows arrive in one total order. The watermark seen by a row is the
largest event time of all earlier rows minus ``delay``; the first row sees none.
A window with end ``e`` has a row

* on time  while the watermark is below ``e - 1``,
* refined  from then on, for ``lateness`` ms,
* lost     afterwards. A row that is lost for its last window is a late row.

Comparing every row with its own watermark needs the whole input sorted by
arrival. It can be avoided: the watermark only grows, so a window stops taking
rows at one point of the arrival order - the first row whose event time lifts the
watermark to the closing time. ``window_closings`` finds these points with one
partially combined minimum per slide interval; rows are then compared with the
closing point of their windows, in place, without being shuffled or sorted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavecount.functions.eventtime import (
    MINUTE,
    SECOND,
    align_down,
    first_window_end,
    last_end_reached,
    last_window_end,
)
from wavecount.session import materialise

# What each job allows.
ASCENDING_DELAY = 1
BOUNDED_DELAY = 1 * SECOND
ALLOWED_LATENESS = 1 * MINUTE

# When a window closes, relative to its end.
FIRST_COUNT = -1
FIRST_RANKING = 1

# Windows per group of the running minimum over closing points.
_CHUNK_WINDOWS = 2_000


def lost_after(lateness: int = ALLOWED_LATENESS) -> int:
    """When a window takes no more refinements, relative to its end."""
    return lateness - 1


def arrival_order(arrival_ms: Column, row_id: Column) -> Column:
    """One sortable value for (arrival, row id), both non-negative ``bigint``; no bits are lost."""
    shift = F.lit("10000000000000000000").cast("decimal(20,0)")
    return (arrival_ms.cast("decimal(18,0)") * shift + row_id.cast("decimal(19,0)")).cast("decimal(38,0)")


def window_closings(stream: DataFrame, order: Column, ts_ms: Column, size: int, slide: int,
                    delay: int, after: int) -> DataFrame:
    """window_end, closed_after, prev_closed_after: the last arrival each window takes.

    A window closes once the watermark is at least its end plus ``after``; the row
    that lifts the watermark is itself still taken. ``closed_after`` is null for a
    window that never closes. ``stream`` must hold every row that moves the
    watermark, also those which a later filter drops. The result has at most one
    row per slide interval of the time covered, whatever the number of rows.
    """
    if delay < 0 or after < -1:
        raise ValueError("a window cannot close before its end")
    reached = stream.select(
        last_end_reached(ts_ms - (delay + after), size, slide).alias("end"), order.alias("arrival")
    ).groupBy("end").agg(F.min("arrival").alias("arrival"))
    reached = materialise(reached.withColumn(
        "chunk", F.floor(F.col("end") / F.lit(_CHUNK_WINDOWS * slide)).cast("bigint")), "reached")

    # Running minimum from the latest window backwards: over chunks, then inside each.
    # Growing frames only; a frame that shrinks is recomputed for every row.
    chunks = reached.groupBy("chunk").agg(
        F.min("arrival").alias("arrival"), F.max("end").alias("end"), F.max_by("arrival", "end").alias("at_end"))
    newest_chunk = Window.orderBy(F.desc("chunk"))
    chunks = chunks.select(
        "chunk",
        F.min("arrival").over(newest_chunk.rowsBetween(Window.unboundedPreceding, -1)).alias("later"),
        F.lead("end").over(newest_chunk).alias("chunk_prev_end"),
        F.lead("at_end").over(newest_chunk).alias("chunk_prev_arrival"),
    )
    newest = Window.partitionBy("chunk").orderBy(F.desc("end"))
    steps = reached.join(chunks, "chunk").select(
        "end",
        F.least(F.min("arrival").over(newest.rowsBetween(Window.unboundedPreceding, 0)), "later").alias("closed"),
        F.coalesce(F.lead("end").over(newest), "chunk_prev_end").alias("prev_end"),
        F.coalesce(F.lead("arrival").over(newest), "chunk_prev_arrival").alias("prev_arrival"),
        (F.lag("end").over(newest).isNull() & F.col("later").isNull()).alias("is_last"),
    )

    # Fill the window ends up to each step, but no further into a gap than rows reach.
    step = F.lit(slide).cast("bigint")
    horizon = size + slide + delay + after
    start = F.col("prev_end") + slide
    fill = F.when(F.col("prev_end").isNull(), F.array("end")).otherwise(F.array_union(
        F.sequence(start, F.least("end", F.greatest(start, F.col("prev_end") + horizon)), step), F.array("end")))
    follows_step = F.col("window_end") == start
    filled = steps.withColumn("window_end", F.explode(fill)).select(
        "window_end",
        F.col("closed").alias("closed_after"),
        F.when(follows_step, F.least("prev_arrival", "closed")).otherwise(F.col("closed")).alias("prev_closed_after"),
    )
    open_end = steps.filter("is_last").select(
        (F.col("end") + slide).alias("window_end"),
        F.lit(None).cast(reached.schema["arrival"].dataType).alias("closed_after"),
        F.col("closed").alias("prev_closed_after"),
    )
    return materialise(filled.unionByName(open_end), "closings")


def _takes(prev_closed: str, closed: str) -> Column:
    """Whether the row is after the closing point before, and not after this one."""
    return (F.col(prev_closed) < F.col("arrival")) & (
        F.col(closed).isNull() | (F.col("arrival") <= F.col(closed)))


def open_spans(rows: DataFrame, keys: Sequence[str], order: Column, ts_ms: Column, size: int, slide: int,
               closings: DataFrame) -> DataFrame:
    """keys, first_end, last_end: the windows which still took the row on its arrival.

    Closing points never decrease, so these are the windows from some end onwards.
    For a row which all its windows took - nearly all rows, in practice - that is
    its first, and one lookup tells so. Only the others go on: theirs is the one end
    whose closing point is the first not before the row. It is looked up in two
    steps, first the group of ends, then the end in the group, so that 120 windows
    cost 22 lookups. In both steps at most one candidate matches. Rows without an
    open window disappear. The closing points are a written table, so Spark knows
    their size and broadcasts them or not by its own threshold.
    """
    phase = size % slide
    per_group = max(1, math.isqrt(size // slide + 1))
    step, group_step = F.lit(slide).cast("bigint"), F.lit(per_group * slide).cast("bigint")

    def group_of(end: Column) -> Column:
        return align_down(end - phase, per_group * slide) + phase

    groups = closings.groupBy(group_of(F.col("window_end")).alias("group")).agg(
        F.min("prev_closed_after").alias("prev_group_closed"),
        F.when(F.max(F.col("closed_after").isNull()), F.lit(None)).otherwise(F.max("closed_after"))
        .alias("group_closed"))
    first = closings.select(F.col("window_end").alias("own_first"), F.col("closed_after").alias("first_closed"))
    fine = closings.withColumnRenamed("window_end", "first_end")

    spans = rows.select(
        *keys,
        order.alias("arrival"),
        first_window_end(ts_ms, size, slide).alias("own_first"),
        last_window_end(ts_ms, size, slide).alias("last_end"),
    )
    if slide > size:
        spans = spans.filter("own_first <= last_end")
    all_open = F.col("first_closed").isNull() | (F.col("arrival") <= F.col("first_closed"))
    tagged = spans.join(first, "own_first", "left")
    whole = tagged.filter(all_open).select(*keys, F.col("own_first").alias("first_end"), "last_end")

    second = F.col("own_first") + slide
    candidate_groups = F.when(
        second <= F.col("last_end"), F.sequence(group_of(second), group_of(F.col("last_end")), group_step)
    ).otherwise(F.array().cast("array<bigint>"))
    in_group = tagged.filter(~all_open).select(
        *keys, "arrival", "own_first", "last_end", F.explode(candidate_groups).alias("group")
    ).join(groups, "group").filter(_takes("prev_group_closed", "group_closed"))

    candidate_ends = F.sequence(
        F.greatest(second, "group"), F.least("last_end", F.col("group") + (per_group - 1) * slide), step)
    part = in_group.select(
        *keys, "arrival", "last_end", F.explode(candidate_ends).alias("first_end")
    ).join(fine, "first_end").filter(_takes("prev_closed_after", "closed_after")).select(*keys, "first_end", "last_end")
    return whole.unionByName(part)


def late_rows(rows: DataFrame, order: Column, ts_ms: Column, size: int, slide: int,
              closings: DataFrame) -> DataFrame:
    """Rows that came after all their windows were closed for good, with all their columns."""
    columns = rows.columns
    if slide > size:  # a row between two windows is in none, so none was closed
        rows = rows.filter(first_window_end(ts_ms, size, slide) <= last_window_end(ts_ms, size, slide))
    last = closings.select(F.col("window_end").alias("_last_end"), F.col("closed_after").alias("_closed_after"))
    tagged = rows.withColumn("_last_end", last_window_end(ts_ms, size, slide)).withColumn("_arrival", order)
    return tagged.join(last, "_last_end").filter(F.col("_closed_after") < F.col("_arrival")).select(*columns)


def batch_spans(stream: DataFrame, rows: DataFrame, keys: Sequence[str], order: Column, ts_ms: Column, size: int,
                slide: int, delay: int, after: int, seen_ms: int | None) -> tuple[DataFrame, DataFrame]:
    """The open spans of the rows of one batch of a longer stream, and the closing points inside the batch.

    ``seen_ms`` is the largest event time of all earlier batches. What it has closed is
    closed for the whole batch; a row of the batch closes windows for the rows after it.
    """
    closings = window_closings(stream, order, ts_ms, size, slide, delay, after)
    spans = open_spans(rows, keys, order, ts_ms, size, slide, closings)
    if seen_ms is not None:
        lost = last_end_reached(F.lit(seen_ms - delay - after).cast("bigint"), size, slide)
        spans = spans.withColumn("first_end", F.greatest("first_end", lost + slide)).filter("first_end <= last_end")
    return spans, closings


def batch_late_rows(rows: DataFrame, order: Column, ts_ms: Column, size: int, slide: int, closings: DataFrame,
                    delay: int, after: int, seen_ms: int | None) -> DataFrame:
    """Rows of one batch that all their windows lost, to earlier batches or to earlier rows of this one."""
    if seen_ms is None:
        return late_rows(rows, order, ts_ms, size, slide, closings)
    last = last_window_end(ts_ms, size, slide)
    lost_before = last + after <= F.lit(seen_ms - delay).cast("bigint")
    earlier = rows.filter(lost_before)
    if slide > size:
        earlier = earlier.filter(first_window_end(ts_ms, size, slide) <= last)
    return earlier.unionByName(late_rows(rows.filter(~lost_before), order, ts_ms, size, slide, closings))
