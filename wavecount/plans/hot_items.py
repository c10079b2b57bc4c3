"""Most viewed items: one-hour windows every five minutes, top five of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavecount.functions.eventtime import HOUR, MINUTE, first_window_end, last_window_end
from wavecount.operators.changelog import net_changes
from wavecount.operators.filters import VIEW_BEHAVIOR, keep_behavior
from wavecount.operators.ranking import TOP_N, item_report, top_n
from wavecount.operators.windows import sliding_counts, unroll_spans

# The window of the item ranking.
SIZE = 1 * HOUR
SLIDE = 5 * MINUTE


def item_counts(rows: DataFrame, size: int = SIZE, slide: int = SLIDE,
                behavior: str = VIEW_BEHAVIOR) -> DataFrame:
    """item_id, window_end, cnt of one behaviour; ``rows`` has item_id, behavior, ts."""
    return sliding_counts(keep_behavior(rows, behavior), ["item_id"], F.unix_millis("ts"), size, slide)


def hot_items(rows: DataFrame, n: int = TOP_N, size: int = SIZE, slide: int = SLIDE,
              behavior: str = VIEW_BEHAVIOR) -> DataFrame:
    """item_id, window_end, cnt, row_num: the ``n`` most viewed items of each window."""
    return top_n(item_counts(rows, size, slide, behavior), "item_id", n)


def hot_items_report(rows: DataFrame, n: int = TOP_N, zone: str = "UTC",
                     behavior: str = VIEW_BEHAVIOR) -> DataFrame:
    """window_end and the printed text of each window's ranking."""
    return item_report(hot_items(rows, n, behavior=behavior), zone)


def hot_items_changelog(rows: DataFrame, is_old: Column, n: int = TOP_N,
                        behavior: str = VIEW_BEHAVIOR) -> DataFrame:
    """What the ranking retracts and adds when the input grows from its ``is_old`` rows to all.

    One pass: each span of windows is counted over all rows and over the old ones.
    """
    ts_ms = F.unix_millis("ts")
    spans = keep_behavior(rows, behavior).groupBy(
        "item_id", first_window_end(ts_ms, SIZE, SLIDE).alias("first_end"), last_window_end(ts_ms, SIZE, SLIDE).alias("last_end"),
    ).agg(F.count(F.lit(1)).alias("new"), F.count(F.when(is_old, 1)).alias("old"))
    sides = F.array(F.struct(F.lit(True).alias("insert"), F.col("new").alias("n")),
                    F.struct(F.lit(False).alias("insert"), F.col("old").alias("n")))
    spans = spans.select("item_id", "first_end", "last_end", F.inline(sides)).filter("n > 0")
    counts = unroll_spans(spans, ["insert", "item_id"], SIZE, SLIDE)
    place = Window.partitionBy("insert", "window_end").orderBy(F.desc("cnt"), "item_id")
    ranked = counts.withColumn("row_num", F.row_number().over(place)).filter(F.col("row_num") <= n)
    return net_changes(ranked, ["item_id", "window_end", "cnt", "row_num"])
