"""Top-N per window and its text report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavecount.functions.eventtime import display_time

TOP_N = 5

# The text of a report.
BANNER = "===================================="
WINDOW_END_LABEL = "窗口结束时间："
RANK_LABEL = "NO "
ITEM_LABEL = " 商品id = "
PAGE_LABEL = " 被访问url = "
HEAT_LABEL = " 热门度 = "


def top_n(counts: DataFrame, key: str, n: int = TOP_N) -> DataFrame:
    """The ``n`` largest counts of each window, equal counts by key ascending.

    Catalyst plans the rank filter as a window group limit: every task keeps its
    own best ``n`` per window ahead of the shuffle, so a full window never moves.
    """
    order = Window.partitionBy("window_end").orderBy(F.desc("cnt"), F.asc(key))
    return counts.select(key, "window_end", "cnt", F.row_number().over(order).alias("row_num")).filter(
        F.col("row_num") <= n)


def _report(ranked: DataFrame, line: Column, tail: str, zone: str) -> DataFrame:
    numbered = F.concat(F.lit(RANK_LABEL), F.col("row_num"), F.lit(":"), line, F.lit("\n"))
    per_window = ranked.groupBy("window_end").agg(
        F.sort_array(F.collect_list(F.struct("row_num", numbered.alias("line")))).alias("lines"))
    head = F.concat(F.lit(BANNER + "\n" + WINDOW_END_LABEL), display_time(F.col("window_end"), zone), F.lit("\n"))
    body = F.array_join(F.col("lines.line"), "")
    return per_window.select("window_end", F.concat(head, body, F.lit(BANNER + tail)).alias("report"))


def item_report(ranked: DataFrame, zone: str = "UTC") -> DataFrame:
    """One text per window of ranked items; ``ranked`` holds at most N rows per window."""
    line = F.concat(F.lit(ITEM_LABEL), F.col("item_id"), F.lit(HEAT_LABEL), F.col("cnt"))
    return _report(ranked, line, "\n\n", zone)


def page_report(ranked: DataFrame, zone: str = "UTC") -> DataFrame:
    """One text per window of ranked pages."""
    line = F.concat(F.lit(HEAT_LABEL), F.col("cnt"), F.lit(PAGE_LABEL), F.col("url"))
    return _report(ranked, line, "\n", zone)
