"""Hourly volume: all records of each hour under one name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavecount.functions.eventtime import HOUR
from wavecount.operators.filters import keep_behavior
from wavecount.operators.windows import tumbling_counts

# The name of the total and its window.
METRIC = "pv"
SIZE = 1 * HOUR


def page_views(rows: DataFrame, size: int = SIZE, behavior: str | None = None) -> DataFrame:
    """metric, window_end, cnt; counts every behaviour unless one is named."""
    if behavior is not None:
        rows = keep_behavior(rows, behavior)
    counts = tumbling_counts(rows, [], F.unix_millis("ts"), size)
    return counts.select(F.lit(METRIC).alias("metric"), "window_end", "cnt")
