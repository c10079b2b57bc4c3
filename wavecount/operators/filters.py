"""Row filters on behaviour records and page requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The behaviour and the requests that count.
VIEW_BEHAVIOR = "pv"
PAGE_METHOD = "get"
STATIC_SUFFIX = r"\.(css|js|jpg|png|ico)$"


def is_behavior(behavior: str = VIEW_BEHAVIOR) -> Column:
    """Case matters; null is not kept."""
    return F.col("behavior") == behavior


def is_page_request() -> Column:
    """A GET request, in any case, whose url does not end in a static-file suffix."""
    return (F.lower("method") == PAGE_METHOD) & ~F.col("url").rlike(STATIC_SUFFIX)


def keep_behavior(rows: DataFrame, behavior: str = VIEW_BEHAVIOR) -> DataFrame:
    """Rows of one behaviour."""
    return rows.filter(is_behavior(behavior))


def keep_page_requests(rows: DataFrame) -> DataFrame:
    """Requests for pages."""
    return rows.filter(is_page_request())


def keep_above_watermark(rows: DataFrame, condition: Column) -> DataFrame:
    """A filter on a watermarked stream that lets dropped rows still move the watermark.

    The optimizer moves a filter below the watermark unless it reads the event time,
    and then only kept rows would count for it. The comparison is true of every time.
    """
    return rows.filter(F.when(F.unix_micros("ts") >= -(2**63), condition))
