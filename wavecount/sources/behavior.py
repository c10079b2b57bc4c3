"""Behaviour records: five comma-separated fields without header or quoting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavecount.sources.parsing import FAILFAST, keep_valid, parsed_fields

SEPARATOR = ","
#: Seconds that a timestamp has room for, either way from 1970.
TIME_LIMIT = 9_000_000_000_000


def parse_behavior(lines: DataFrame, mode: str = FAILFAST, carry: tuple[str, ...] = ()) -> DataFrame:
    """``value`` -> user_id, item_id, category_id, behavior, ts_sec, ts.

    ``ts_sec`` is in epoch seconds. Fields after the fifth are ignored. Columns named in
    ``carry`` are passed on unchanged.
    """
    fields = lines.select("value", *carry, F.split("value", SEPARATOR).alias("f"))
    parsed = fields.select("value", *carry, parsed_fields(
        F.get("f", F.lit(0)).try_cast("bigint").alias("user_id"),
        F.get("f", F.lit(1)).try_cast("bigint").alias("item_id"),
        F.get("f", F.lit(2)).try_cast("int").alias("category_id"),
        F.get("f", F.lit(3)).alias("behavior"),
        F.get("f", F.lit(4)).try_cast("bigint").alias("ts_sec"),
    ))
    valid = (
        F.col("user_id").isNotNull() & F.col("item_id").isNotNull() & F.col("category_id").isNotNull()
        & F.col("behavior").isNotNull() & F.col("ts_sec").between(-TIME_LIMIT, TIME_LIMIT)
    )
    in_range = F.greatest(F.least("ts_sec", F.lit(TIME_LIMIT)), F.lit(-TIME_LIMIT))  # other rows are gone or stop the job
    return keep_valid(parsed, valid, F.col("value"), mode).select(
        *carry, "user_id", "item_id", "category_id", "behavior", "ts_sec",
        F.timestamp_seconds(in_range).alias("ts"),
    )


def behavior_line() -> Column:
    """The inverse of ``parse_behavior``, for replaying a table as lines."""
    return F.concat_ws(SEPARATOR, "user_id", "item_id", "category_id", "behavior", "ts_sec")


def render_behavior(rows: DataFrame) -> DataFrame:
    """Behaviour records as lines ``value``."""
    return rows.select(behavior_line().alias("value"))
