"""The ``events`` table seen as behaviour records, log lines and out-of-order arrivals.

All are plain column expressions over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavecount.functions.eventtime import utc_instant, utc_millis
from wavecount.operators.lateness import arrival_order
from wavecount.sources import behavior
from wavecount.sources.access_log import TIME_FORMAT

VIEW = "view"
DROP_MS = 3 * 86_400_000
DENSE_DROP_MS = 40 * 60_000
SUFFIXES = ("", ".html", ".css", ".js", ".png", ".PNG")


def order() -> Column:
    return arrival_order(F.col("arrival_ms"), F.col("event_id"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _k() -> Column:
    return F.regexp_extract("props", r"(\d+)", 1).cast("bigint")


def behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour records with their time in whole seconds; views are ``pv``."""
    seconds = F.floor(utc_millis(F.col("ts")) / F.lit(1000)).cast("bigint")
    return events(spark, sf_dir).select(
        F.col("event_id").alias("user_id"),
        F.col("user_id").alias("item_id"),
        _k().cast("int").alias("category_id"),
        F.when(F.col("event_type") == "view", "pv").otherwise(F.col("event_type")).alias("behavior"),
        seconds.alias("ts_sec"),
        F.timestamp_seconds(seconds).alias("ts"),
    )


def item_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, behavior, ts of every event, and an arrival up to 99 minutes later.

    Columns are only renamed, so that filters reach the scan; the behaviour to
    count is ``VIEW``.
    """
    return events(spark, sf_dir).select(
        F.col("user_id").alias("item_id"),
        F.col("event_type").alias("behavior"),
        utc_instant(F.col("ts")).alias("ts"),
        (utc_millis(F.col("ts")) + _k() * 60_000).alias("arrival_ms"),
    )


def _method() -> Column:
    kind = F.col("event_type")
    return F.when(kind.isin("view", "click"), "GET").when(kind == "signup", "get").otherwise("POST")


def _url() -> Column:
    suffix = F.element_at(F.array(*map(F.lit, SUFFIXES)), (F.pmod(_k(), F.lit(6)) + 1).cast("int"))
    return F.concat(F.lit("/u/"), F.col("user_id") % 20, suffix)


def _line(local_time: Column) -> Column:
    return F.concat_ws(" ", F.lit("10.0.0.1"), F.lit("-"), F.lit("-"), F.date_format(local_time, TIME_FORMAT),
                       F.lit("+0000"), _method(), _url())


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One access-log line per event."""
    return events(spark, sf_dir).select(_line(F.col("ts")).alias("value"), "event_id")


def rolled_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines whose days, months, hours, minutes and seconds lie outside their ranges for most events."""
    fields = F.format_string(
        "%d/%d/%d:%d:%d:%d", F.col("event_id") % 64 - 1, F.col("event_id") % 29 - 2, F.lit(2012) + _k() % 9,
        F.col("user_id") % 30, _k() % 70, F.col("user_id") % 90)
    return events(spark, sf_dir).select(
        F.concat_ws(" ", F.lit("10.0.0.1"), F.lit("-"), F.lit("-"), fields, F.lit("+0000"), _method(), _url()).alias("value"),
        "event_id")


def very_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, ts_ms, arrival_ms: arrivals up to 99 minutes after the event."""
    ms = utc_millis(F.col("ts"))
    return events(spark, sf_dir).select(
        "event_id", ms.alias("ts_ms"), (ms + _k() * 60_000).alias("arrival_ms"))


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page, ts_ms, arrival_ms, event_id: time runs a hundred times faster, arrivals overtake."""
    ms = F.floor(utc_millis(F.col("ts")) / F.lit(100)).cast("bigint")
    return events(spark, sf_dir).select(
        "event_id", (F.col("user_id") % 20).alias("page"), ms.alias("ts_ms"),
        (ms + _k() * 9_000).alias("arrival_ms"))


def dense_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines of the dense recipe, with times in whole seconds, and their arrival."""
    ms = F.floor(utc_millis(F.col("ts")) / F.lit(100)).cast("bigint")
    whole = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.floor(ms / F.lit(1000)).cast("decimal(18,6)"))
    return events(spark, sf_dir).select(
        _line(whole).alias("value"), (ms + _k() * 9_000).alias("arrival_ms"), "event_id")


def dense_log_in_order(spark: SparkSession, sf_dir: str, path: str, files: int = 5) -> None:
    """Write the dense log as text files whose names and lines follow the order of arrival."""
    lines = dense_log_lines(spark, sf_dir).repartitionByRange(files, "arrival_ms", "event_id")
    lines.sortWithinPartitions("arrival_ms", "event_id").select("value").write.text(path)


def _drop(arrival_ms: Column, drop_ms: int) -> Column:
    return F.floor(arrival_ms / F.lit(drop_ms)).cast("bigint").alias("drop")


def behavior_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour lines in order of time, in drops of three days."""
    rows = behaviors(spark, sf_dir)
    return rows.select(behavior.behavior_line().alias("value"), _drop(F.col("ts_sec") * 1000, DROP_MS))


def log_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dense log, up to 15 minutes late, in drops of 40 minutes by arrival."""
    return dense_log_lines(spark, sf_dir).select("value", _drop(F.col("arrival_ms"), DENSE_DROP_MS))


def log_drops_in_order(spark: SparkSession, sf_dir: str, drop_ms: int | None = DENSE_DROP_MS) -> DataFrame:
    """The same with the columns that order it; without ``drop_ms`` all in one drop."""
    number = F.lit(0).alias("drop") if drop_ms is None else _drop(F.col("arrival_ms"), drop_ms)
    return dense_log_lines(spark, sf_dir).select("value", number, "arrival_ms", "event_id")


def behavior_drops_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour lines with their drop and the time that orders them."""
    rows = behaviors(spark, sf_dir)
    return rows.select(behavior.behavior_line().alias("value"), _drop(F.col("ts_sec") * 1000, DROP_MS), "ts_sec")
