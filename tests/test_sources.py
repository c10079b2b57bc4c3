from __future__ import annotations

import pytest

from wavecount.session import build_session, materialise, new_workdir, shared_dir
from wavecount.sources.lines import (
    kafka_sink_options,
    kafka_source_options,
    read_lines,
    replay_to_files,
    replay_to_kafka,
    stream_kafka_lines,
    stream_lines,
)


def test_replayed_lines_come_back(spark, tmp_path):
    lines = spark.createDataFrame([("a,b",), ("c d",), ("",)], "value string")
    replay_to_files(lines, str(tmp_path / "inbox"))
    replay_to_files(lines, str(tmp_path / "inbox"))
    assert sorted(r[0] for r in read_lines(spark, str(tmp_path / "inbox")).collect()) == ["", "", "a,b", "a,b", "c d", "c d"]


def test_streamed_lines_have_one_string_column(spark, tmp_path):
    (tmp_path / "inbox").mkdir()
    live = stream_lines(spark, str(tmp_path / "inbox"), max_files_per_trigger=1)
    assert live.isStreaming and live.dtypes == [("value", "string")]


def test_kafka_options():
    assert kafka_source_options("host:9092", "hotItems", "consumer-item") == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "hotItems",
        "startingOffsets": "latest", "kafka.group.id": "consumer-item"}
    assert "kafka.group.id" not in kafka_source_options("host:9092", "hotItems")
    assert kafka_sink_options("host:9092", "hotItems") == {"kafka.bootstrap.servers": "host:9092", "topic": "hotItems"}


def test_kafka_without_connector_is_a_clear_error(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        stream_kafka_lines(spark, "host:9092", "hotItems")
    with pytest.raises(Exception, match="(?i)kafka"):
        replay_to_kafka(spark.createDataFrame([("a",)], "value string"), "host:9092", "hotItems")


def test_shared_dir_is_the_one_of_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_workdir(spark, "x") != new_workdir(spark, "x")


def test_materialised_table_keeps_rows_and_schema(spark):
    table = materialise(spark.range(10).selectExpr("id", "cast(id as decimal(38,0)) as d"))
    assert table.dtypes == [("id", "bigint"), ("d", "decimal(38,0)")] and table.count() == 10


def test_session_settings(spark):
    assert build_session().conf.get("spark.sql.session.timeZone") == "UTC"
