"""The physical plans that make the queries scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from checks import inputs
from wavecount.operators.windows import sliding_counts
from wavecount.plans import hot_items, hot_items_sql


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


LLM = driver.llm.queries() if driver.llm else {}
WRITE_FIRST = ("replay_lines", "hot_pages_from_files")
BATCH = [name for name in driver.queries() if not name.startswith("stream_") and name not in WRITE_FIRST and name not in LLM]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_pairwise_joins(spark, sf_dir, name):
    text = plan(driver.queries()[name](spark, sf_dir))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(driver.queries()["hot_items_topn"](spark, sf_dir))
    assert "EqualTo(event_type,view)" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


@pytest.mark.parametrize("name", ["hot_items_topn", "hot_items_topn_sql", "hot_items_topn_two_step", "hot_items_topn_hop", "hot_pages_topn"])
def test_rank_is_cut_before_the_shuffle(spark, sf_dir, name):
    text = plan(driver.queries()[name](spark, sf_dir))
    assert re.search(r"row_number\(\), 5, Partial", text) and re.search(r"row_number\(\), 5, Final", text)


def test_hourly_volume_is_one_partially_combined_aggregate(spark, sf_dir):
    text = plan(driver.queries()["page_views_hourly"](spark, sf_dir))
    assert "partial_count" in text and text.count("hashpartitioning") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz>" in text


def test_sliding_counts_shuffle_changes_and_not_windows(spark, sf_dir):
    counts = sliding_counts(inputs.dense(spark, sf_dir), ["page"], F.col("ts_ms"), 600_000, 5_000)
    text = plan(counts)
    unrolled = text.index("explode(sequence")
    assert text.count("Arguments: hashpartitioning") == 2
    assert text.rindex("Arguments: hashpartitioning") < unrolled


def test_replay_neither_sorts_nor_shuffles_the_rows(spark, sf_dir):
    late = driver.queries()["late_events"](spark, sf_dir)
    text = plan(late)
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text and "rangepartitioning" not in text


def test_changelog_reads_the_table_once(spark, sf_dir):
    text = plan(driver.queries()["hot_items_changelog"](spark, sf_dir))
    assert text.count("Scan parquet") == text.count("(1) Scan parquet") + 1 or text.count("\nLocation:") == 1


def test_the_table_function_makes_no_row_per_window_before_the_shuffle(spark, sf_dir):
    text = plan(driver.queries()["hot_items_topn_hop"](spark, sf_dir))
    assert "Expand" not in text and "Join" not in text
    assert text.rindex("partial_count") < text.index("explode(sequence")
    assert "EqualTo(event_type,view)" in text


@pytest.mark.parametrize("slide, size", [("5' minute", "1' hour"), ("7' second", "60' second"), ("1' day", "1' day"), ("3' hour", "1' hour")])
def test_the_table_function_counts_as_the_operator_does(spark, sf_dir, slide, size):
    rows = inputs.item_events(spark, sf_dir)
    hop = hot_items_sql.register_hop(rows)
    got = spark.sql(f"select * from {hop}('view', interval '{slide}, interval '{size})")
    millis = [spark.sql(f"select unix_millis(timestamp'1970-01-01 00:00:00Z' + interval '{t})").first()[0] for t in (size, slide)]
    want = hot_items.item_counts(rows, *millis, behavior="view")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 < got.count()
