"""Run an analysis: ``spark-submit wavecount/main.py hot-items --input UserBehavior.csv``.

With ``--input`` the job reads a bounded text file or folder. With ``--follow`` it
follows a folder that keeps receiving text files, with ``--kafka`` and ``--topic`` a
topic; ``--state`` names the folder from which it goes on after a stop. Results are
printed, every row of them, or written below ``--output``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wavecount.operators.ranking import item_report, page_report, top_n
from wavecount.plans.hot_items import hot_items_report
from wavecount.plans.hot_items_sql import hot_items_sql
from wavecount.plans.hot_pages import replay_requests
from wavecount.plans.page_views import page_views
from wavecount.session import build_session, materialise
from wavecount.sources.access_log import parse_access_log
from wavecount.sources.behavior import parse_behavior
from wavecount.sources.lines import (
    FILE_PLACE, KAFKA_PLACE, read_lines, read_lines_in_order, replay_to_kafka, stream_kafka_lines, stream_lines, stream_lines_with_place)
from wavecount.streaming import jobs, live
from wavecount.streaming.sinks import BatchFolder, CommittedFolders, HandOver, OpenSpans, Progress, print_rows


def _emit(result: DataFrame, args: argparse.Namespace, name: str) -> None:
    if args.output:
        result.write.mode("overwrite").parquet(f"{args.output}/{name}")
    else:
        print_rows(result, name, args.rows)


def _behaviors(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return parse_behavior(read_lines(spark, args.input), args.mode)


def _live_lines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.follow:
        return stream_lines(spark, args.follow)
    return stream_kafka_lines(spark, args.kafka, args.topic, args.group)


def _follow(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return parse_behavior(_live_lines(spark, args), args.mode)


def _run(query: StreamingQuery) -> None:
    query.awaitTermination()


def _results(args: argparse.Namespace, name: str, schema: str) -> BatchFolder:
    """Where a stream keeps its results: they are also what it prints."""
    return BatchFolder(f"{args.output or args.state}/{name}", schema)


def _hot_items(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.input:
        _emit(hot_items_report(_behaviors(spark, args), args.n, args.zone), args, "hot items")
    elif args.output:
        out = _results(args, "hot items", jobs.RANKED_ITEMS)
        _run(jobs.stream_hot_items(_follow(spark, args), out, f"{args.state}/checkpoint", args.once, n=args.n))
    else:
        counts = jobs.item_counts_stream(_follow(spark, args))
        _run(jobs.for_each_batch(
            counts, lambda batch, _: print_rows(item_report(top_n(batch, "item_id", args.n), args.zone), "hot items", args.rows),
            "append", f"{args.state}/checkpoint", args.once))


def _hot_items_sql(spark: SparkSession, args: argparse.Namespace) -> None:
    """The ranking of a file, or the changes of a followed ranking."""
    if args.input:
        _emit(hot_items_sql(_behaviors(spark, args), n=args.n), args, "hot items")
        return
    out = _results(args, "hot items changes", jobs.ITEM_CHANGES)
    show = None if args.output else lambda rows, _: print_rows(rows, "hot items changes", args.rows)
    _run(jobs.stream_hot_items_changelog(
        _follow(spark, args), OpenSpans(f"{args.state}/spans", "item_id", "bigint"), Progress(f"{args.state}/progress"), out,
        f"{args.state}/checkpoint", args.once, n=args.n, handle_changes=show))


def _page_views(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.input:
        _emit(page_views(_behaviors(spark, args)), args, "page views")
    elif args.output:
        _run(jobs.stream_page_views(_follow(spark, args), f"{args.output}/page views", f"{args.state}/checkpoint", args.once))
    else:
        _run(jobs.for_each_batch(
            jobs.page_views_counts(_follow(spark, args)), lambda batch, _: print_rows(batch, "page views", args.rows),
            "append", f"{args.state}/checkpoint", args.once))


def _hot_pages(spark: SparkSession, args: argparse.Namespace) -> None:
    """Lines of files arrive in the order of their names and places; a followed folder in that of its batches."""
    if not args.input:
        _follow_hot_pages(spark, args)
        return
    parsed = parse_access_log(read_lines_in_order(spark, args.input), args.mode, args.zone, carry=("place",))
    run = replay_requests(materialise(parsed, "requests"), F.col("place"))  # the text is parsed once
    _emit(page_report(run.top_n_on_time(args.n), args.zone), args, "hot pages")
    _emit(page_report(run.top_n_final(args.n), args.zone), args, "hot pages refined")
    _emit(run.late().drop("place"), args, "late data")


def _follow_hot_pages_by_row(spark: SparkSession, args: argparse.Namespace) -> None:
    """The same, decided row by row in the order of arrival: two streams, the second one batch behind."""
    windows = live.page_windows()
    place = FILE_PLACE if args.follow else KAFKA_PLACE
    lines = (stream_lines_with_place(spark, args.follow) if args.follow
             else stream_kafka_lines(spark, args.kafka, args.topic, args.group, place=True))
    taken, late = HandOver(f"{args.state}/taken", windows.spans), _results(args, "late data", jobs.LATE_REQUESTS)
    out, kept = _results(args, "hot pages", windows.ranked), BatchFolder(f"{args.state}/kept", windows.ranked)
    show_late = None if args.output else lambda rows, _: print_rows(rows, "late data", args.rows)
    first = live.stream_taken(parse_access_log(lines, args.mode, args.zone, carry=place), windows, taken, Progress(f"{args.state}/progress"),
                              f"{args.state}/checkpoint", args.once, place, late, show_late)
    if args.once:
        _run(first)
        taken.finish(spark)
    show = None if args.output else lambda ranked, _: print_rows(page_report(ranked, args.zone), "hot pages", args.rows)
    live.stream_ranking(spark, windows, taken, kept, out, f"{args.state}/ranking", args.once, n=args.n, handle_ranking=show)
    while spark.streams.active:  # an error of either ends the job
        spark.streams.awaitAnyTermination()
        spark.streams.resetTerminated()


def _follow_hot_pages(spark: SparkSession, args: argparse.Namespace) -> None:
    """Rankings, their refinements and late requests of one run."""
    if args.by_row:
        _follow_hot_pages_by_row(spark, args)
        return
    together = CommittedFolders(args.output or args.state, {"hot pages": jobs.RANKED_PAGES, "late data": jobs.LATE_REQUESTS})
    out, late = together["hot pages"], together["late data"]

    def show(ranked: DataFrame, batch_id: int) -> None:
        print_rows(page_report(ranked, args.zone), "hot pages", args.rows)
        print_rows(late.read_batch(spark, batch_id), "late data", args.rows)

    _run(jobs.stream_hot_pages(
        parse_access_log(_live_lines(spark, args), args.mode, args.zone), OpenSpans(f"{args.state}/spans", "url", "string"),
        Progress(f"{args.state}/progress"), out, f"{args.state}/checkpoint", args.once, n=args.n, late=late,
        handle_ranking=None if args.output else show, together=together))


def _replay(spark: SparkSession, args: argparse.Namespace) -> None:
    replay_to_kafka(read_lines(spark, args.input), args.kafka, args.topic)


JOBS = {
    "hot-items": _hot_items,
    "hot-items-sql": _hot_items_sql,
    "page-views": _page_views,
    "hot-pages": _hot_pages,
    "replay": _replay,
}


FILE_JOBS = ("replay",)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--input", help="text file or folder")
    parser.add_argument("--kafka", help="bootstrap servers")
    parser.add_argument("--topic", default="hotItems")
    parser.add_argument("--group", default=None, help="consumer group")
    parser.add_argument("--output", help="folder for the results")
    parser.add_argument("--mode", default="failfast", choices=["failfast", "permissive"])
    parser.add_argument("--zone", default="UTC", help="zone of the log and of the printed times")
    parser.add_argument("--n", type=int, default=5, help="size of the ranking")
    parser.add_argument("--rows", type=int, default=None, help="print only so many rows of each result or batch")
    parser.add_argument("--follow", help="folder that keeps receiving text files")
    parser.add_argument("--state", help="folder of a followed job's progress; below --output if not named")
    parser.add_argument("--by-row", action="store_true", help="hot-pages: decide lateness row by row, not batch by batch")
    parser.add_argument("--once", action="store_true", help="handle what has arrived, then stop")
    args = parser.parse_args(argv)
    if not (args.input or args.follow or args.kafka):
        parser.error("name an --input, a folder to --follow or a --kafka server")
    if args.job in FILE_JOBS and not args.input:
        parser.error(f"{args.job} reads an --input")
    if args.job == "replay" and not args.kafka:
        parser.error("replay writes to a --kafka server")
    args.state = args.state or (args.output and f"{args.output}/state")
    if not args.input and not args.state:
        parser.error("name a --state folder, so that the job can go on after a stop")
    JOBS[args.job](build_session(args.job), args)


if __name__ == "__main__":
    main()
