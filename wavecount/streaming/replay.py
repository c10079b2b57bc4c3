"""Feed a bounded table to a streaming query as files that arrive one drop after another."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wavecount.sources.lines import stream_lines, stream_lines_with_place


def replay_in_drops(lines: DataFrame, drop: str, inbox: str, start: Callable[[DataFrame], StreamingQuery],
                    order: Sequence[str | Column] = (), parts: int = 1, with_place: bool = False) -> StreamingQuery:
    """Hand the lines of each drop to one run of a query, a micro-batch for each drop.

    ``drop`` numbers the drops in order of arrival; lines of a drop arrive in the given
    ``order``. All drops are written at once, as ``parts`` files each (one, where there
    is an order) whose times rise from drop to drop, which is the order in which Spark
    reads files: the file system has to keep such times. ``start`` gets the streamed
    lines, with their place if wanted, and starts the query with ``available_now``.
    """
    spark = lines.sparkSession
    part = F.lit(0) if order or parts == 1 else F.pmod(F.xxhash64("value"), F.lit(parts)).cast("int")
    placed = lines.withColumn("part", part).withColumnRenamed(drop, "drop").repartition("drop", "part")
    placed = placed.sortWithinPartitions("drop", "part", *order).select("value", "drop", "part")
    placed.write.partitionBy("drop", "part").text(inbox)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(inbox).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    numbers = sorted(int(f.getPath().getName().partition("=")[2]) for f in files.listStatus(path(inbox)) if f.isDirectory())
    first = int(time.time() * 1000) - len(numbers) * 1000
    for k, number in enumerate(numbers):
        for p in range(parts):
            folder = path(f"{inbox}/drop={number}/part={p}")
            if not files.exists(folder):  # a drop has so many files in any case
                files.create(path(folder, "part-empty.txt")).close()
            for file in files.listStatus(folder):
                if file.getPath().getName().startswith("part-"):
                    files.setTimes(file.getPath(), first + k * 1000, -1)
    reader = stream_lines_with_place if with_place else stream_lines
    live = reader(spark, f"{inbox}/*/*", max_files_per_trigger=parts)
    query = start(live if with_place else live.select("value"))
    query.awaitTermination()
    return query
