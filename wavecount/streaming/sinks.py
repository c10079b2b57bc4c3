"""Where streaming results go.

Folders are written per micro-batch and overwritten as a whole, so a batch that is
run again after a failure leaves the same rows behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wavecount.operators.changelog import fold


def labelled(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` with the name of the output they belong to."""
    return rows.select(F.lit(label).alias("output"), *rows.columns)


def print_rows(rows: DataFrame, label: str | None = None, limit: int | None = None) -> None:
    """Print every row, or the first ``limit``; the driver holds one partition at a time."""
    shown = rows if limit is None else rows.limit(limit)
    for row in shown.toLocalIterator():
        text = ",".join("" if value is None else str(value) for value in row)
        print(f"{label}> {text}" if label else text)


def console(rows: DataFrame, output_mode: str = "append", label: str | None = None) -> DataStreamWriter:
    """A writer that prints all rows of every batch of a stream."""
    return rows.writeStream.outputMode(output_mode).foreachBatch(lambda batch, _: print_rows(batch, label))


class BatchFolder:
    """Results of a stream, one sub-folder per micro-batch."""

    def __init__(self, path: str, schema: str):
        self.path = path
        self.schema = schema

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows so far with their ``batch_id``."""
        schema = f"{self.schema}, batch_id bigint"
        return spark.read.schema(schema).option("basePath", self.path).parquet(f"{self.path}/batch_id=*")

    def read_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.path}/batch_id={batch_id}")

    def forget(self, spark: SparkSession, batch_id: int) -> None:
        """Remove the rows of a batch that no later one reads."""
        if batch_id >= 0:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch_id={batch_id}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class CommittedFolders:
    """Outputs of one stream, by label, whose rows of a micro-batch appear together or not at all.

    The outputs of a batch are written first; an empty file with its number then commits
    all of them, and readers take batches up to the newest such file. What a batch has
    left that was stopped before is not seen and is overwritten when it runs again; a
    batch that is repeated after its commit is left as it is. A stream that starts again
    from nothing needs folders of its own: an older batch than the newest is an error.
    """

    def __init__(self, path: str, schemas: dict[str, str]):
        self._commits = f"{path}/_commits"
        self._outputs = {label: _Committed(f"{path}/{label}", schema, self) for label, schema in schemas.items()}

    def __getitem__(self, label: str) -> BatchFolder:
        return self._outputs[label]

    def _files(self, spark: SparkSession):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._commits)
        return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def newest(self, spark: SparkSession) -> int | None:
        """The last batch that is committed; all before it are."""
        path, files = self._files(spark)
        if not files.exists(path):
            return None
        return max((int(f.getPath().getName()) for f in files.listStatus(path)), default=None)

    def done(self, spark: SparkSession, batch_id: int) -> bool:
        """Whether this batch is a repeat of the committed one."""
        newest = self.newest(spark)
        if newest is not None and batch_id < newest:
            raise ValueError(f"batch {batch_id} after batch {newest}: these outputs belong to another run")
        return newest == batch_id

    def commit(self, spark: SparkSession, batch_id: int) -> None:
        path, files = self._files(spark)
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        files.create(where(path, str(batch_id)), True).close()
        for status in files.listStatus(path):  # the newest is enough
            if int(status.getPath().getName()) < batch_id:
                files.delete(status.getPath(), False)


class _Committed(BatchFolder):
    """One output of several that are committed together."""

    def __init__(self, path: str, schema: str, together: CommittedFolders):
        super().__init__(path, schema)
        self._together = together

    def read(self, spark: SparkSession) -> DataFrame:
        newest = self._together.newest(spark)
        if newest is None:
            return spark.createDataFrame([], f"{self.schema}, batch_id bigint")
        return super().read(spark).filter(F.col("batch_id") <= newest)


class Progress:
    """The largest event time up to each micro-batch, carried from batch to batch.

    Kept for the batch that may be repeated and the one before it.
    """

    def __init__(self, path: str):
        self._folder = BatchFolder(path, "max_ts_ms bigint")

    def before(self, spark: SparkSession, batch_id: int) -> int | None:
        """The largest event time of all earlier batches; one number."""
        return self._folder.read_batch(spark, batch_id - 1).first()[0] if batch_id else None

    def advance(self, rows: DataFrame, ts_ms: str, batch_id: int) -> int | None:
        """Record and return the largest event time including this batch."""
        spark = rows.sparkSession
        earlier = F.lit(self.before(spark, batch_id)).cast("bigint")
        self._folder.write(rows.agg(F.greatest(F.max(ts_ms), earlier).alias("max_ts_ms")), batch_id)
        self._folder.forget(spark, batch_id - 2)
        return self._folder.read_batch(spark, batch_id).first()[0]


class OpenSpans:
    """Counts per key and span of windows that may still be ranked, as of each micro-batch.

    A batch reads the version of the batch before it and writes its own, merged and
    without the spans whose last window is past; the version that a repeat of this
    batch needs is the only other one kept.
    """

    def __init__(self, path: str, key: str, key_type: str):
        self.key = key
        self.schema = f"{key} {key_type}, first_end bigint, last_end bigint, n bigint"
        self._folder = BatchFolder(path, self.schema)

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return self._folder.read_batch(spark, batch_id - 1) if batch_id else spark.createDataFrame([], self.schema)

    def add(self, spans: DataFrame, batch_id: int, still_needed: Column) -> DataFrame:
        """All spans including those of this batch; of them the needed ones are kept for the next."""
        spark = spans.sparkSession
        merged = self.before(spark, batch_id).unionByName(spans).groupBy(self.key, "first_end", "last_end").agg(
            F.sum("n").alias("n"))
        self._folder.write(merged.filter(still_needed), batch_id)
        self._folder.forget(spark, batch_id - 2)
        return merged


class HandOver:
    """Results of one stream as the input of another, each batch once.

    A batch is written aside and moved to where the other stream reads when the next one
    begins, for only then is it known to be done; a batch that is repeated before that
    replaces its rows. ``finish`` moves what a stopped stream has left.
    """

    def __init__(self, path: str, schema: str):
        self.schema = schema
        self._aside = BatchFolder(f"{path}/aside", schema)
        self._ready = f"{path}/ready"

    def write(self, rows: DataFrame, batch_id: int) -> None:
        self._move(rows.sparkSession, batch_id - 1)
        self._aside.write(rows, batch_id)

    def _move(self, spark: SparkSession, batch_id: int) -> None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        source = path(f"{self._aside.path}/batch_id={batch_id}")
        files = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path(self._ready))
        if files.exists(source):
            files.rename(source, path(f"{self._ready}/batch_id={batch_id}"))

    def finish(self, spark: SparkSession) -> None:
        """Hand over the last batch of a stream that has stopped without an error."""
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        files = path(self._aside.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if files.exists(path(self._aside.path)):
            for status in files.listStatus(path(self._aside.path)):
                self._move(spark, int(status.getPath().getName().partition("=")[2]))

    def end(self, rows: DataFrame) -> None:
        """Hand over what is left, and ``rows`` after it. Only for input that has ended."""
        self.finish(rows.sparkSession)
        rows.write.mode("overwrite").parquet(f"{self._ready}/batch_id=end")

    def stream(self, spark: SparkSession, max_files_per_trigger: int | None = None) -> DataFrame:
        spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._ready).getFileSystem(
            spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._ready))
        reader = spark.readStream.schema(self.schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.parquet(f"{self._ready}/*")


class FoldedChanges:
    """A table kept up to date from insert and delete rows: a snapshot and the changes since.

    ``changes`` holds ``insert`` and ``columns`` by batch. A snapshot is written by
    ``compact``; it makes the changes up to its batch, and older snapshots, unnecessary.
    """

    def __init__(self, path: str, columns: list[str], changes: BatchFolder):
        self.columns = columns
        self.changes = changes
        row = ", ".join(f for f in changes.schema.split(", ") if f.split()[0] in columns)
        self._snapshots = BatchFolder(path, row)

    def _newest(self, spark: SparkSession) -> int | None:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._snapshots.path)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(path):
            return None
        done = [f.getPath() for f in files.listStatus(path)
                if files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
        return max((int(p.getName().partition("=")[2]) for p in done), default=None)

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of the table as of the last batch."""
        newest = self._newest(spark)
        if newest is None:
            return fold(self.changes.read(spark), self.columns)
        since = self.changes.read(spark).filter(F.col("batch_id") > newest)
        return fold(since, self.columns, self._snapshots.read_batch(spark, newest))

    def compact(self, spark: SparkSession) -> None:
        """Fold all changes so far into a snapshot and remove them, the newest batch excepted: it may be repeated."""
        last = self.changes.read(spark).agg(F.max("batch_id")).first()[0]
        newest = self._newest(spark)
        if last is None or (newest is not None and last - 1 <= newest):
            return
        upto = last - 1
        base = None if newest is None else self._snapshots.read_batch(spark, newest)
        since = self.changes.read(spark).filter((F.col("batch_id") > (-1 if newest is None else newest)) & (F.col("batch_id") <= upto))
        if upto >= 0:
            self._snapshots.write(fold(since, self.columns, base), upto)
            for batch_id in range(0 if newest is None else newest + 1, upto + 1):
                self.changes.forget(spark, batch_id)
            if newest is not None:
                self._snapshots.forget(spark, newest)
