"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_PROVIDERS = "org.apache.spark.sql.execution.streaming.state."
_ROCKSDB = f"{_PROVIDERS}RocksDBStateStoreProvider"


def build_session(app_name: str = "wavecount", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on.

    Leave ``shuffle_partitions`` unset on a cluster: adaptive execution coalesces
    from ``spark.sql.shuffle.partitions``, which belongs to the cluster's own
    configuration.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(_PROVIDER, _ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def with_column_families(spark: SparkSession) -> Iterator[None]:
    """A query started inside has a state store with column families, as ``transformWithState`` needs.

    Spark's default store has none; a session that names another keeps it. A query takes
    its settings when it starts, so the session has its own again afterwards.
    """
    default = f"{_PROVIDERS}HDFSBackedStateStoreProvider"
    named = spark.conf.get(_PROVIDER)
    if named != default:
        yield
        return
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, named)


def shared_dir(spark: SparkSession) -> str:
    """The folder which all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session may fall back to a temporary folder; on a cluster a
    missing setting is an error, as no machine-local folder would survive the
    loss of an executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="wavecount-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def new_workdir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


_held = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that this thread materialises inside are removed at the end; whatever reads them has to have run by then."""
    before, _held.paths = getattr(_held, "paths", None), []
    try:
        yield
    finally:
        mine, _held.paths = _held.paths, before
        for path in mine:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def ship_package(spark: SparkSession) -> None:
    """Python workers import this package from where the driver did; with ``--py-files`` they have it anyway."""
    root, known = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(":"):
        known["PYTHONPATH"] = ":".join(filter(None, [known.get("PYTHONPATH"), root]))


def materialise(df: DataFrame, label: str = "table", keep: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back; with ``keep`` it outlasts a ``scratch``.

    Later stages start from the written rows, whatever executors are lost, read
    only the columns they need, and are planned with the table's real size.
    """
    spark = df.sparkSession
    path = new_workdir(spark, label)
    df.write.parquet(path)
    if not keep and getattr(_held, "paths", None) is not None:
        _held.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)
