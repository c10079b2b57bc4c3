"""Small helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavecount.session import materialise, new_workdir

#: Rows handled at once inside a task; keeps copies of long texts small.
SLICE = 256


def visible_to_workers(spark: SparkSession) -> None:
    """Python workers import this package from where the driver did; with ``--py-files`` they have it anyway."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(":"):
        known["PYTHONPATH"] = ":".join(filter(None, [known.get("PYTHONPATH"), root]))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text alone, null texts as empty ones; clashing extra columns are gone."""
    return docs.select(F.col(key).alias(key), F.coalesce(F.col(text), F.lit("")).alias(text))


def held_out(key: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string")), F.lit(5)) == 0, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: Keys that more than one of so many rows share are looked up by broadcast; there are no more of them than this.
HOT_KEYS = 1_024


def look_up(rows: DataFrame, found: DataFrame, key: str, weight: str) -> DataFrame:
    """Columns of ``found`` beside all ``rows``, null where there are none; null keys match.

    ``found`` is a written table with one row for each key and its number of rows in
    column ``weight``. Keys of more than one row in ``HOT_KEYS`` are at most ``HOT_KEYS``
    keys: they are broadcast, and their rows stay where they are. The shuffled rest has
    no key with more rows than that share.
    """
    total = found.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) * F.lit(HOT_KEYS).cast("decimal(38,0)") > F.lit(total)
    new = [c for c in found.columns if c != key]
    found = found.withColumnRenamed(key, "_key")
    hot = found.where(is_hot).withColumn("_hot", F.lit(True))
    tagged = rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_key")), "left")
    rest = tagged.where(F.col("_hot").isNull()).select(*rows.columns)
    rest = rest.join(found.where(~is_hot), F.col(key).eqNullSafe(F.col("_key")), "left")
    return tagged.where("_hot").select(*rows.columns, *new).unionByName(rest.select(*rows.columns, *new))


#: Octets of bitmaps of rows that are broadcast at a time.
WAVE = 32 << 20
_BITMAP = 4_096


def in_files(docs: DataFrame) -> DataFrame:
    """``docs`` itself, if its rows have places in Parquet files; else a written copy."""
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
        return docs
    except AnalysisException:
        return materialise(docs, "documents", keep=True)


def with_places(docs: DataFrame) -> DataFrame:
    """``docs`` of ``in_files`` with the place of each row: ``_file``, a hash of the file's path, and ``_line`` in it."""
    place = docs.metadataColumn("_metadata")
    return docs.select(*[docs[c] for c in docs.columns], F.xxhash64(place["file_path"]).alias("_file"), place["row_index"].alias("_line"))


def without_rows(docs: DataFrame, rows: DataFrame, wave: int = WAVE) -> DataFrame:
    """``docs`` of ``in_files`` without the rows at the places (``_file``, ``_line``) in ``rows``; no row of ``docs`` is moved.

    The places become a bitmap for each 32,768 rows of a file. They are broadcast, in
    waves of files whose bitmaps are at most ``wave`` octets together (or those of one
    file); each file is read in one wave, and with several waves the result is written.
    """
    spark = docs.sparkSession
    bucket, position = F.expr("bitmap_bucket_number(_line + 1)"), F.expr("bitmap_bit_position(_line + 1)")
    maps = rows.groupBy("_file", bucket.alias("_bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(_line + 1))").alias("_bitmap"))
    maps = materialise(maps, "bitmaps", keep=True).withColumnRenamed("_file", "_of")
    waves = 1
    while True:
        load = maps.groupBy(F.pmod("_of", F.lit(waves)).alias("wave")).agg(
            (F.count("*") * _BITMAP).alias("octets"), F.countDistinct("_of").alias("files"))
        if not load.where((F.col("octets") > wave) & (F.col("files") > 1)).limit(1).collect():
            break
        waves *= 2
    octet = F.conv(F.hex(F.substring("_bitmap", (F.shiftright(position, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    marked = F.coalesce(F.getbit(octet, F.pmod(position, F.lit(8)).cast("int")) == 1, F.lit(False))

    def of_wave(k: int) -> DataFrame:
        path = docs.metadataColumn("_metadata")["file_path"]
        mine = docs if waves == 1 else docs.where(F.pmod(F.xxhash64(path), F.lit(waves)) == k)  # Spark lists these files alone
        bitmaps = F.broadcast(maps.where(F.pmod("_of", F.lit(waves)) == k))
        joined = with_places(mine).join(bitmaps, (F.col("_file") == F.col("_of")) & (bucket == F.col("_bucket")), "left")
        return joined.where(~marked).select(*docs.columns)

    if waves == 1:
        return of_wave(0)
    out = new_workdir(spark, "kept")
    for k in range(waves):
        of_wave(k).write.mode("append").parquet(out)
    return spark.read.schema(docs.schema).parquet(out)
