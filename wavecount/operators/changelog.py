"""Insert and delete rows between two snapshots of a result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def net_changes(marked: DataFrame, columns: list[str]) -> DataFrame:
    """From rows of the new (``insert`` true) and old snapshot: what came and what is gone.

    One shuffle on the whole row: a row in both snapshots nets to zero.
    """
    net = marked.groupBy(*columns).agg(F.sum(F.when(F.col("insert"), 1).otherwise(-1)).alias("sign"))
    return net.filter(F.col("sign") != 0).select((F.col("sign") > 0).alias("insert"), *columns)


def changelog(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``old`` that are gone (``insert`` false) and rows of ``new`` that came (true).

    Both snapshots have the same columns and no duplicate rows.
    """
    columns = new.columns
    marked = new.withColumn("insert", F.lit(True)).unionByName(old.select(*columns).withColumn("insert", F.lit(False)))
    return net_changes(marked, columns)


def fold(changes: DataFrame, columns: list[str], base: DataFrame | None = None) -> DataFrame:
    """The table that the changes of many batches lead to, from the rows of ``base``.

    ``changes`` has ``insert``, ``batch_id`` and ``columns``. A batch that is there twice
    counts once. A delete of a row that is not in the table, or an insert of one that is,
    means that a batch is missing or out of order: it raises an error.
    """
    steps = changes.select("batch_id", *columns, "insert").distinct()
    net = steps.groupBy("batch_id", *columns).agg(F.sum(F.when(F.col("insert"), 1).otherwise(-1)).alias("step"))
    if base is not None:
        net = net.unionByName(base.select(F.lit(-1).cast("bigint").alias("batch_id"), *columns, F.lit(1).cast("bigint").alias("step")))
    history = Window.partitionBy(*columns).orderBy("batch_id")
    there = F.sum("step").over(history.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = net.select(*columns, "batch_id", there.alias("there"), F.lead("batch_id").over(history).isNull().alias("last"))
    problem = F.concat(F.lit("batch "), F.col("batch_id"), F.when(F.col("there") < 0, " deletes a row that is not there: ").otherwise(
        " inserts a row that is there: "), F.to_json(F.struct(*columns)))
    checked = F.when(F.col("there").between(0, 1), F.col("there")).otherwise(F.raise_error(problem))
    return after.withColumn("there", checked).filter((F.col("there") == 1) & F.col("last")).select(*columns)
