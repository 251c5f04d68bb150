"""Distinct values by frequency, without bringing them to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txscore.session import shared_folder

# monotonically_increasing_id keeps the task number above these bits
_POSITION_BITS = 33


def with_position(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Number the rows 0, 1, 2, ... in a total order, with the sort spread over all tasks.

    Every task numbers its own range; adding the sizes of the ranges before it makes the number
    global. The sorted rows are checkpointed, as sizes and numbers must come from one layout.
    """
    shared_folder(df.sparkSession)
    ranged = (
        df.orderBy(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint()
        .withColumns({
            "_range": F.shiftright("_id", _POSITION_BITS),
            "_place": F.col("_id").bitwiseAND((1 << _POSITION_BITS) - 1),
        })
    )
    # one row per task of the sort, so one task and a broadcast are enough for them
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_range")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    return (
        ranged.join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_id", "_range", "_place", "_start")
    )


def label_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, label, n) without nulls; one pass counts all columns."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("label")) for c in columns])
    )
    return (
        df.select(pairs.alias("pair"))
        .select("pair.*")
        .filter(F.col("label").isNotNull())
        .groupBy("column_name", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def numbered_labels(counts: DataFrame) -> DataFrame:
    """(column_name, label, n, label_index) from label counts: by falling count, then by label."""
    numbered = with_position(
        counts, "_position", F.col("column_name"), F.col("n").desc(), F.col("label")
    )
    # one row per column
    first = numbered.groupBy("column_name").agg(F.min("_position").alias("_first"))
    return numbered.join(F.broadcast(first), "column_name").select(
        "column_name", "label", "n", (F.col("_position") - F.col("_first")).alias("label_index")
    )


def label_index(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, label, n, label_index): index by falling count, then by label.

    One pass counts all columns. Equal to what a fitted string indexer holds, but not bound by
    the driver's memory.
    """
    return numbered_labels(label_counts(df, columns))
