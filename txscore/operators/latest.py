"""Last write wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# the number of the commit that stored a row
SEQUENCE = "sequence"


def latest_by_key(df: DataFrame, key: str | list[str], *newest_first: Column) -> DataFrame:
    """One row per key, the first in the given order; the order must be total to be repeatable.

    Spark keeps the first row of each key in every task before the shuffle, so a key with many
    copies sends one row per task.
    """
    order = Window.partitionBy(key).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")


def latest_scored(stored: DataFrame, *more: str) -> DataFrame:
    """One row per transaction number (and `more`) of stored payments: the last write wins.

    Later is what was committed later, then the higher batch; ties go by the other columns, so that
    the choice repeats. Rows without a number have no key and all stay.
    """
    key = "transaction_number"
    first = [c for c in (SEQUENCE, "batch_id") if c in stored.columns]
    order = [*first, *[c for c in stored.columns if c not in (key, *first, *more)]]
    keyed = latest_by_key(
        stored.filter(F.col(key).isNotNull()), [key, *more], *[F.col(c).desc() for c in order]
    )
    return keyed.unionByName(stored.filter(F.col(key).isNull()))
