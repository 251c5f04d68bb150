"""Stream positions as data. Sizes here follow the number of partitions of the topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def max_offset_per_partition(records: DataFrame) -> DataFrame:
    return records.groupBy("partition").agg(F.max("offset").alias("offset"))


# what the source takes for the first and the next record of a partition
EARLIEST, LATEST = -2, -1


def starts_by_partition(
    offsets: DataFrame, partitions: DataFrame, new_start: int = EARLIEST
) -> DataFrame:
    """(partition, start, is_stored) of stored (partition, offset) and of all partitions of the topic.

    Stored is the last offset done, so the start is the one after it. A partition without one was
    added since: nobody has read it, so by default it is read from its first record. One that is
    stored but no longer listed stays, so that the source says it is gone.
    """
    listed = partitions.select("partition").distinct()
    return max_offset_per_partition(offsets).join(listed, "partition", "full").select(
        "partition",
        F.coalesce(F.col("offset") + 1, F.lit(new_start)).alias("start"),
        F.col("offset").isNotNull().alias("is_stored"),
    )


def start_position(
    offsets: DataFrame,
    topic: str,
    partitions: DataFrame | None = None,
    new_start: int = EARLIEST,
) -> DataFrame:
    """One row: where to go on, and which partitions, as the JSON that the source expects.

    `partitions` are those that the topic has now. No row if nothing is stored yet.
    """
    listed = offsets if partitions is None else partitions
    starts = F.sort_array(F.collect_list(F.struct("partition", "start")))
    found = starts_by_partition(offsets, listed, new_start).agg(
        starts.alias("starts"), F.count_if("is_stored").alias("n_stored")
    )
    by_partition = F.map_from_entries(
        F.transform("starts", lambda p: F.struct(p["partition"].cast("string"), p["start"]))
    )
    every = F.transform("starts", lambda p: p["partition"])
    return found.filter("n_stored > 0").select(
        F.to_json(F.create_map(F.lit(topic), by_partition)).alias("starting_offsets"),
        F.to_json(F.create_map(F.lit(topic), every)).alias("assigned"),
    )
