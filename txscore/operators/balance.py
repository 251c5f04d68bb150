"""Balancing of the two classes before training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txscore.operators.cells import COARSE, two_level_centers
from txscore.operators.features import FEATURES, without_slot_names

WEIGHT = "weight"
KMEANS_ITERATIONS = 30
# how a centre weighs: by the rows it stands for, or as one row
BY_ROWS, AS_ONE = "rows", "one"
_UNIT_BITS = 53


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, n, weight) for labels 0 and 1: both classes end up with the smaller one's weight."""
    both = Window.partitionBy()
    return (
        df.filter(F.col(label).isin(0, 1))
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn(WEIGHT, F.min("n").over(both) / F.col("n"))
    )


def class_sizes(df: DataFrame, label: str = "label") -> dict[int, int]:
    """Rows of class 0 and 1; two rows reach the driver."""
    found = df.filter(F.col(label).isin(0, 1)).groupBy(label).count().collect()
    return both_present({0: 0, 1: 0} | {int(row[label]): row["count"] for row in found})


def both_present(sizes: dict[int, int]) -> dict[int, int]:
    if not all(sizes.values()):
        raise ValueError(f"training needs rows of both classes, found {sizes}")
    return sizes


def _share_kept(sizes: dict[int, int]) -> Column:
    smaller = min(sizes.values())
    return F.when(F.col("label") == 1, smaller / sizes[1]).otherwise(smaller / sizes[0])


def _unit(key: str, seed: int) -> Column:
    """A number from 0 up to 1 that only depends on the key and the seed."""
    bits = F.xxhash64(F.col(key), F.lit(seed)).bitwiseAND((1 << _UNIT_BITS) - 1)
    return bits / float(1 << _UNIT_BITS)


def bounded(
    df: DataFrame, sizes: dict[int, int], key: str, max_rows: int, seed: int = 42
) -> tuple[DataFrame, dict[int, int]]:
    """At most about `max_rows` rows, chosen by a hash of the key, and their expected class sizes.

    Class 1 comes first and is thinned only if it alone is larger.
    """
    ones = min(sizes[1], max_rows)
    zeros = min(sizes[0], max(1, max_rows - ones))
    if (zeros, ones) == (sizes[0], sizes[1]):
        return df, sizes
    share = F.when(F.col("label") == 1, ones / sizes[1]).otherwise(zeros / sizes[0])
    return df.filter(_unit(key, seed + 1) < share), {0: zeros, 1: ones}


def weighted(df: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """Keep all rows and weight the larger class down."""
    return df.withColumn(WEIGHT, _share_kept(sizes))


def undersampled(df: DataFrame, sizes: dict[int, int], key: str, seed: int = 42) -> DataFrame:
    """Keep the smaller class and a share of the larger one, chosen by a hash of the key."""
    return df.filter(_unit(key, seed) < _share_kept(sizes))


def cluster_centers(
    features: DataFrame, k: int, max_iter: int = KMEANS_ITERATIONS, seed: int = 42
) -> DataFrame:
    """(cluster, n, features): the mean of the rows nearest each centre, and how many they are.

    There can be fewer than k, when fewer distinct rows exist. One fit compares every row with
    every centre in each round and keeps the centres on the driver, so more than `COARSE` of them
    are found in two levels, where no row meets all and the driver sees about sqrt(k).
    """
    if k > COARSE:
        return two_level_centers(features.select(FEATURES), k, max_iter, seed)
    model = KMeans(k=max(2, k), maxIter=max_iter, seed=seed, predictionCol="cluster").fit(
        features.select(FEATURES)
    )
    return cluster_means(model.transform(features.select(FEATURES)), "cluster")


def cluster_means(df: DataFrame, cluster: str, features: str = FEATURES) -> DataFrame:
    """(cluster, n, features): mean vector per cluster, with partial sums before the shuffle."""
    return df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col(features)).alias(features)
    )


def clustered(
    minority: DataFrame, centers: DataFrame, minority_size: int, weigh: str = BY_ROWS
) -> DataFrame:
    """(features, label, weight): all rows of class 1, and centres in place of class 0.

    `rows`: a centre weighs by the rows it stands for, so that both classes have the same total.
    `one`: every row and every centre weighs 1.
    """
    if weigh not in (BY_ROWS, AS_ONE):
        raise ValueError(f"unknown weight of centres: {weigh}")
    by_size = F.col("n") * F.lit(float(minority_size)) / F.sum("n").over(Window.partitionBy())
    majority = centers.select(
        FEATURES,
        F.lit(0).alias("label"),
        (by_size if weigh == BY_ROWS else F.lit(1.0)).alias(WEIGHT),
    )
    positives = minority.select(FEATURES, F.lit(1).alias("label"), F.lit(1.0).alias(WEIGHT))
    return without_slot_names(positives).unionByName(without_slot_names(majority))


def slot_sums(df: DataFrame, group: str, vectors: Sequence[str]) -> DataFrame:
    """(group, vector, slot, total): vectors summed slot by slot within a group."""
    sums = df.groupBy(group).agg(*[Summarizer.sum(F.col(v)).alias(v) for v in vectors])
    parts = F.explode(
        F.array(*[
            F.struct(F.lit(v).alias("vector"), vector_to_array(F.col(v)).alias("slots"))
            for v in vectors
        ])
    )
    return sums.select(group, parts.alias("part")).select(
        group, F.col("part.vector").alias("vector"), F.posexplode("part.slots").alias("slot", "total")
    )
