"""Vectors dealt into blocks, one row per block, and the grid of query and candidate blocks.

A block holds at most about `size` rows of the table, whatever their ids or values, so a task's
memory does not grow with the table. Equal vectors of a block are kept once, with their ids
ascending, so a vector that half the table shares costs one comparison.
"""

from __future__ import annotations

import io
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "block int, ids binary, starts binary, vectors binary, extra binary"
HITS = "query_id long, vec_id long, score {}"


def pack(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, array, allow_pickle=False)
    return out.getvalue()


def unpack(data: bytes) -> np.ndarray:
    return np.load(io.BytesIO(data), allow_pickle=False)


def usable(vector: Column) -> Column:
    """Not null, and neither null nor non-finite in any component."""
    infinite = F.lit(float("inf")).cast("double")
    fine = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < infinite),
    )
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def vector_rows(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Columns vec_id and vector (doubles) of the rows that take part."""
    return df.filter(F.col(id_column).isNotNull() & usable(F.col(vector_column))).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )


def counted(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their number, so that even a third of the table is no hot block."""
    return rows.groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("copies"))


def one_per_id(queries: DataFrame) -> DataFrame:
    """Repeated query ids are one query; of differing vectors the least one counts."""
    least = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return least.withColumn("copies", F.lit(1))


def block_count(rows: DataFrame, size: int) -> int:
    return max(1, math.ceil(rows.count() / size))


def padded(vectors: list) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out + 0.0  # no negative zeros, so that equal vectors have equal bytes


def widened(matrix: np.ndarray, width: int) -> np.ndarray:
    """Missing components count as zero."""
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def distinct_rows(matrix: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, all ids ordered by their row and then ascending, and where each row's start."""
    if matrix.shape[1] == 0:
        inverse, first = np.zeros(len(ids), np.int64), np.zeros(min(1, len(ids)), np.int64)
    else:
        keys = np.ascontiguousarray(matrix).view(np.dtype((np.void, matrix.shape[1] * 8))).ravel()
        _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    order = np.lexsort((ids, inverse))
    starts = np.searchsorted(inverse[order], np.arange(len(first) + 1))
    return matrix[first], ids[order], starts


def blocks(
    rows: DataFrame,
    count: int,
    keep: int,
    prepare: Callable[[np.ndarray], np.ndarray] = lambda matrix: matrix,
    index: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None,
) -> DataFrame:
    """One row per block: ids, their starts by distinct vector, the vectors, what `index` adds.

    Of equal rows `keep` are enough for any result and no more are unfolded. Rows go to blocks by
    a hash, so a block made anew after a lost executor is the same block.

    `prepare` maps the matrix of a block before equal rows are found; `index` gives an order of
    the distinct rows and an array to keep beside them.
    """

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        matrix = np.ascontiguousarray(prepare(padded(group["vector"].tolist())))
        copies = np.minimum(group["copies"].to_numpy(np.int64), keep)
        ids = np.repeat(group["vec_id"].to_numpy(np.int64), copies)
        vectors, ids, starts = distinct_rows(np.repeat(matrix, copies, axis=0), ids)
        extra = np.zeros(0)
        if index is not None:
            order, extra = index(vectors)
            ids = np.concatenate([ids[starts[i] : starts[i + 1]] for i in order])
            starts = np.concatenate([[0], np.cumsum(np.diff(starts)[order])])
            vectors = vectors[order]
        return pd.DataFrame([(key[0], pack(ids), pack(starts), pack(vectors), pack(extra))])

    place = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(count)).cast("int")
    dealt = rows.withColumn("block", place)
    return dealt.groupBy("block").applyInPandas(build, BLOCK)


def grid(candidates: DataFrame, n_candidates: int, queries: DataFrame, n_queries: int) -> DataFrame:
    """Each candidate block with each query block, spread by both numbers.

    Both sides are shuffled, whatever their estimated size: the planner goes by the blocks before they
    are repeated, and a broadcast would bring all the copies to the driver.
    """
    ours = candidates.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
    theirs = queries.select(
        F.col("block").alias("q_block"),
        F.col("ids").alias("q_ids"),
        F.col("starts").alias("q_starts"),
        F.col("vectors").alias("q_vectors"),
        F.explode(F.sequence(F.lit(0), F.lit(n_candidates - 1))).alias("block"),
    )
    return ours.join(theirs.hint("merge"), ["block", "q_block"])


def query_rows(row) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a query block, equal vectors repeated for each id."""
    starts = unpack(row.q_starts)
    return unpack(row.q_ids), np.repeat(unpack(row.q_vectors), np.diff(starts), axis=0)


def only_own(q_ids: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each query which distinct vectors no other id than its own holds."""
    first, last = ids[starts[:-1]], ids[starts[1:] - 1]
    return (first == last) & (first == q_ids[:, None])


def best_ids(
    own: int, chosen: np.ndarray, scores: list, ids: np.ndarray, starts: np.ndarray, k: int
) -> list[tuple]:
    """The k best of (vec_id, score) among the chosen distinct vectors, without the query's own id."""
    found = []
    for row, score in zip(chosen.tolist(), scores, strict=True):
        first, end = starts[row], starts[row + 1]
        # ids ascend, so the query's own ones, however many, are one run
        low = first + np.searchsorted(ids[first:end], own, "left")
        high = first + np.searchsorted(ids[first:end], own, "right")
        others = np.concatenate([ids[first : min(low, first + k)], ids[high : min(end, high + k)]])
        found += [(-score, vec_id) for vec_id in others[:k].tolist()]
    found.sort()
    return [(vec_id, -less) for less, vec_id in found[:k]]


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """The k best of all blocks for each query; ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
