"""Exact top-k by inner product of integer vectors, by reading sorted lists only as deep as needed.

Each block of candidates has one list per component, sorted by value; a query with a positive
component reads it from the top, with a negative one from the bottom. In rounds of growing depth
every candidate gets a lower and an upper bound of its score: what was read counts in full, the
rest between the list's end and the value at the present depth. The search stops for a query
as soon as no more than a few candidates can reach the k-th best lower bound, and only those get
their score in full. At full depth the bounds are the scores.

Cases: vectors that are null or hold a null or non-finite component take no part, nor do null ids;
an empty or zero vector has the score 0 with everything. Vectors of unequal length count as ended
by zeros. Rows that share the query's id are the query's own; a repeated query id is one query, and
of differing vectors the least counts. Ties go to the smaller id, and repeated candidate ids come
once per row. With fewer than k candidates all are given. Scores outside 64 bits become the nearest
64-bit number. An empty table gives an empty result, and other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame

from txscore.llm.vectors import (
    HITS,
    best_ids,
    block_count,
    blocks,
    counted,
    grid,
    one_per_id,
    only_own,
    query_rows,
    ranked,
    unpack,
    vector_rows,
    widened,
)

# share of each list that a round has read
DEPTHS = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 5 / 8, 3 / 4, 7 / 8, 1.0)
# so many candidates for each of the k places are few enough to be scored in full
FEW = 4
# largest whole number up to which all are exact in a double
EXACT = 2.0**53
QUERY_ROWS = 512  # queries whose bounds are held at once


def floored(matrix: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(matrix * scale) + 0.0


def depth_bounds(
    queries: np.ndarray, vectors: np.ndarray, places: np.ndarray, lists: np.ndarray, depth: int
) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bound of every score, after `depth` entries of every list.

    `lists` has each component's values from high to low, `places` where each vector stands.
    """
    n = len(vectors)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    both = np.hstack([up, down])
    from_top, from_bottom = places < depth, places >= n - depth
    high, low, least, most = lists[depth - 1], lists[n - depth], lists[-1], lists[0]
    upper = np.hstack([(vectors - high) * from_top, (vectors - low) * from_bottom])
    lower = np.hstack([(vectors - least) * from_top, (vectors - most) * from_bottom])
    return (
        both @ lower.T + (up @ least + down @ most)[:, None],
        both @ upper.T + (up @ high + down @ low)[:, None],
    )


def read_lists(
    queries: np.ndarray, vectors: np.ndarray, k: int, own: np.ndarray | None = None
) -> list[np.ndarray]:
    """For each query the rows of `vectors` that can be among its k best, `own` ones not counted."""
    n, width = vectors.shape
    if n <= k or not width:
        return [np.arange(n)] * len(queries)
    order = np.argsort(-vectors, axis=0, kind="stable")
    lists = np.take_along_axis(vectors, order, axis=0)
    places = np.empty_like(order)
    np.put_along_axis(places, order, np.arange(n)[:, None], axis=0)
    found: list = [None] * len(queries)
    open_rows = np.arange(len(queries))
    for share in DEPTHS:
        lower, upper = depth_bounds(
            queries[open_rows], vectors, places, lists, max(1, int(np.ceil(share * n)))
        )
        if own is not None:
            lower[own[open_rows]] = upper[own[open_rows]] = -np.inf
        least = np.partition(lower, n - k, axis=1)[:, n - k]
        able = upper >= least[:, None]
        done = np.ones(len(open_rows), bool) if share == 1.0 else able.sum(1) <= FEW * k
        for i in np.flatnonzero(done):
            found[open_rows[i]] = np.flatnonzero(able[i])
        open_rows = open_rows[~done]
        if not len(open_rows):
            break
    return found


def exact_scores(query: np.ndarray, vectors: np.ndarray) -> list[int]:
    """Whole-number inner products, whatever their size."""
    if np.abs(query).max(initial=0) * np.abs(vectors).max(initial=0) * max(1, len(query)) < EXACT:
        return [int(x) for x in vectors @ query]
    values = [int(x) for x in query]
    top = 2**63
    return [
        min(top - 1, max(-top, sum(a * int(b) for a, b in zip(values, row, strict=True))))
        for row in vectors
    ]


def best_of_block(
    q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, starts: np.ndarray,
    vectors: np.ndarray, k: int,
) -> Iterator[tuple[int, int, int]]:
    width = max(queries.shape[1], vectors.shape[1])
    queries, vectors = widened(queries, width), widened(vectors, width)
    most = np.abs(vectors).max(initial=0) * max(1, width)
    for at in range(0, len(queries), QUERY_ROWS):
        part = queries[at : at + QUERY_ROWS]
        # vectors that belong to the query alone take no place; beyond exact doubles bounds could
        # be off, so there every vector is scored
        if np.abs(part).max(initial=0) * most * 4 < EXACT:
            own_rows = only_own(q_ids[at : at + QUERY_ROWS], ids, starts)
            able = read_lists(part, vectors, k, own_rows)
        else:
            able = [np.arange(len(vectors))] * len(part)
        for own, query, rows in zip(q_ids[at:], part, able, strict=False):
            scores = exact_scores(query, vectors[rows])
            for vec_id, score in best_ids(int(own), rows, scores, ids, starts, k):
                yield int(own), vec_id, score


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int,
    *,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block_rows: int = 4096,
) -> DataFrame:
    """Columns query_id, rank, vec_id, score: the k best candidates of each query row.

    Components become floor(scale * x). Candidates are all rows but the query's own. Each block
    of candidates meets each block of queries once and sends on k rows per query.
    """
    rows = counted(vector_rows(df, id_column, vector_column))
    queries = one_per_id(vector_rows(df.filter(is_query), id_column, vector_column))
    n_blocks, n_queries = block_count(rows, block_rows), block_count(queries, block_rows)

    def prepare(matrix: np.ndarray) -> np.ndarray:
        return floored(matrix, scale)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                hits = best_of_block(
                    *query_rows(row), unpack(row.ids), unpack(row.starts), unpack(row.vectors), k
                )
                yield pd.DataFrame(hits, columns=["query_id", "vec_id", "score"])

    cells = grid(
        blocks(rows, n_blocks, k + 1, prepare),
        n_blocks,
        blocks(queries, n_queries, 1, prepare),
        n_queries,
    )
    return ranked(cells.mapInPandas(search, HITS.format("long")), k)
