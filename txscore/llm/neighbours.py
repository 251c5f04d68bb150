"""Approximate nearest neighbours by inner product, over a few stable projections in a kd-tree.

Largest inner product becomes nearest distance: every vector of a block gets one more component so
that all have the block's largest norm, and the query is scaled to that norm. Gaussian projections
onto a few dimensions keep distances in distribution: projected over true squared distance follows
chi-square with that many degrees of freedom. The projected points lie in the leaves of a kd-tree;
for each query leaves are visited in the order of their projected distance and their points
are verified on the original vectors. A query stops when a point nearer than its present k-th would
already have been met with the asked probability, given the projected distance reached.

Cases: vectors that are null, zero, empty or hold a null or non-finite component take no part, nor
do null ids. Vectors of unequal length count as ended by zeros. Rows that share the query's id
are the query's own; a repeated query id is one query, and of differing vectors the least counts.
Ties go to the smaller id, and repeated candidate ids come once per row. With fewer than k
candidates all are given. An empty table gives an empty result, and other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

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

PROJECTIONS = 8  # an even number
LEAF_ROWS = 32
SEED = 7
# by so much, relative to the norms, matrix products may differ from correctly rounded sums
ROUNDING = 1e-12


def chi_square_cdf(x: np.ndarray, degrees: int) -> np.ndarray:
    """Of an even number of degrees of freedom."""
    half = np.minimum(np.asarray(x, float) / 2, 700.0)
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def projection(width: int) -> np.ndarray:
    """Drawn component by component, so that vectors of any width share its first rows."""
    return np.random.default_rng(SEED).standard_normal((width + 1, PROJECTIONS))


def lifted(vectors: np.ndarray) -> tuple[np.ndarray, float]:
    """Projections of the vectors, the added component first, and their largest norm."""
    squares = np.einsum("ij,ij->i", vectors, vectors)
    norm = math.sqrt(squares.max(initial=0))
    added = np.sqrt(np.maximum(norm * norm - squares, 0))[:, None]
    return np.hstack([added, vectors]) @ projection(vectors.shape[1]), norm


def kd_order(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the points in which leaves are runs, and the leaves' starts."""
    leaves, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF_ROWS:
            leaves.append(rows)
            continue
        axis = np.ptp(points[rows], axis=0).argmax()
        half = len(rows) // 2
        rows = rows[np.argpartition(points[rows, axis], half)]
        todo += [rows[half:], rows[:half]]
    return np.concatenate(leaves), np.cumsum([0, *map(len, leaves)])


def build_index(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by leaf; for each leaf its start and the corners of its box."""
    points, _ = lifted(vectors)
    order, starts = kd_order(points)
    points = points[order]
    low = np.minimum.reduceat(points, starts[:-1])
    high = np.maximum.reduceat(points, starts[:-1])
    return order, np.hstack([starts[:-1, None], low, high])


def visit(
    queries: np.ndarray, vectors: np.ndarray, leaves: np.ndarray, k: int, certainty: float,
    own: np.ndarray | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the scores of all rows, -inf where not verified or `own`, and the k-th best."""
    _, norm = lifted(vectors)
    lengths = np.sqrt(np.einsum("ij,ij->i", queries, queries))
    projected = (queries * (norm / lengths)[:, None]) @ projection(queries.shape[1])[1:]
    starts = np.append(leaves[:, 0].astype(int), len(vectors))
    low, high = leaves[:, 1 : 1 + PROJECTIONS], leaves[:, 1 + PROJECTIONS :]
    gaps = np.zeros((len(queries), len(leaves)))
    for axis in range(PROJECTIONS):
        at = projected[:, axis, None]
        gaps += np.maximum(np.maximum(low[:, axis] - at, at - high[:, axis]), 0) ** 2
    order = np.argsort(gaps, axis=1)
    scores = np.full((len(queries), len(vectors)), -np.inf)
    kth = np.full(len(queries), -np.inf)
    open_rows, seen, step = np.arange(len(queries)), 0, max(1, -(-4 * k // LEAF_ROWS))
    while len(open_rows) and seen < len(leaves):
        for leaf, members in _by_leaf(order[open_rows, seen : seen + step], open_rows):
            rows = slice(starts[leaf], starts[leaf + 1])
            scores[members, rows] = queries[members] @ vectors[rows].T
        if own is not None:
            scores[own] = -np.inf
        seen, step = seen + step, step + step // 2 + 1
        if len(vectors) >= k:
            kth[open_rows] = np.partition(scores[open_rows], len(vectors) - k, axis=1)[:, -k]
        if seen < len(leaves):
            nearest = 2 * norm * norm - 2 * norm * kth[open_rows] / lengths[open_rows]
            reached = gaps[open_rows, order[open_rows, seen]]
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = np.where(nearest > 0, reached / np.maximum(nearest, 1e-300), np.inf)
            open_rows = open_rows[chi_square_cdf(ratio, PROJECTIONS) < certainty]
    return scores, kth


def _by_leaf(visits: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each leaf of `visits` (a row of leaves per query) with the queries that visit it."""
    flat, who = visits.ravel(), np.repeat(rows, visits.shape[1])
    order = np.argsort(flat, kind="stable")
    flat, who = flat[order], who[order]
    cuts = np.flatnonzero(np.diff(flat)) + 1
    for part in np.split(np.arange(len(flat)), cuts):
        yield int(flat[part[0]]), who[part]


def best_of_block(
    q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, starts: np.ndarray,
    vectors: np.ndarray, leaves: np.ndarray, k: int, certainty: float,
) -> Iterator[tuple[int, int, float]]:
    width = max(queries.shape[1], vectors.shape[1])
    queries, vectors = widened(queries, width), widened(vectors, width)
    top = np.abs(vectors).max(initial=0) * width
    for at in range(0, len(queries), 512):
        part = queries[at : at + 512]
        # vectors that belong to the query alone take no place
        own_rows = only_own(q_ids[at : at + 512], ids, starts)
        scores, kth = visit(part, vectors, leaves, k + 1, certainty, own_rows)
        for own, query, row, least in zip(q_ids[at:], part, scores, kth, strict=False):
            slack = ROUNDING * top * np.abs(query).max()
            chosen = np.flatnonzero(np.isfinite(row) & (row >= least - slack))
            exact = [math.fsum(x) for x in (vectors[chosen] * query).tolist()]
            for vec_id, score in best_ids(int(own), chosen, exact, ids, starts, k):
                yield int(own), vec_id, score


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int,
    *,
    certainty: float = 0.9,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block_rows: int = 4096,
) -> DataFrame:
    """Columns query_id, rank, vec_id, score: the k nearest found of each query row.

    Every row is indexed. `certainty` is the least probability with which a true neighbour has
    been met when a query stops. Each block of candidates meets each block of queries once.
    """
    nonzero = F.exists("vector", lambda x: x != 0)
    rows = counted(vector_rows(df, id_column, vector_column).filter(nonzero))
    queries = one_per_id(
        vector_rows(df.filter(is_query), id_column, vector_column).filter(nonzero)
    )
    n_blocks, n_queries = block_count(rows, block_rows), block_count(queries, block_rows)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                hits = best_of_block(
                    *query_rows(row),
                    unpack(row.ids), unpack(row.starts), unpack(row.vectors), unpack(row.extra),
                    k, certainty,
                )
                yield pd.DataFrame(hits, columns=["query_id", "vec_id", "score"])

    cells = grid(
        blocks(rows, n_blocks, k + 1, index=build_index),
        n_blocks,
        blocks(queries, n_queries, 1),
        n_queries,
    )
    return ranked(cells.mapInPandas(search, HITS.format("double")), k)
