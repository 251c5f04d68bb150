import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.plans import executed
from txscore.llm import neighbours, topk
from txscore.llm.vectors import distinct_rows

ROWS = "vec_id long, embedding array<float>, score int, block string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in vectors], ROWS)


def found(result):
    out = {}
    for r in sorted(result.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def brute(vectors, queries, k, measure):
    fine = [(i, v) for i, v in vectors if i is not None and measure(v, v) is not None]
    out = {}
    for q in queries:
        own = min((v for i, v in fine if i == q), default=None)
        if own is not None:
            hits = sorted((-measure(own, v), i) for i, v in fine if i != q)
            out[q] = [(i, -less) for less, i in hits[:k]]
    return {q: hits for q, hits in out.items() if hits}


def floors(a, b):
    return sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(a, b, strict=False))


ODD = [
    (None, [1.0, 2.0]),
    (60, None),
    (61, [1.0, None]),
    (62, [float("nan"), 1.0]),
    (63, [float("inf"), 1.0]),
    (64, []),
    (66, [0.0, -0.0, 0.0]),
]


@pytest.fixture(scope="module")
def rows():
    dice = np.random.default_rng(5)
    plain = [(i, [float(x) for x in dice.normal(size=6).astype("f4")]) for i in range(150)]
    copies = [(200 + i, plain[0][1]) for i in range(40)]
    short = [(300, plain[3][1][:2]), (301, plain[3][1][:2]), (301, plain[3][1][:2])]
    return plain + copies + short


def test_top_k_equals_brute_force(spark, rows):
    def measure(a, b):
        try:
            return floors(a, b)
        except (TypeError, ValueError, OverflowError):
            return None

    queries = [i for i, _ in rows if i % 5 == 0] + [60, 65]
    result = topk.top_k(
        table(spark, rows + ODD), F.col("vec_id") % 5 == 0, 7, block_rows=60
    )
    assert found(result) == brute(rows + [ODD[5], ODD[6]], sorted(set(queries)), 7, measure)


def test_top_k_of_huge_components(spark):
    vectors = [(0, [3e38, 1.0]), (1, [1.0, 1.0]), (2, [-3e38, 0.0]), (3, [1e9, 1e9])]
    got = found(topk.top_k(table(spark, vectors), F.col("vec_id") == 3, 5))
    top = 2**63
    assert got == {3: [(0, top - 1), (1, 2 * 256 * 256 * 10**9), (2, -top)]}


@pytest.mark.parametrize("k", [1, 3, 40])
def test_bounds_never_lose_a_place(k):
    dice = np.random.default_rng(k)
    vectors = np.floor(dice.normal(size=(300, 5)) * dice.choice([1, 50], size=(1, 5)) * 8)
    queries = np.floor(dice.normal(size=(20, 5)) * 8)
    queries[0] = 0
    for query, able in zip(queries, topk.read_lists(queries, vectors, k), strict=True):
        scores = vectors @ query
        assert set(np.flatnonzero(scores > np.sort(scores)[-k])) <= set(able)
        assert np.sort(scores[able])[-k:].tolist() == np.sort(scores)[-k:].tolist()


def test_lists_are_not_read_to_the_end_where_scores_are_apart():
    vectors = np.outer(np.arange(1000.0), np.ones(4))
    (able,) = topk.read_lists(np.ones((1, 4)), vectors, 5)
    assert 5 <= len(able) <= topk.FEW * 5


def test_nearest_equals_brute_force_where_all_is_verified(spark, rows):
    def measure(a, b):
        if a is None or not any(a) or not all(x is not None and math.isfinite(x) for x in a):
            return None
        return math.fsum(x * y for x, y in zip(a, b, strict=False))

    queries = sorted({i for i, _ in rows if i % 5 == 0})
    result = neighbours.nearest(
        table(spark, rows + ODD), F.col("vec_id") % 5 == 0, 9, certainty=1.1, block_rows=70
    )
    assert found(result) == brute(rows, queries, 9, measure)


def test_nearest_stops_early_and_keeps_its_promise():
    dice = np.random.default_rng(1)
    centres = dice.normal(size=(60, 32))
    vectors = np.repeat(centres, 60, axis=0) + dice.normal(size=(3600, 32)) * 0.2
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    order, leaves = neighbours.build_index(vectors)
    vectors = vectors[order]
    queries = centres + dice.normal(size=centres.shape) * 0.2
    scores, _ = neighbours.visit(queries, vectors, leaves, 20, 0.9)
    assert np.isfinite(scores).mean() < 0.6
    truth = queries @ vectors.T
    best = np.argsort(-truth, axis=1)[:, :20]
    assert np.isfinite(np.take_along_axis(scores, best, axis=1)).mean() >= 0.9


def test_chi_square():
    # fixed values: quantiles of 8 degrees of freedom
    for x, p in ((2.733, 0.05), (7.344, 0.5), (15.507, 0.95), (1e9, 1.0)):
        assert abs(neighbours.chi_square_cdf(np.array([x]), 8)[0] - p) < 1e-3


def test_kd_leaves_hold_every_row_once():
    points = np.random.default_rng(2).normal(size=(1000, neighbours.PROJECTIONS))
    order, starts = neighbours.kd_order(np.vstack([points, points[:1].repeat(300, 0)]))
    assert sorted(order) == list(range(1300))
    assert starts[-1] == 1300 and np.diff(starts).max() <= neighbours.LEAF_ROWS


def test_distinct_rows_keep_ids_ascending():
    matrix = np.array([[1.0, 2], [0, 0], [1, 2], [0, 0]])
    vectors, ids, starts = distinct_rows(matrix, np.array([9, 4, 2, 3]))
    groups = {tuple(v): ids[a:b].tolist() for v, a, b in zip(vectors, starts, starts[1:])}
    assert groups == {(1.0, 2.0): [2, 9], (0.0, 0.0): [3, 4]}


def test_empty_tables(spark):
    empty = table(spark, [])
    assert topk.top_k(empty, F.col("vec_id") >= 0, 3).count() == 0
    assert neighbours.nearest(empty, F.col("vec_id") >= 0, 3).count() == 0
    assert topk.top_k(table(spark, [(1, [1.0])]), F.col("vec_id") >= 0, 3).count() == 0


def test_own_rows_take_no_place(spark):
    def whole(a, b):
        return sum(int(x) * int(y) for x, y in zip(a, b, strict=True))

    tied = [(50, [4.0, 1.0])] * 2 + [(i, [4.0, 1.0]) for i in range(101, 106)]
    copied = [(55, [1.0, 6.0])] * 6 + [(i, [1.0, 6.0]) for i in (10, 56, 57, 58, 59, 61, 62)]
    several = [(60, [7.0, 7.0 + i]) for i in range(12)] + [(200 + i, [1.0 + i % 2, 2.0]) for i in range(400)]
    many = [(300 + i, [float(i % 20), float(i // 20)]) for i in range(100)]
    vectors = tied + copied + several + many
    table_of = table(spark, vectors)
    is_query = F.col("vec_id").isin(50, 55, 60)
    wanted = brute(vectors, [50, 55, 60], 5, whole)
    assert found(topk.top_k(table_of, is_query, 5, scale=1)) == wanted
    assert found(neighbours.nearest(table_of, is_query, 5, certainty=1.1)) == wanted
    # alone, the last of the ties has no other row to hide behind
    assert [i for i, _ in found(topk.top_k(table(spark, tied), is_query, 5))[50]] == [101, 102, 103, 104, 105]


@pytest.mark.parametrize("search", ["top_k", "nearest"])
def test_blocks_of_queries_are_not_broadcast(spark, search):
    """Before, they were where they looked small, with a copy for each block of candidates."""
    df = table(spark, [(i, [float(i % 7), float(i % 11)]) for i in range(200)])
    run = topk.top_k if search == "top_k" else neighbours.nearest
    result = run(df, F.col("vec_id") % 50 == 0, 3, block_rows=16)
    plan = executed(result)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
