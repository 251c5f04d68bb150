"""k-means in two levels."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.plans import planned
from txscore.operators import balance, cells

SCHEMA = T.StructType([T.StructField("features", VectorUDT())])


def frame(spark, vectors):
    return spark.createDataFrame([(v,) for v in vectors], SCHEMA)


def points(centers):
    rows = centers.select("n", vector_to_array("features").alias("v")).collect()
    return np.array([r["v"] for r in rows]), np.array([r["n"] for r in rows])


@pytest.fixture(scope="module")
def scattered(spark):
    """1,500 rows, a third of them equal, some vectors full and some with few slots."""
    rng = np.random.default_rng(3)
    places = rng.normal(size=(20, 6)) * 20
    data = [places[i % 20] + rng.normal(size=6) for i in range(800)] + [places[0]] * 500
    vectors = [Vectors.dense(row) for row in data]
    vectors += [Vectors.sparse(6, [int(i % 6)], [float(i)]) for i in range(1, 201)]
    data = np.array([v.toArray() for v in vectors])
    return frame(spark, vectors).repartition(5).cache(), data


@pytest.mark.parametrize("cell_rows", [cells.CELL_ROWS, 20])
def test_centres_are_as_many_as_asked_and_stand_for_all_rows(scattered, cell_rows):
    df, data = scattered
    found, n = points(cells.two_level_centers(df, 300, 10, 1, cell_rows).cache())
    assert len(found) == 300 and n.sum() == len(data) and n.min() >= 1
    # means times rows give back the sums, whatever the cells were
    assert np.allclose((found * n[:, None]).sum(axis=0), data.sum(axis=0))
    # rows that are equal have one centre between them
    assert n.max() >= 500


@pytest.mark.parametrize("cell_rows", [cells.CELL_ROWS, 60])
def test_error_is_near_that_of_one_level(spark, cell_rows):
    """For rows that lie apart evenly; clumps inside a cell are not known when centres are shared."""
    rng = np.random.default_rng(4)
    data = np.column_stack([rng.lognormal(3, 1, 900), rng.uniform(0, 100, 900), rng.integers(0, 2, 900)])
    df = frame(spark, [Vectors.dense(row) for row in data]).cache()

    def error(found):
        return ((data[:, None, :] - found[None]) ** 2).sum(axis=2).min(axis=1).sum()

    two, _ = points(cells.two_level_centers(df, 60, 20, 1, cell_rows))
    one = KMeans(k=60, maxIter=20, seed=1).fit(df).clusterCenters()
    assert error(two) < 1.3 * error(np.array(one))


def test_no_more_centres_than_distinct_rows(spark, scattered):
    df, data = scattered
    found, n = points(cells.two_level_centers(df, 5_000, 5, 1))
    assert len(found) == len({tuple(row) for row in found.tolist()})
    assert {tuple(r) for r in found.round(9).tolist()} == {tuple(r) for r in data.round(9).tolist()}
    assert n.sum() == len(data)


def test_empty_and_single(spark):
    assert cells.two_level_centers(frame(spark, []), 300, 5, 1).count() == 0
    found, n = points(cells.two_level_centers(frame(spark, [Vectors.dense([1.0, 2.0])] * 9), 300, 5, 1))
    assert (found.tolist(), n.tolist()) == ([[1.0, 2.0]], [9])


def test_no_fit_holds_all_centres(spark, scattered, monkeypatch):
    asked = []

    class Watched(KMeans):
        def __init__(self, **options):
            asked.append(options["k"])
            super().__init__(**options)

    monkeypatch.setattr(cells, "KMeans", Watched)
    monkeypatch.setattr(balance, "KMeans", Watched)
    assert balance.cluster_centers(scattered[0], cells.COARSE + 44, 5).count() == cells.COARSE + 44
    assert asked == [18]


@pytest.mark.parametrize("k", [4, 5, 9, 39, 40, 1_000])
def test_shares_are_whole(spark, k):
    sizes = [1, 2, 30, 7]
    rows = [(i, 0, 1 + j % 3, Vectors.dense([float(j * 10**i)])) for i, size in enumerate(sizes) for j in range(size)]
    schema = T.StructType([*T._parse_datatype_string("cell int, part int, n long").fields, *SCHEMA.fields])
    shares = {r["cell"]: r["share"] for r in cells._shares(spark.createDataFrame(rows, schema), k).collect()}
    assert sum(shares.values()) == min(k, sum(sizes))
    assert all(1 <= shares[i] <= size for i, size in enumerate(sizes))


def test_shares_go_where_rows_lie_apart(spark):
    rows = [(i, 0, 1, Vectors.dense([float(j * (1 + 9 * i))])) for i in range(2) for j in range(100)]
    schema = T.StructType([*T._parse_datatype_string("cell int, part int, n long").fields, *SCHEMA.fields])
    shares = {r["cell"]: r["share"] for r in cells._shares(spark.createDataFrame(rows, schema), 22).collect()}
    # one each, the other twenty by one to ten
    assert shares == {0: 2, 1: 20} or shares == {0: 3, 1: 19}


def test_cells_beyond_the_limit_are_cut(spark):
    placed = spark.range(1000).select((F.col("id") >= 900).cast("int").alias("cell"), F.col("id").cast("double").alias("place"))
    parts = cells._parts(placed, 100, 10).groupBy("cell", "part").count().collect()
    assert len([r for r in parts if r["cell"] == 0]) == 9 and len([r for r in parts if r["cell"] == 1]) == 1
    assert max(r["count"] for r in parts) <= 201


def test_lloyd_by_brute_force():
    rng = np.random.default_rng(8)
    data = np.where(rng.random((60, 9)) < 0.4, rng.normal(size=(60, 9)).round(1), 0)
    row, slot = np.nonzero(data)
    table = cells.SparseRows(row, slot, data[row, slot], 60, 9)
    weights = rng.integers(1, 5, 60).astype(float)
    own, means = cells.lloyd(table, weights, 7, 50, np.random.default_rng(1))
    assert set(own) == set(range(7))
    for i in range(7):
        assert np.allclose(means[i], np.average(data[own == i], axis=0, weights=weights[own == i]))
    away = ((data[:, None] - means[None]) ** 2).sum(axis=2)
    assert np.allclose(away[np.arange(60), own], away.min(axis=1))


def test_a_centre_without_rows_gets_the_farthest():
    own, far = np.array([0, 0, 0, 2]), np.array([1.0, 5.0, 3.0, 9.0])
    cells._fill_empty(own, far, 4)
    # the last row stands alone and stays
    assert sorted(own[:3]) == [0, 1, 3] and own[0] == 0 and own[3] == 2


def test_variance_of_parts_equals_that_of_whole_vectors(scattered):
    """Sums of the slots that rows have, in place of a summary that lays all slots out."""
    df, _ = scattered
    rows = df.groupBy("features").agg(F.count(F.lit(1)).alias("n"))
    parts = rows.withColumns({"cell": F.pmod(F.hash("features"), F.lit(5)), "part": F.lit(0)})
    whole = parts.groupBy("cell").agg(Summarizer.variance(F.col("features"), F.col("n")).alias("v"))
    whole = {r["cell"]: sum(r["v"].toArray()) for r in whole.collect()}
    sums = parts.groupBy("cell", "part").agg(
        F.sum("n").alias("rows"), F.sum(F.col("n") * F.col("n")).alias("squared_rows")
    )
    mine = sums.join(cells._moments(parts), ["cell", "part"]).select("cell", cells._variance().alias("v"))
    mine = {r["cell"]: r["v"] for r in mine.collect()}
    assert mine.keys() == whole.keys()
    assert all(mine[c] == pytest.approx(whole[c], rel=1e-9) for c in whole)


def test_wide_vectors_are_folded_for_the_coarse_centres(spark, monkeypatch):
    """Before, every coarse centre was laid out on the driver with all slots, here a million."""
    wide = 1_000_000
    rng = np.random.default_rng(5)
    data = [
        Vectors.sparse(wide, [int(rng.integers(0, 900_000)), wide - 2, wide - 1], [1.0, rng.normal(), rng.uniform(0, 90)])
        for _ in range(900)
    ]
    seen = []

    class Watched(KMeans):
        def fit(self, dataset, params=None):
            seen.append(dataset.select(self.getFeaturesCol()).first()[0].size)
            return super().fit(dataset, params)

    monkeypatch.setattr(cells, "KMeans", Watched)
    found = cells.two_level_centers(frame(spark, data), 40, 5, 1).collect()
    assert seen == [cells.COARSE_SLOTS]
    assert len(found) == 40 and sum(r["n"] for r in found) == 900
    assert {r["features"].size for r in found} == {wide}
    total = sum(float(r["features"][wide - 1]) * r["n"] for r in found)
    assert total == pytest.approx(sum(float(v[wide - 1]) for v in data))
    slots = {int(i): 0.0 for r in found for i in r["features"].indices}
    assert slots.keys() == {int(i) for v in data for i in v.indices}


def test_centres_are_found_once(scattered):
    """Before, each pass of a forest over the centres clustered every part again."""
    df, _ = scattered
    plan = planned(cells.two_level_centers(df, 300, 3, 1))
    assert "FlatMapGroupsInPandas" not in plan


@pytest.mark.parametrize("n_slots", [40, 9])
def test_products_by_slots_equal_those_of_full_rows(n_slots):
    """Before, every row was laid out with all slots of its part."""
    rng = np.random.default_rng(3)
    data = np.zeros((50, n_slots))
    data[np.arange(50), rng.integers(1, n_slots - 1, 50)] = rng.choice([1.0, 2.5], 50)
    data[1:, -1] = rng.random(49)
    data[7] = 0
    row, slot = np.nonzero(data)
    table = cells.SparseRows(row, slot, data[row, slot], 50, n_slots)
    assert (table.few is not None) == (n_slots == 40)
    if table.few:
        table.full = None  # not called
    centres = rng.random((6, n_slots))
    own, far = table.nearest(centres)
    apart = ((data[:, None] - centres) ** 2).sum(axis=2)
    assert (own == apart.argmin(axis=1)).all() and np.allclose(far, apart.min(axis=1))


def test_parts_are_spread_over_tasks(scattered, monkeypatch):
    """Before, adaptive execution put parts of little data, but much work, into a few tasks."""
    df, _ = scattered
    tasks = []
    plain = type(df).checkpoint

    def seen(rows, *args):
        out = plain(rows, *args)
        if "cluster" in rows.columns:
            tasks.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(type(df), "checkpoint", seen)
    assert cells.two_level_centers(df, 49, 3, 1, 20).count() == 49
    assert tasks == [13]
