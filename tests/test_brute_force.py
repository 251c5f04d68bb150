"""Operators against plain Python on small random inputs, hot keys included."""

import math
import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from txscore.functions import age_in_years, distance_km
from txscore.operators.balance import cluster_means, slot_sums
from txscore.operators.labels import label_index
from txscore.operators.latest import latest_by_key
from txscore.operators.offsets import max_offset_per_partition
from pyspark.ml.functions import array_to_vector, vector_to_array


@pytest.fixture
def rng():
    return random.Random(7)


def test_distance(spark, rng):
    def angle_between(a, b, c, d):
        """By the dot product of unit vectors: another formula than the one under test."""
        points = []
        for lat, lon in ((a, b), (c, d)):
            lat, lon = math.radians(lat), math.radians(lon)
            points.append(
                (math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat))
            )
        p, q = points
        cross = (
            p[1] * q[2] - p[2] * q[1], p[2] * q[0] - p[0] * q[2], p[0] * q[1] - p[1] * q[0]
        )
        return math.atan2(math.hypot(*cross), sum(x * y for x, y in zip(p, q)))

    rows = [
        (rng.uniform(-90, 90), rng.uniform(-180, 180), rng.uniform(-90, 90), rng.uniform(-180, 180))
        for _ in range(500)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    found = df.select("*", distance_km(*[F.col(c) for c in "abcd"]).alias("km")).collect()
    for r in found:
        assert r["km"] == pytest.approx(6371 * angle_between(*r[:4]), abs=0.011)


def test_age(spark, rng):
    start = date(1930, 1, 1)
    rows = [
        (start + timedelta(rng.randrange(40_000)), start + timedelta(rng.randrange(40_000)))
        for _ in range(500)
    ]
    df = spark.createDataFrame(rows, "born date, at date")
    for r in df.select("*", age_in_years(F.col("born"), F.col("at")).alias("age")).collect():
        assert r["age"] == int((r["at"] - r["born"]).days / 365)


def hot_words(rng, n):
    return ["hot" if rng.random() < 0.34 else f"w{rng.randrange(n // 4)}" for _ in range(n)]


def test_label_index(spark, rng):
    words = hot_words(rng, 2_000)
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "s string").repartition(5)
    expected = sorted(Counter(words).items(), key=lambda p: (-p[1], p[0]))
    found = label_index(df, ["s"]).orderBy("label_index").collect()
    assert [(r["label"], r["n"]) for r in found] == expected
    assert [r["label_index"] for r in found] == list(range(len(expected)))


def test_latest(spark, rng):
    rows = [(w, rng.randrange(10_000), i) for i, w in enumerate(hot_words(rng, 2_000))]
    expected = {}
    for key, at, i in rows:
        expected[key] = max(expected.get(key, (-1, -1)), (at, i))
    df = spark.createDataFrame(rows, "k string, at int, i int").repartition(5)
    newest = latest_by_key(df, "k", F.col("at").desc(), F.col("i").desc()).collect()
    assert {r["k"]: (r["at"], r["i"]) for r in newest} == expected
    assert len(newest) == len(expected)


def test_max_offsets(spark, rng):
    rows = [(rng.choice([0, 0, 0, 1, 2]), rng.randrange(10**12)) for _ in range(1_000)]
    df = spark.createDataFrame(rows, "partition int, offset long")
    expected = {p: max(o for q, o in rows if q == p) for p in {p for p, _ in rows}}
    assert dict(max_offset_per_partition(df).collect()) == expected


def test_means_and_sums(spark, rng):
    rows = [(w, [rng.uniform(-5, 5) for _ in range(3)]) for w in hot_words(rng, 400)]
    df = spark.createDataFrame(rows, "k string, xs array<double>").select(
        "k", array_to_vector("xs").alias("features")
    )
    groups = defaultdict(list)
    for key, xs in rows:
        groups[key].append(xs)
    sums = {k: [sum(c) for c in zip(*v)] for k, v in groups.items()}
    means = cluster_means(df, "k").select("k", "n", vector_to_array("features").alias("m"))
    for r in means.collect():
        assert r["n"] == len(groups[r["k"]])
        assert r["m"] == pytest.approx([x / r["n"] for x in sums[r["k"]]])
    for r in slot_sums(df, "k", ["features"]).collect():
        assert r["total"] == pytest.approx(sums[r["k"]][r["slot"]])
