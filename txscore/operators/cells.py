"""k-means in two levels: coarse centres cut the rows into bounded cells, each clustered in a task."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txscore.operators.features import FEATURES
from txscore.operators.wide import sparse_vector
from txscore.session import shared_folder

# most centres that one fit compares all rows with and keeps on the driver
COARSE = 256
# slots of the vectors it compares: wider ones are folded for it, as centres are laid out in full
COARSE_SLOTS = 4_096
# distinct rows that a task clusters, while the centres are not fewer than one in a quarter of it
CELL_ROWS = 5_000
# numbers of a block of rows laid out in full
_BLOCK_NUMBERS = 1 << 22
# slots a row has to be without, for each that it has, before its products go slot by slot
_FEW = 8
# how fine rows are told apart along the line that cuts a large cell
_STEP = 1e-6

_FOUND = "cluster string, n long, size int, slots array<int>, numbers array<double>"


@F.udf(VectorUDT())
def _folded(vector, size):
    """Slots that are equal modulo the size are added up; rows that share few slots stay as far apart."""
    slots = vector.indices if isinstance(vector, SparseVector) else np.arange(vector.size)
    numbers = np.bincount(slots % size, vector.values, size)
    used = np.flatnonzero(numbers)
    return Vectors.sparse(size, used, numbers[used])


def two_level_centers(
    features: DataFrame, k: int, max_iter: int, seed: int, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """(cluster, n, features): min(k, distinct rows) means of all rows and how many each stands for.

    Equal rows become one with a count, so a vector that most rows share is one row here. About
    sqrt(k) coarse centres cut them into cells; a cell of more than `cell_rows` rows, or four rows
    per centre asked for if that is more, is cut again by quantiles along one line. Every part
    gets its share of the k centres and is clustered in one task. The driver sees at most
    `COARSE` vectors and one count. Without more distinct rows than k each is a centre.
    """
    # the counts below read the rows again and again, also after executors are lost
    shared_folder(features.sparkSession)
    rows = features.groupBy(FEATURES).agg(F.count(F.lit(1)).alias("n")).checkpoint()
    distinct = rows.count()
    if distinct <= k:
        alone = F.monotonically_increasing_id().cast("string")
        return rows.select(alone.alias("cluster"), "n", FEATURES)
    limit = max(cell_rows, math.ceil(4 * distinct / k))
    placed = _cells(rows, min(COARSE, math.ceil(math.sqrt(k))), max_iter, seed).checkpoint()
    parts = _parts(placed, limit, max(1, math.ceil(distinct / limit))).checkpoint()
    vector = F.unwrap_udt(FEATURES)
    shared = parts.join(F.broadcast(_shares(parts, k)), ["cell", "part"]).select(
        "cell", "part", "place", "n", "share",
        vector["size"].alias("size"),
        vector["indices"].alias("slots"),
        vector["values"].alias("numbers"),
    )
    # small rows, but much work in each part: a number of tasks of its own, as a size would leave it to few
    tasks = max(math.ceil(distinct / limit), min(COARSE, math.ceil(math.sqrt(k))))
    found = shared.repartition(tasks, "cell", "part").groupBy("cell", "part").applyInPandas(_fine_centres(max_iter, seed), _FOUND)
    # a forest reads its rows again and again
    found = found.checkpoint()
    return found.select("cluster", "n", sparse_vector("size", "slots", "numbers").alias(FEATURES))


def _cells(rows: DataFrame, coarse: int, max_iter: int, seed: int) -> DataFrame:
    """Every row with its nearest coarse centre and its place along a random line.

    Cells only say which rows are clustered together, so folded vectors do for them.
    """
    compared = FEATURES
    if rows.first()[FEATURES].size > COARSE_SLOTS:
        compared = "folded"
        rows = rows.withColumn(compared, _folded(FEATURES, F.lit(COARSE_SLOTS))).checkpoint()
    fit = KMeans(
        k=max(2, coarse), maxIter=max_iter, seed=seed, weightCol="n", featuresCol=compared, predictionCol="cell"
    ).fit(rows)
    line = BucketedRandomProjectionLSH(
        inputCol=FEATURES, outputCol="line", bucketLength=_STEP, numHashTables=1, seed=seed
    ).fit(rows)
    at = vector_to_array(F.col("line")[0])[0]
    return line.transform(fit.transform(rows)).withColumn("place", at).drop("line", "folded")


def _parts(placed: DataFrame, limit: int, cuts: int) -> DataFrame:
    """Every row with its part of its cell; only cells beyond the limit have more than one."""
    quantiles = [i / cuts for i in range(1, cuts)]
    ends = F.percentile_approx("place", quantiles) if quantiles else F.array().cast("array<double>")
    cells = placed.groupBy("cell").agg(
        F.ceil(F.count(F.lit(1)) / limit).alias("parts"), ends.alias("ends")
    )
    passed = F.size(F.filter("ends", lambda end: end < F.col("place")))
    part = F.floor(passed * F.col("parts") / F.lit(cuts)).cast("int")
    return placed.join(F.broadcast(cells), "cell").withColumn("part", part).drop("ends", "parts")


def _shares(parts: DataFrame, k: int) -> DataFrame:
    """(cell, part, share): how many centres each gets, at least one, in all min(k, rows).

    A part is due centres by its rows and how far they lie from their mean (clumps inside it are not
    known), but no more than it has distinct rows; what that leaves goes to the others by the rows they have left. Running sums
    are rounded down, so that the whole numbers add up.
    """
    sizes = parts.groupBy("cell", "part").agg(
        (F.count(F.lit(1)) - 1).cast("double").alias("more"),
        F.sum("n").alias("rows"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squared_rows"),
    ).join(_moments(parts), ["cell", "part"], "left")
    variance = _variance()
    everything = Window.partitionBy()
    so_far = Window.orderBy("cell", "part").rowsBetween(Window.unboundedPreceding, 0)
    in_all = F.sum("more").over(everything)
    beyond_one = F.least(F.greatest(F.lit(k) - F.count(F.lit(1)).over(everything), F.lit(0)), in_all)
    spread = sizes.withColumn("spread", F.sqrt(F.greatest(variance, F.lit(0.0)) * F.col("rows") * (F.col("more") + 1))).select(
        "cell", "part", "more", beyond_one.alias("rest"),
        (F.col("spread") / F.greatest(F.sum("spread").over(everything), F.lit(1e-300))).alias("portion"),
    )
    asked = spread.withColumn("asked", F.least("more", F.col("rest") * F.col("portion")))
    room = F.col("more") - F.col("asked")
    left = F.col("rest") - F.sum("asked").over(everything)
    filled = left * room / F.greatest(F.sum(room).over(everything), F.lit(1e-300))
    due = asked.withColumn("due", F.col("asked") + filled)
    # a hair more, as sums of fractions may end just below a whole number
    upto = F.floor(F.sum("due").over(so_far) + 1e-6)
    whole = due.select("cell", "part", upto.alias("upto"))
    before = F.lag("upto", 1, 0).over(Window.orderBy("cell", "part"))
    return whole.select("cell", "part", (1 + F.col("upto") - before).cast("int").alias("share"))


def _moments(parts: DataFrame) -> DataFrame:
    """(cell, part, squares, squared_sums) of the numbers, from the slots that rows have.

    A summary of whole vectors would hold every slot of every part.
    """
    vector = F.unwrap_udt(FEATURES)
    slots = F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    entry = F.explode(F.arrays_zip(slots.alias("slot"), vector["values"].alias("number")))
    sums = parts.select("cell", "part", "n", entry.alias("entry")).groupBy("cell", "part", "entry.slot").agg(
        F.sum(F.col("n") * F.col("entry.number")).alias("total"),
        F.sum(F.col("n") * F.col("entry.number") * F.col("entry.number")).alias("square"),
    )
    return sums.groupBy("cell", "part").agg(
        F.sum("square").alias("squares"), F.sum(F.col("total") * F.col("total")).alias("squared_sums")
    )


def _variance() -> Column:
    """Variance of all slots together, with the rows as weights; a row that stands alone has none."""
    rows = F.col("rows").cast("double")
    apart = F.coalesce("squares", F.lit(0.0)) - F.coalesce("squared_sums", F.lit(0.0)) / rows
    free = rows - F.col("squared_rows") / rows
    return F.when(free > 0, apart / free).otherwise(0.0)


def _fine_centres(max_iter: int, seed: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place", kind="stable")
        share, cell, part = (int(group[c].iloc[0]) for c in ("share", "cell", "part"))
        numbers = list(group["numbers"])
        # a full vector names neither slots nor its size
        slots = [
            np.arange(len(v)) if s is None else s for s, v in zip(group["slots"], numbers, strict=True)
        ]
        known = group["size"].dropna()
        size = int(known.iloc[0]) if len(known) else len(numbers[0])
        used, at = np.unique(np.concatenate(slots), return_inverse=True)
        table = SparseRows(
            np.repeat(np.arange(len(numbers)), [len(v) for v in numbers]),
            at, np.concatenate(numbers), len(numbers), len(used),
        )
        weights = group["n"].to_numpy(float)
        own, means = lloyd(table, weights, share, max_iter, np.random.default_rng([seed, cell, part]))
        counts = np.bincount(own, weights, minlength=len(means)).astype("int64")
        return pd.DataFrame({
            "cluster": [f"{cell}.{part}.{i}" for i in range(len(means))],
            "n": counts,
            "size": size,
            "slots": [used[mean != 0] for mean in means],
            "numbers": [mean[mean != 0] for mean in means],
        })

    return cluster


class SparseRows:
    """Rows as (row, slot, number) entries in the order of the rows."""

    def __init__(self, row, slot, number, n_rows: int, n_slots: int):
        self.row, self.slot, self.number = row, slot, np.asarray(number, float)
        self.n_rows, self.n_slots = n_rows, n_slots
        self.squares = np.bincount(row, self.number**2, minlength=n_rows)
        lengths = np.bincount(row, minlength=n_rows)
        self.width = int(lengths.max(initial=0))
        # rows with few of all slots also side by side, short ones filled up with zeros in slot 0
        self.few = None
        if self.width * _FEW <= n_slots:
            at = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            slots, numbers = np.zeros((self.width, n_rows), int), np.zeros((self.width, n_rows))
            slots[at, row], numbers[at, row] = slot, self.number
            # a slot that all rows have is a column of a plain product
            shared = (slots == slots[:, :1]).all(axis=1)
            self.few = slots[~shared], numbers[~shared], slots[shared, 0], numbers[shared].T

    def full(self, start: int, stop: int) -> np.ndarray:
        """Rows of a block, laid out in full."""
        lo, hi = np.searchsorted(self.row, [start, stop])
        block = np.zeros((stop - start, self.n_slots))
        block[self.row[lo:hi] - start, self.slot[lo:hi]] = self.number[lo:hi]
        return block

    def products(self, start: int, stop: int, by_slot: np.ndarray) -> np.ndarray:
        """Inner product of every row of a block with every centre, from the slots that rows have."""
        if self.few is None:
            return self.full(start, stop) @ by_slot
        slots, numbers, shared, columns = self.few
        out = columns[start:stop] @ by_slot[shared]
        for at, number in zip(slots[:, start:stop], numbers[:, start:stop], strict=True):
            found = by_slot[at]
            out += found if (number == 1).all() else found * number[:, None]
        return out

    def nearest(self, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centre of every row, the first among equals, and the squared distance."""
        own, far = np.empty(self.n_rows, int), np.empty(self.n_rows)
        step = max(1, _BLOCK_NUMBERS // max(self.width if self.few else self.n_slots, len(centres)))
        lengths = (centres**2).sum(axis=1)
        by_slot = np.ascontiguousarray(centres.T) if self.few else centres.T
        for start in range(0, self.n_rows, step):
            stop = min(start + step, self.n_rows)
            apart = lengths - 2 * self.products(start, stop, by_slot)
            own[start:stop] = apart.argmin(axis=1)
            far[start:stop] = apart.min(axis=1) + self.squares[start:stop]
        return own, np.maximum(far, 0)

    def means(self, own: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
        sums = np.bincount(
            own[self.row] * self.n_slots + self.slot,
            self.number * weights[self.row],
            minlength=k * self.n_slots,
        ).reshape(k, self.n_slots)
        return sums / np.bincount(own, weights, minlength=k)[:, None]


def lloyd(
    table: SparseRows, weights: np.ndarray, k: int, max_iter: int, rng: np.random.Generator
) -> tuple[np.ndarray, np.ndarray]:
    """The centre of every row and the k means; no centre is without rows, for k up to the rows."""
    if k >= table.n_rows:
        return np.arange(table.n_rows), table.full(0, table.n_rows)
    own, far = table.nearest(_spread(table, weights, k, rng))
    _fill_empty(own, far, k)
    means = table.means(own, weights, k)
    for _ in range(max_iter - 1):
        moved, far = table.nearest(means)
        _fill_empty(moved, far, k)
        if (moved == own).all():
            break
        own = moved
        means = table.means(own, weights, k)
    return own, means


def _spread(table: SparseRows, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """First centres: rows drawn by weight and squared distance from those drawn before."""
    first = rng.choice(table.n_rows, p=weights / weights.sum())
    chosen = [table.full(first, first + 1)[0]]
    _, far = table.nearest(chosen[0][None])
    while len(chosen) < k:
        odds = far * weights
        total = odds.sum()
        draw = rng.choice(table.n_rows, p=odds / total if total > 0 else None)
        chosen.append(table.full(draw, draw + 1)[0])
        lo, hi = np.searchsorted(table.row, [draw, draw + 1])
        line = np.zeros(table.n_slots)
        line[table.slot[lo:hi]] = table.number[lo:hi]
        inner = np.bincount(table.row, table.number * line[table.slot], minlength=table.n_rows)
        far = np.minimum(far, np.maximum(table.squares - 2 * inner + table.squares[draw], 0))
        far[draw] = 0
    return np.stack(chosen)


def _fill_empty(own: np.ndarray, far: np.ndarray, k: int) -> None:
    """Give every centre without rows the farthest row that does not stand alone."""
    counts = np.bincount(own, minlength=k)
    empty = list(np.flatnonzero(counts == 0))
    for row in np.argsort(-far, kind="stable") if empty else ():
        if counts[own[row]] > 1:
            counts[own[row]] -= 1
            own[row] = empty.pop()
            counts[own[row]] = 1
            if not empty:
                break
