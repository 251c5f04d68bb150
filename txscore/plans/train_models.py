"""Training job: stored payments to a new version of both models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txscore.operators import balance, features
from txscore.operators.evaluate import quality
from txscore.operators.forest import DEPTH, MAX_BINS, TREES, fit_forest
from txscore.operators.labels import label_counts
from txscore.operators.splits import TRAIN_SHARE, in_training, random_split
from txscore.plans.payment_counts import (
    Counted,
    class_counts,
    counted_payments,
    has_more_labels,
    label_counts_of,
    ordered_labels,
)
from txscore.schemas import MODEL_COLUMNS, SCORED
from txscore.settings import Settings
from txscore.sources.models import save_models
from txscore.sources.tables import LABEL_SOURCES, current_scored, replace_slice

KEY = "transaction_number"
NUMBERS = ["distance_from_customer_address", "amount", "age_at_transaction"]


@dataclass(frozen=True)
class TrainingOptions:
    method: str = "weights"  # or "undersample", "kmeans"
    # "holdout": rows set aside before balancing; "balanced": a part of the balanced rows
    evaluate_on: str = "holdout"
    leave_out: tuple[str, ...] = features.LEAVE_OUT
    label_sources: tuple[str, ...] = LABEL_SOURCES
    train_share: float = TRAIN_SHARE
    # string columns that share a fixed number of slots instead of one slot per value
    hash_columns: tuple[str, ...] = ()
    hash_slots: int = features.HASH_SLOTS
    # centres in place of class 0; None: as many as there are rows of class 1
    clusters: int | None = None
    centre_weights: str = balance.BY_ROWS
    kmeans_iterations: int = balance.KMEANS_ITERATIONS
    # all rows are trained on, unless a caller asks for fewer: all of class 1 first, then a hash-chosen
    # part of class 0. Counts, features and the held-out measure cover all rows in any case.
    max_training_rows: int | None = None
    max_bins: int = MAX_BINS
    trees: int = TREES
    depth: int = DEPTH
    seed: int = 42


# every string column encoded, cluster centres as class 0, quality measured on balanced rows
CLUSTERED = TrainingOptions(
    method="kmeans", evaluate_on="balanced", leave_out=(), centre_weights=balance.AS_ONE
)


@dataclass(frozen=True)
class Trained:
    preprocessor: PipelineModel
    forest: RandomForestClassificationModel
    metrics: DataFrame


def training_rows(stored: DataFrame) -> DataFrame:
    """The key, the model columns and the label of stored payments."""
    return stored.select(KEY, *MODEL_COLUMNS, F.col("is_fraud").alias("label"))


def balanced_rows(
    vectors: DataFrame, sizes: dict[int, int], options: TrainingOptions
) -> tuple[DataFrame, str | None]:
    """Balanced (features, label[, weight]) and the weight column, if there is one."""
    if options.method == "weights":
        return balance.weighted(vectors, sizes), balance.WEIGHT
    if options.method == "undersample":
        return balance.undersampled(vectors, sizes, KEY, options.seed), None
    if options.method == "kmeans":
        centers = balance.cluster_centers(
            vectors.filter("label = 0"),
            sizes[1] if options.clusters is None else options.clusters,
            options.kmeans_iterations,
            options.seed,
        )
        minority = vectors.filter("label = 1")
        rows = balance.clustered(minority, centers, sizes[1], options.centre_weights)
        return rows, balance.WEIGHT
    raise ValueError(f"unknown balance method: {options.method}")


def counted_by(rows: DataFrame, options: TrainingOptions) -> Counted:
    """What a training has to know of all rows before it fits."""
    strings = features.string_columns(rows.select(*MODEL_COLUMNS), leave_out=options.leave_out)
    encoded = tuple(c for c in strings if c not in options.hash_columns)
    return Counted(encoded, tuple(NUMBERS), options.train_share, options.label_sources)


def train(
    rows: DataFrame,
    options: TrainingOptions = TrainingOptions(),
    counts: DataFrame | None = None,
) -> Trained:
    """Fit both models on (key, model columns, label) and measure them.

    Rows with a missing number cannot be scored. They are counted in `n_unusable`, not hidden.
    Given the `counts` of the rows, sizes and labels come from them, and rows are read to train only.
    Without them the rows are read for all of it, so they are kept, on disk beyond memory, and made once.
    """
    if counts is not None:
        return _train(rows, options, counts)
    kept = rows.select(KEY, *MODEL_COLUMNS, "label").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _train(kept, options, None)
    finally:
        kept.unpersist()


def _train(rows: DataFrame, options: TrainingOptions, counts: DataFrame | None) -> Trained:
    spark = rows.sparkSession
    usable = features.usable(NUMBERS)
    holds_out = options.evaluate_on == "holdout"
    trains = in_training(F.col(KEY), options.train_share) if holds_out else F.lit(True)
    columns = counted_by(rows, options).columns
    good = rows.filter(usable)
    labels = values = None
    if counts is None:
        # all that has to be known before fitting, in one pass
        known = rows.agg(
            F.count_if(usable).alias("n_rows"),
            F.count_if(~usable).alias("n_unusable"),
            *[F.count_if(usable & trains & (F.col("label") == c)).alias(f"n_{c}") for c in (0, 1)],
            F.greatest(F.lit(0), F.lit(0), *features.label_sizes(columns)).alias("most_labels"),
        ).first()
        n_rows, n_unusable = known["n_rows"], known["n_unusable"]
        sizes = {c: known[f"n_{c}"] for c in (0, 1)}
        if known["most_labels"] > features.DRIVER_LABELS:
            values = label_counts(good, list(columns))
    else:
        n_rows, n_unusable, by_side = class_counts(counts)
        sides = (True,) if holds_out else (True, False)
        sizes = {c: sum(by_side.get((c, side), 0) for side in sides) for c in (0, 1)}
        if has_more_labels(counts, columns, features.DRIVER_LABELS):
            values = label_counts_of(counts, columns)
        else:
            labels = ordered_labels(counts, columns)
    balance.both_present(sizes)
    preprocessor = features.fit_preprocessor(
        good.select(*MODEL_COLUMNS),
        leave_out=options.leave_out,
        hash_columns=options.hash_columns,
        hash_slots=options.hash_slots,
        labels=labels,
        counts=values,
        driver_labels=None,
    )
    used, used_sizes = good.filter(trains), sizes
    if options.max_training_rows is not None:
        used, used_sizes = balance.bounded(used, sizes, KEY, options.max_training_rows, options.seed)
    # of the vectors only those that are trained on are kept, on disk beyond memory
    vectors = (
        preprocessor.transform(used)
        .select(KEY, features.FEATURES, "label")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        chosen, weight = balanced_rows(vectors, used_sizes, options)
        if holds_out:
            held_out = preprocessor.transform(good.filter(~trains))
            test = held_out.select(KEY, features.FEATURES, "label")
        else:
            chosen, test = random_split(chosen, options.train_share, options.seed)
        forest = fit_forest(
            chosen,
            weight=weight,
            max_bins=options.max_bins,
            trees=options.trees,
            depth=options.depth,
            seed=options.seed,
        )
        measured = quality(forest.transform(test)).first()
    finally:
        vectors.unpersist()
    metrics = spark.createDataFrame(
        [{
            "method": options.method,
            "evaluated_on": options.evaluate_on,
            "n_rows": n_rows,
            "n_unusable": n_unusable,
            **measured.asDict(),
        }],
        "method string, evaluated_on string, n_rows long, n_unusable long, n_test long,"
        " accuracy double, true_positives long, false_positives long, false_negatives long,"
        " true_negatives long",
    )
    return Trained(preprocessor, forest, metrics)


def train_models(
    spark: SparkSession,
    cfg: Settings,
    version: str,
    options: TrainingOptions = TrainingOptions(),
) -> DataFrame:
    """Retrain on all payments stored so far, each once as last written, save under the version, return the metrics row.

    Of files, counts are brought up to date from what was written since the last training with
    the same options; a connector's store is counted anew.
    """
    if cfg.stores_files:
        layout = spark.createDataFrame([], SCORED)
        stored, counts = counted_payments(spark, cfg, counted_by(layout, options))
    else:
        stored, counts = current_scored(spark, cfg, options.label_sources), None
    trained = train(training_rows(stored), options, counts)
    metrics = trained.metrics.select(F.lit(version).alias("version"), "*")
    replace_slice(metrics, cfg, cfg.metric_table, {"version": version})
    save_models(spark, cfg, trained.preprocessor, trained.forest, version)
    return metrics
