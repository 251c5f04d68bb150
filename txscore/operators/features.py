"""Feature pipeline: one-hot strings and plain numbers in one vector."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txscore.functions import is_missing
from txscore.operators.labels import label_counts
from txscore.operators.wide import DRIVER_LABELS, label_slots
from txscore.session import shared_folder

FEATURES = "features"
HASHED = "hashed_labels"
# a card says who paid, not how; one slot per card also grows with the data
LEAVE_OUT = ("card_number",)
# slots shared by the columns that a caller asks to hash
HASH_SLOTS = 1 << 11


def string_columns(df: DataFrame, label_col: str = "", leave_out: Sequence[str] = LEAVE_OUT) -> list[str]:
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and f.name != label_col and f.name not in leave_out
    ]


def usable(columns: Sequence[str]) -> Column:
    """True where every number can enter a vector."""
    ok = F.lit(True)
    for name in columns:
        ok = ok & ~is_missing(F.col(name))
    return ok


def feature_stages(
    df: DataFrame,
    label_col: str = "",
    leave_out: Sequence[str] = LEAVE_OUT,
    hash_columns: Sequence[str] = (),
    hash_slots: int = HASH_SLOTS,
    labels: Mapping[str, Sequence[str]] | None = None,
) -> list:
    """Stages by column type, in the order of the columns, whatever the data hold.

    Given the `labels` of every encoded column in the order of their slots, fitting reads no rows.

    Strings are indexed by frequency and one-hot encoded; a value that was not there at fit
    time, or null, sets no slot. The labels of such a column pass through the driver, and a forest
    keeps four bytes per slot for every training row, so a caller may name `hash_columns`, which
    share `hash_slots` slots behind all others instead. Every other column passes through.
    """
    strings = string_columns(df, label_col, leave_out)
    hashed = [c for c in strings if c in hash_columns]
    encoded = [c for c in strings if c not in hashed]
    stages: list = []
    if encoded:
        indexed_names = [f"{c}_indexed" for c in encoded]
        if labels is None:
            stages.append(StringIndexer(inputCols=encoded, outputCols=indexed_names, handleInvalid="keep"))
        else:
            # one by one, as lists of unequal length cannot be given together
            stages += [
                StringIndexerModel.from_labels(list(labels[c]), c, f"{c}_indexed", handleInvalid="keep")
                for c in encoded
            ]
        stages.append(OneHotEncoder(inputCols=indexed_names, outputCols=[f"{c}_encoded" for c in encoded]))
    if hashed:
        stages.append(FeatureHasher(inputCols=hashed, outputCol=HASHED, numFeatures=hash_slots))
    inputs = [
        f"{c}_encoded" if c in encoded else c
        for c in df.columns
        if c != label_col and c not in leave_out and c not in hashed
    ]
    if hashed:
        inputs.append(HASHED)
    return [*stages, VectorAssembler(inputCols=inputs, outputCol=FEATURES)]


def fit_preprocessor(
    df: DataFrame,
    label_col: str = "",
    leave_out: Sequence[str] = LEAVE_OUT,
    hash_columns: Sequence[str] = (),
    hash_slots: int = HASH_SLOTS,
    labels: Mapping[str, Sequence[str]] | None = None,
    counts: DataFrame | None = None,
    driver_labels: int | None = DRIVER_LABELS,
) -> PipelineModel:
    """The stages fitted on all rows.

    With more than about `driver_labels` labels in a column, the labels of all columns stay in a table
    (`txscore/operators/wide.py`): same slots, same numbers. Given `counts`, the (column_name, label, n) of
    all encoded columns, they do so in any case; with no `driver_labels` the rows are not asked.
    """
    strings = string_columns(df, label_col, leave_out)
    encoded = [c for c in strings if c not in hash_columns]
    if labels is None and counts is None and driver_labels is not None:
        if has_many_labels(df, encoded, driver_labels):
            counts = label_counts(df, encoded)
    if counts is not None:
        return _fit_wide(df, counts, encoded, label_col, leave_out, hash_columns, hash_slots)
    stages = feature_stages(df, label_col, leave_out, hash_columns, hash_slots, labels)
    return Pipeline(stages=stages).fit(df)


def label_sizes(columns: Sequence[str]) -> list[Column]:
    """About how many labels each column has, to within a tenth, in fixed memory."""
    return [F.approx_count_distinct(F.col(c)).alias(f"labels_of_{c}") for c in columns]


def has_many_labels(df: DataFrame, columns: Sequence[str], limit: int) -> bool:
    return bool(columns) and max(df.agg(*label_sizes(columns)).first()) > limit


def _fit_wide(
    df: DataFrame,
    counts: DataFrame,
    encoded: Sequence[str],
    label_col: str,
    leave_out: Sequence[str],
    hash_columns: Sequence[str],
    hash_slots: int,
) -> PipelineModel:
    shared_folder(df.sparkSession)
    counts = counts.checkpoint()
    sizes = dict.fromkeys(encoded, 0)
    sizes |= {r.column_name: r["count"] for r in counts.groupBy("column_name").count().collect()}
    hashers = [
        s
        for s in feature_stages(df, label_col, leave_out, hash_columns, hash_slots)
        if isinstance(s, FeatureHasher)
    ]
    hashed = [c for c in string_columns(df, label_col, leave_out) if c not in sizes]
    inputs = [c for c in df.columns if c != label_col and c not in leave_out and c not in hashed]
    widths = [sizes[c] if c in sizes else _width(df, c) for c in inputs]
    if hashers:
        inputs.append(HASHED)
        widths.append(hash_slots)
    return PipelineModel([*hashers, label_slots(counts, sizes, inputs, widths, FEATURES)])


def _width(df: DataFrame, name: str) -> int:
    """Slots of a column that passes through: one for a number, of a vector as many as the first has."""
    if not isinstance(df.schema[name].dataType, VectorUDT):
        return 1
    known = df.schema[name].metadata.get("ml_attr", {}).get("num_attrs")
    return known if known is not None else df.select(name).first()[0].size


def without_slot_names(df: DataFrame, column: str = FEATURES) -> DataFrame:
    """Drop the vector's slot metadata.

    It calls one-hot slots binary. A forest believes that and cuts the fractions of a centroid
    to zero, so it has to go before rows and centroids are trained on together.
    """
    return df.withMetadata(column, {})
