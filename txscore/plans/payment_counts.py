"""Counts of stored payments that grow with new writes instead of being taken anew.

A training has to know how many payments each class has and how often each value of an encoded
column occurs. The counts of all payments up to a commit are stored as a part of their own. A later
training adds the payments of the parts committed since and takes off the rows that those replaced:
older parts are read for the keys alone, and for more columns only if a key is there. What no sum could
mend, such as a part that was written again, drops the counts in the same commit
(`txscore/sources/manifest.py`), and the next training counts everything once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txscore.operators.features import usable
from txscore.operators.splits import in_training
from txscore.plans.merge_tables import fold_payments
from txscore.schemas import COUNTS
from txscore.settings import Settings
from txscore.sources.manifest import Moved, Part, Record, commit, newest
from txscore.sources.tables import (
    LABEL_SOURCES,
    current_of_parts,
    few_keys,
    has_every_source,
    read_parts,
    read_scored_parts,
    write_part,
)

KEY = "transaction_number"
CLASS = "is_fraud"
VALUE = [name for name in COUNTS.fieldNames() if name != "n"]


@dataclass(frozen=True)
class Counted:
    """What is counted, of which payments."""

    columns: tuple[str, ...]
    numbers: tuple[str, ...]  # a payment that lacks one is not usable
    train_share: float
    label_sources: tuple[str, ...] = LABEL_SOURCES

    @property
    def key(self) -> str:
        sources = "all" if has_every_source(self.label_sources) else "+".join(sorted(self.label_sources))
        return "/".join([sources, str(self.train_share), "+".join(self.columns), "+".join(self.numbers)])


def count_values(payments: DataFrame, counted: Counted, sign: int = 1) -> DataFrame:
    """(column_name, value, is_usable, trains, n): classes of all rows, and values of usable ones.

    A class is counted by usable or not and by its side of the split; a value, of usable rows of both
    sides. Null values are not counted.
    """
    fine, trains = usable(counted.numbers), in_training(F.col(KEY), counted.train_share)
    no_side = F.lit(None).cast("boolean")

    def one(name, is_usable, side):
        value = F.col(name).cast("string")
        return F.struct(
            F.lit(name).alias("column_name"), value.alias("value"), is_usable.alias("is_usable"), side.alias("trains")
        )

    classes = one(CLASS, fine, trains)
    values = [F.when(fine & F.col(c).isNotNull(), one(c, F.lit(True), no_side)) for c in counted.columns]
    each = payments.select(F.explode(F.array(classes, *values)).alias("one")).filter("one is not null")
    return each.select("one.*").groupBy(*VALUE).agg((sign * F.count(F.lit(1))).alias("n"))


def summed(*counts: DataFrame) -> DataFrame:
    both = counts[0]
    for more in counts[1:]:
        both = both.unionByName(more)
    return both.groupBy(*VALUE).agg(F.sum("n").alias("n")).filter("n != 0")


def _changes(
    spark: SparkSession, cfg: Settings, counted: Counted, old: Sequence[Part], new: Sequence[Part]
) -> list[DataFrame]:
    """Counts to add for the parts committed since, and to take off for what they replaced."""
    came = current_of_parts(spark, cfg, new, counted.label_sources)
    keys = came.select(KEY).filter(F.col(KEY).isNotNull()).distinct()
    there = read_scored_parts(spark, cfg, old).select(KEY).join(few_keys(keys, new), KEY, "left_semi")
    changes = [count_values(came, counted)]
    if not there.isEmpty():
        before = current_of_parts(spark, cfg, old, counted.label_sources)
        changes.append(count_values(before.join(few_keys(keys, new), KEY, "left_semi"), counted, -1))
    return changes


def _counts_part(record: Record, cfg: Settings, counted: Counted) -> Part | None:
    found = (p for p in record.of(cfg.count_table) if p.counts_of == cfg.scored_table)
    return next((p for p in found if p.key == counted.key), None)


def stored_counts(spark: SparkSession, cfg: Settings, counted: Counted) -> tuple[list[Part], Part]:
    """Bring the stored counts up to the newest commit; the parts that they cover, and theirs.

    Should those parts be merged by another writer meanwhile, the counts are not stored, but hold for
    the parts returned, whose files stay until the second merge.
    """
    record = newest(spark, cfg)
    parts = record.of(cfg.scored_table)
    before = _counts_part(record, cfg, counted)
    if before is None:
        counts = count_values(current_of_parts(spark, cfg, parts, counted.label_sources), counted)
    else:
        old = [p for p in parts if p.sequence <= before.covers]
        new = [p for p in parts if p.sequence > before.covers]
        if not new:
            return parts, before
        known = read_counts(spark, cfg, before)
        counts = summed(known, *_changes(spark, cfg, counted, old, new))
    part = write_part(
        counts, cfg, cfg.count_table, counted.key, counts_of=cfg.scored_table, covers=record.sequence
    )
    try:
        commit(spark, cfg, [part], needs=parts)
    except Moved:
        pass
    return parts, part


def read_counts(spark: SparkSession, cfg: Settings, part: Part) -> DataFrame:
    return read_parts(spark, cfg, cfg.count_table, [part], COUNTS).drop("part")


def counted_payments(
    spark: SparkSession, cfg: Settings, counted: Counted
) -> tuple[DataFrame, DataFrame]:
    """Current payments and their counts, of the same commit, folded before if it is time.

    A fold goes across the end of stored counts, so those are brought up to date first.
    """
    if _counts_part(newest(spark, cfg), cfg, counted):
        stored_counts(spark, cfg, counted)
    fold_payments(spark, cfg)
    parts, part = stored_counts(spark, cfg, counted)
    return current_of_parts(spark, cfg, parts, counted.label_sources), read_counts(spark, cfg, part)


def class_counts(counts: DataFrame) -> tuple[int, int, dict[tuple[int, bool], int]]:
    """Usable and unusable rows, and usable rows by class and side of the split. Eight rows at most."""
    rows = counts.filter(F.col("column_name") == CLASS).collect()
    by_side = {(int(r.value), r.trains): r.n for r in rows if r.is_usable}
    return sum(by_side.values()), sum(r.n for r in rows if not r.is_usable), by_side


def label_counts_of(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, label, n) of the values of the columns."""
    values = counts.filter(F.col("column_name").isin(*columns))
    return values.select("column_name", F.col("value").alias("label"), "n")


def has_more_labels(counts: DataFrame, columns: Sequence[str], limit: int) -> bool:
    """Whether a column has more values than that; a row per column reaches the driver."""
    found = label_counts_of(counts, columns).groupBy("column_name").count().collect() if columns else []
    return any(r["count"] > limit for r in found)


def ordered_labels(counts: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Values of each column by falling count, then by text, as an indexer fitted on all rows has them."""
    rows = counts.filter(F.col("column_name").isin(*columns)).collect() if columns else []
    # text in the order of its UTF-16 units, as the indexer's
    rows.sort(key=lambda r: (-r.n, r.value.encode("utf-16-be", "surrogatepass")))
    return {c: [r.value for r in rows if r.column_name == c] for c in columns}
