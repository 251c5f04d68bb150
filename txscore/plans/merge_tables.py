"""Merging of stored parts, so that readers meet few of them.

Parts of one level are merged into one of the next as soon as there are more than `merge_after`, so
their number grows with the logarithm of the writes and a row is rewritten as often. Payments are
also folded into a base with one row per key and label source, bucket by bucket: a bucket holds the
keys of one hash value, is read with the newer rows of the same value, and is written as a part of its
own, so one step needs the room of one bucket. Nothing is live before the one switch at the end, and a
merge that breaks off, or that another writer was ahead of, leaves all as it was.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txscore.operators.latest import SEQUENCE, latest_scored
from txscore.schemas import BATCH_SLICES, REJECTS, SCORED, STREAM_METRICS
from txscore.settings import Settings
from txscore.sources.manifest import BASE, Moved, Part, Record, newest, swap, sweep
from txscore.sources.tables import base_and_since, read_parts, read_scored_parts, write_part

# the base is written anew once the rows since are this share of it
FOLD_SHARE = 0.25
KEY = "transaction_number"


def bucket_of(buckets: int) -> Column:
    """The bucket of a payment; those without a number have no key and are dealt out by all columns."""
    hashed = F.when(F.col(KEY).isNull(), F.xxhash64(*SCORED.fieldNames())).otherwise(F.xxhash64(KEY))
    return F.pmod(hashed, F.lit(buckets))


def last_writes(rows: DataFrame) -> DataFrame:
    """One row per key and label source, and whether it is the last of its key in any source."""
    kept = latest_scored(rows.drop("is_current"), "label_source")
    newest_first = Window.partitionBy(KEY).orderBy(F.desc(SEQUENCE), F.desc("batch_id"), F.desc("label_source"))
    is_current = F.col(KEY).isNull() | (F.row_number().over(newest_first) == 1)
    keyed = kept.filter(F.col(KEY).isNotNull()).withColumn("is_current", is_current)
    return keyed.unionByName(kept.filter(F.col(KEY).isNull()).withColumn("is_current", F.lit(True)))


def fold_payments(spark: SparkSession, cfg: Settings, always: bool = False) -> bool:
    """Bring the base up to date if enough was written since; says whether it was."""
    if not cfg.stores_files:
        return False
    parts = newest(spark, cfg).of(cfg.scored_table)
    old, later = base_and_since(parts)
    written = sum(p.rows for p in later)
    if not always and (not later or written < FOLD_SHARE * sum(p.rows for p in old)):
        return False
    base = [p for p in parts if p.level == BASE]
    since = [p for p in parts if p.level != BASE]
    if not since:
        return False
    new_rows = read_scored_parts(spark, cfg, since)
    new = []
    for bucket in range(cfg.buckets):
        key = f"base/{bucket}/{cfg.buckets}"
        # a base of another number of buckets is read whole for each
        own = [p for p in base if p.key == key] if all(p.key.endswith(f"/{cfg.buckets}") for p in base) else base
        both = read_scored_parts(spark, cfg, own).unionByName(new_rows)
        rows = last_writes(both.filter(bucket_of(cfg.buckets) == bucket))
        new.append(
            write_part(rows, cfg, cfg.scored_table, key, ("is_fraud",), level=BASE, bucket=bucket)
        )
    return _switched(spark, cfg, cfg.scored_table, parts, new)


def _switched(spark: SparkSession, cfg: Settings, table: str, old: list[Part], new: list[Part]) -> bool:
    try:
        swap(spark, cfg, table, old, new)
    except Moved:
        return False
    sweep(spark, cfg)
    return True


def _most_gathered(record: Record, table: str, level: int) -> list[Part]:
    """Parts of a level, not across the end of stored counts, which could not be brought up to date then."""
    ends = sorted(p.covers for p in record.parts if p.counts_of == table)
    sides: dict[int, list[Part]] = defaultdict(list)
    for part in record.of(table):
        if part.level == level:
            sides[bisect_left(ends, part.sequence)].append(part)
    return max(sides.values(), key=len, default=[])


def merge_parts(spark: SparkSession, cfg: Settings) -> int:
    """Merge what has gathered of payments, rejects and batch metrics; returns how many merges there were."""
    if not cfg.stores_files:
        return 0
    merges = 0
    plain = {
        cfg.reject_table: T.StructType([*REJECTS, *BATCH_SLICES]),
        cfg.stream_metric_table: STREAM_METRICS,
    }
    for table in (cfg.scored_table, *plain):
        for level in range(64):
            of_level = _most_gathered(newest(spark, cfg), table, level)
            if len(of_level) <= cfg.merge_after:
                break
            if table == cfg.scored_table:
                rows = read_scored_parts(spark, cfg, of_level).drop("is_current")
                rows = latest_scored(rows, "label_source").hint("rebalance", "is_fraud")
            else:
                rows = read_parts(spark, cfg, table, of_level, plain[table]).drop("part").hint("rebalance")
            sources = {p.source for p in of_level}
            one = len(sources) == 1 and None not in sources
            merged = write_part(
                rows,
                cfg,
                table,
                f"level/{level + 1}/{max(p.sequence for p in of_level)}",
                () if table in plain else ("is_fraud",),
                level=level + 1,
                source=min(sources) if one else None,
                unique=one and table not in plain,
            )
            merges += _switched(spark, cfg, table, of_level, [merged])
    return merges
