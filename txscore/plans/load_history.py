"""Load job: history files to the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from txscore.operators.enrich import (
    FEATURE_COLUMNS,
    REASONS,
    enrich,
    match_customers,
    payment_problem,
)
from txscore.operators.history import clean_transactions, with_customer_age
from txscore.schemas import CUSTOMER_CSV, CUSTOMER_TABLE, TRANSACTION_CSV
from txscore.settings import Settings
from txscore.sources.csv import FILE_ORDER, RAW_LINE, has_wrong_width, read_csv, with_file_order
from txscore.sources.tables import read_snapshot, upsert_snapshot, write_by_class


def load_customers(
    spark: SparkSession, cfg: Settings, load_id: str, as_of: Column | None = None
) -> None:
    customers = with_customer_age(read_csv(spark, cfg.customer_csv, CUSTOMER_CSV), as_of)
    upsert_snapshot(spark, customers, cfg, cfg.customer_table, "card_number", load_id)


def enriched_history(raw: DataFrame, customers: DataFrame) -> DataFrame:
    """History payments of known cards, with features and the label."""
    return enrich(clean_transactions(raw), customers)


def matched_history(spark: SparkSession, cfg: Settings) -> DataFrame:
    """Every history payment with its features and `reject_reason`, by the rules of the stream.

    On top of those, a history payment needs a label. A line with too few or too many fields is
    `malformed_csv`, whatever its fields say; `raw_line` has the text of each line that does not fit.
    """
    customers = read_snapshot(spark, cfg, cfg.customer_table, CUSTOMER_TABLE)
    scan = read_csv(spark, cfg.transaction_csv, TRANSACTION_CSV, RAW_LINE)
    payments = clean_transactions(with_file_order(scan))
    of_row = F.concat(F.lit("row:"), F.xxhash64(*payments.columns).cast("string"))
    wrong = has_wrong_width(F.col(RAW_LINE), len(TRANSACTION_CSV))
    problem = F.when(wrong, "malformed_csv").otherwise(payment_problem())
    matched = match_customers(payments.withColumn("reject_reason", problem), customers, of_row)
    no_label = ~F.coalesce(F.col("is_fraud").isin(0, 1), F.lit(False))
    reason = F.coalesce("reject_reason", F.when(no_label, "no_label"))
    return matched.withColumn("reject_reason", reason)


def load_transactions(
    spark: SparkSession, cfg: Settings, load_id: str, compact: bool = False
) -> dict[str, int]:
    """Store history payments by class, and count those that belong nowhere on the way.

    Of payments with the same number the last in the files is stored, so that loading them again
    gives the same. Payments meet by number before they are counted: counts are exact only in
    the tasks that write, which run once each, while tasks before a shuffle run again if an
    executor is lost. `repeated` counts those that a later one replaces. The files are read once.
    `compact` writes fewer files: it shuffles once more, and counts before that.
    """
    reason = F.col("reject_reason")
    matched = matched_history(spark, cfg)
    # rows without a number, and rejected ones, are nobody's repetition and lie anywhere
    lone = reason.isNotNull() | F.col("transaction_number").isNull()
    key = F.when(lone, F.xxhash64(*FILE_ORDER).cast("string")).otherwise(
        F.concat(F.lit("n"), "transaction_number")
    )
    by_key = matched.withColumn("own_key", key).repartition("own_key")
    later = Window.partitionBy("own_key").orderBy(*[F.col(c).desc() for c in FILE_ORDER])
    ranked = by_key.withColumn("place", F.row_number().over(later))
    seen = Observation()
    stays = reason.isNull() & (lone | (F.col("place") == 1))
    counted = ranked.observe(
        seen,
        F.count_if(stays).alias("stored"),
        F.count_if(reason.isNull() & ~stays).alias("repeated"),
        *[F.count_if(reason == name).alias(name) for name in REASONS],
    )
    write_by_class(counted.filter(stays), cfg, "loaded", load_id, 0, compact, unique=True)
    return seen.get


def history_rejects(spark: SparkSession, cfg: Settings) -> DataFrame:
    """The history payments that no class took, with the reason; for a look when there are any."""
    rejected = matched_history(spark, cfg).filter(F.col("reject_reason").isNotNull())
    return rejected.drop(*FEATURE_COLUMNS, *FILE_ORDER)


def load_history(
    spark: SparkSession,
    cfg: Settings,
    load_id: str,
    as_of: Column | None = None,
    compact: bool = False,
) -> dict[str, int]:
    """Customers, then transactions. Running the same load again leaves one copy."""
    load_customers(spark, cfg, load_id, as_of)
    return load_transactions(spark, cfg, load_id, compact)
