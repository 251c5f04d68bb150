"""Replay job: a header-less payment file to JSON records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txscore.functions import payload_text, zone_text
from txscore.schemas import PAYMENT_COLUMNS
from txscore.settings import Settings
from txscore.sources.csv import read_replay_csv
from txscore.sources.kafka import write_records


def encode_payments(payments: DataFrame) -> DataFrame:
    """One JSON text per payment, in the column `value`."""
    return payments.select(payload_text(**{c: F.col(c) for c in PAYMENT_COLUMNS}).alias("value"))


def replay(
    spark: SparkSession,
    cfg: Settings,
    sink: str = "kafka",
    path: str = "",
    sent_at: Column | None = None,
) -> None:
    """Stamp every payment of the file with the wall clock of the replay zone and send it."""
    now = F.current_timestamp() if sent_at is None else sent_at
    payments = read_replay_csv(spark, cfg.replay_csv).withColumn(
        "transaction_time", zone_text(now, cfg.replay_zone)
    )
    write_records(encode_payments(payments), cfg, sink, path)
