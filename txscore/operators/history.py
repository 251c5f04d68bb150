"""Cleaning of the history files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txscore.functions import age_in_years, date_part, joined_time_text, parse_time


def with_customer_age(customers: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Age on the day of the load, or on a given day."""
    day = F.current_date() if as_of is None else as_of
    return customers.withColumn("customer_age", age_in_years(F.col("date_of_birth"), day))


def clean_transactions(raw: DataFrame) -> DataFrame:
    """One timestamp out of the date and the time text; the helper columns are dropped."""
    text = joined_time_text(date_part(F.col("transaction_date")), F.col("transaction_time"))
    return raw.withColumn("transaction_time", parse_time(text)).drop(
        "transaction_date", "unix_time"
    )
