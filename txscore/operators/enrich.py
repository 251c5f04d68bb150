"""Payments joined with their customers: the one enrichment for batch, training and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txscore.functions import (
    age_in_years,
    distance_km,
    from_zone,
    is_missing,
    payload_struct,
    to_double,
)
from txscore.schemas import PAYMENT_COLUMNS
from txscore.session import BROADCAST_LIMIT

ADDRESS_COLUMNS = ["latitude", "longitude", "date_of_birth"]
FEATURE_COLUMNS = ["distance_from_customer_address", "age_at_transaction"]
# object and hash-table overhead of a broadcast row, on the generous side
ROW_OVERHEAD_BYTES = 64


def customer_side(customers: DataFrame) -> DataFrame:
    """The four customer columns the join needs; all else is pruned at the scan."""
    return customers.select("card_number", *ADDRESS_COLUMNS)


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame as rows in memory, by one aggregate over its columns."""
    widths = [
        F.coalesce(F.octet_length(f.name), F.lit(0)) + 16
        if isinstance(f.dataType, T.StringType)
        else F.lit(8)
        for f in df.schema
    ]
    row = sum(widths, F.lit(ROW_OVERHEAD_BYTES)).cast("long")
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()["bytes"]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Broadcast hint only if the measured size is within the limit.

    Beyond it the join shuffles by key, and a card with a large share of the payments is split
    over several tasks by the skew handling of AQE.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def customers_for(
    payments: DataFrame,
    customers: DataFrame,
    limit: int = BROADCAST_LIMIT,
    customer_bytes: int | None = None,
) -> DataFrame:
    """The customers side of a join with a small set of payments, such as a micro-batch.

    Few customers are broadcast whole. Otherwise the cards of the payments are, if they are few,
    so that the customers are cut down where they are scanned instead of being shuffled for every
    batch. If neither fits, a Bloom filter of the cards cuts the scan before both sides shuffle, where
    the scan is worth it by the session's sizes. `customer_bytes` saves measuring a snapshot again.
    """
    side = customer_side(customers)
    if customer_bytes is None:
        customer_bytes = measured_bytes(side)
    if customer_bytes <= limit:
        return F.broadcast(side)
    cards = payments.select("card_number").filter("card_number is not null").distinct()
    if measured_bytes(cards) <= limit:
        return side.join(F.broadcast(cards), "card_number", "left_semi")
    # every card passes; the planner builds a Bloom filter only of a side that is compared somehow.
    # The customers stay partitioned by card for the join that follows.
    return side.join(
        payments.select("card_number").filter("card_number >= ''"), "card_number", "left_semi"
    )


def with_features(joined: DataFrame) -> DataFrame:
    """Distance from the customer's address and age on the day of the payment."""
    return joined.withColumns({
        "distance_from_customer_address": distance_km(
            F.col("latitude"),
            F.col("longitude"),
            F.col("merchant_latitude"),
            F.col("merchant_longitude"),
        ),
        "age_at_transaction": age_in_years(F.col("date_of_birth"), F.col("transaction_time")),
    }).drop(*ADDRESS_COLUMNS)


def enrich(payments: DataFrame, customers: DataFrame) -> DataFrame:
    """Inner join on the card: payments of unknown cards are left out.

    How to join is left to the planner, which broadcasts customers under the session's
    threshold and otherwise shuffles both sides.
    """
    return with_features(payments.join(customer_side(customers), "card_number"))


def enrich_broadcast(
    payments: DataFrame, customers: DataFrame, limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """`enrich` that asks for a broadcast once the customers are measured to fit."""
    side = broadcast_if_small(customer_side(customers), limit)
    return with_features(payments.join(side, "card_number"))


def parse_payments(records: DataFrame, source_zone: str = "UTC") -> DataFrame:
    """(value, partition, offset) to typed payments plus `reject_reason`.

    `value` is kept for the rejects. The reason is null for a usable payload.
    """
    parsed = records.withColumn("payment", payload_struct(F.col("value"))).select(
        "value", "partition", "offset", "payment.*"
    )
    all_null = F.coalesce(*[F.col(c).cast("string") for c in PAYMENT_COLUMNS]).isNull()
    typed = parsed.withColumn("is_malformed", all_null).withColumns({
        "transaction_time": from_zone(F.col("transaction_time"), source_zone),
        **{
            c: to_double(F.col(c)) for c in ("amount", "merchant_latitude", "merchant_longitude")
        },
    })
    reason = F.when(F.col("is_malformed"), "malformed_json").otherwise(payment_problem())
    return typed.withColumn("reject_reason", reason).drop("is_malformed")


# why a payment is not stored, in the order in which the reasons count
REASONS = [
    "malformed_json",
    "malformed_csv",
    "missing_card",
    "bad_time",
    "bad_amount",
    "bad_location",
    "unknown_card",
    "incomplete_customer",
    "no_label",
]


def payment_problem() -> Column:
    """What a typed payment lacks, whether it comes from a file or a topic; null if nothing."""
    location_missing = is_missing(F.col("merchant_latitude")) | is_missing(
        F.col("merchant_longitude")
    )
    return (
        F.when(F.col("card_number").isNull(), "missing_card")
        .when(F.col("transaction_time").isNull(), "bad_time")
        .when(is_missing(F.col("amount")), "bad_amount")
        .when(location_missing, "bad_location")
    )


def match_customers(
    payments: DataFrame, customers: DataFrame, own_key: Column | None = None
) -> DataFrame:
    """Left join that keeps every payment and completes `reject_reason`.

    Payments that are rejected already join nothing. They get a join key of their own each
    (`own_key`, by default the position in the topic), so that a source full of broken records
    does not send them all to one task.
    """
    side = customer_side(customers).select(
        F.col("card_number").alias("customer_card"), *ADDRESS_COLUMNS
    )
    usable = F.col("reject_reason").isNull()
    if own_key is None:
        own_key = F.concat_ws(":", "partition", "offset")
    keyed = payments.withColumn("is_usable", usable).withColumn(
        "join_key", F.when(usable, F.col("card_number")).otherwise(own_key)
    )
    matched = keyed.join(
        side, (F.col("join_key") == F.col("customer_card")) & F.col("is_usable"), "left"
    )
    incomplete = (
        is_missing(F.col("latitude"))
        | is_missing(F.col("longitude"))
        | F.col("date_of_birth").isNull()
    )
    reason = (
        F.when(~F.col("is_usable"), F.col("reject_reason"))
        .when(F.col("customer_card").isNull(), "unknown_card")
        .when(incomplete, "incomplete_customer")
    )
    return with_features(matched.withColumn("reject_reason", reason)).drop(
        "is_usable", "join_key", "customer_card"
    )


def accepted(matched: DataFrame) -> DataFrame:
    return matched.filter(F.col("reject_reason").isNull()).drop("reject_reason", "value")


def rejected(matched: DataFrame) -> DataFrame:
    return matched.filter(F.col("reject_reason").isNotNull()).select(
        "value", "partition", "offset", "reject_reason"
    )
