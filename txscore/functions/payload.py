"""JSON form of a payment."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from txscore.schemas import PAYMENT_COLUMNS, PAYMENT_JSON


def payload_struct(value: Column) -> Column:
    """Parse a JSON payment; a text that is no JSON object gives a struct of nulls."""
    return F.from_json(value, PAYMENT_JSON)


def payload_text(**columns: Column) -> Column:
    """Build the JSON payment: every field as text, in the fixed order; nulls are left out."""
    return F.to_json(F.struct(*[columns[c].cast("string").alias(c) for c in PAYMENT_COLUMNS]))
