"""Numbers that arrive as text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(text: Column) -> Column:
    """Text to double; text that is no number gives null instead of ending the job."""
    return text.try_cast("double")


def is_missing(number: Column) -> Column:
    """True where a number cannot enter a feature vector."""
    return number.isNull() | F.isnan(number)
