"""Dates, ages and zone-less time text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: time text of payments, days of a year in the age rule
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
DAYS_PER_YEAR = 365


def date_part(text: Column) -> Column:
    """What stands before the `T` of an ISO time text; the whole text if there is none."""
    return F.split(text, "T")[0]


def joined_time_text(date_text: Column, time_text: Column) -> Column:
    """Date and time text joined by a blank; a null part is left out."""
    return F.concat_ws(" ", date_text, time_text)


def parse_time(text: Column) -> Column:
    """Time text to timestamp by calendar year; other text gives null."""
    return F.try_to_timestamp(text, F.lit(TIME_PATTERN))


def age_in_years(born: Column, at: Column) -> Column:
    """Whole years of 365 days between two dates, cut toward zero; leap days are not counted out."""
    days = F.datediff(F.to_date(at), F.to_date(born))
    return (days / DAYS_PER_YEAR).cast("int")


def zone_text(instant: Column, zone: str) -> Column:
    """Wall-clock text of an instant in a zone; the zone itself is not in the text."""
    return F.date_format(F.from_utc_timestamp(instant, zone), TIME_PATTERN)


def from_zone(wall_clock: Column, zone: str) -> Column:
    """Inverse of `zone_text`: the instant at which clocks of the zone showed this time."""
    return wall_clock if zone == "UTC" else F.to_utc_timestamp(wall_clock, zone)
