"""Column builders: everything here is a built-in expression that Catalyst can see through."""

from txscore.functions.geo import distance_km
from txscore.functions.numbers import is_missing, to_double
from txscore.functions.payload import payload_text, payload_struct
from txscore.functions.temporal import (
    age_in_years,
    date_part,
    from_zone,
    joined_time_text,
    parse_time,
    zone_text,
)

__all__ = [
    "age_in_years",
    "date_part",
    "distance_km",
    "from_zone",
    "is_missing",
    "joined_time_text",
    "parse_time",
    "payload_struct",
    "payload_text",
    "to_double",
    "zone_text",
]
