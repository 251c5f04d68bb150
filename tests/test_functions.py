from datetime import datetime

import pytest
from pyspark.sql import functions as F

from txscore.functions import (
    age_in_years,
    date_part,
    distance_km,
    from_zone,
    is_missing,
    joined_time_text,
    parse_time,
    payload_struct,
    payload_text,
    to_double,
    zone_text,
)
from txscore.schemas import PAYMENT_COLUMNS


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def distance(spark, *coordinates):
    return one(spark, distance_km(*[F.lit(c).cast("double") for c in coordinates]))


def test_distance(spark):
    assert distance(spark, 51.5, -0.12, 48.85, 2.35) == pytest.approx(343, abs=2)
    assert distance(spark, 10, 20, 10, 20) == 0.0
    half_way_round = 20015.09
    assert distance(spark, 0, 0, 0, 180) == half_way_round
    assert distance(spark, 37.3, -12.7, -37.3, 167.3) == half_way_round


@pytest.mark.parametrize("at", range(4))
def test_distance_of_null_is_null(spark, at):
    coordinates = [1.0, 2.0, 3.0, 4.0]
    coordinates[at] = None
    assert distance(spark, *coordinates) is None


@pytest.mark.parametrize(
    "born, at, years",
    [
        ("2000-01-02", "2024-01-01", 24),
        ("2000-01-01", "2000-12-30", 0),
        ("2001-06-02", "2000-01-02", -1),
        ("2000-06-02", "2000-01-02", 0),
        (None, "2000-01-02", None),
    ],
)
def test_age(spark, born, at, years):
    day = [F.lit(d).cast("timestamp") for d in (born, at)]
    assert one(spark, age_in_years(*day)) == years


@pytest.mark.parametrize(
    "text, part",
    [("2019-07-15T00:00:00.000Z", "2019-07-15"), ("2019-07-15", "2019-07-15"), (None, None)],
)
def test_date_part(spark, text, part):
    assert one(spark, date_part(F.lit(text).cast("string"))) == part


def test_joined_text_leaves_out_nulls(spark):
    missing = F.lit(None).cast("string")
    assert one(spark, joined_time_text(F.lit("a"), F.lit("b"))) == "a b"
    assert one(spark, joined_time_text(missing, F.lit("b"))) == "b"
    assert one(spark, joined_time_text(missing, missing)) == ""


@pytest.mark.parametrize(
    "text, time",
    [
        ("2019-12-31 10:20:30", datetime(2019, 12, 31, 10, 20, 30)),
        ("2019-07-15 00:00:00", datetime(2019, 7, 15)),
        ("10:20:30", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_time(spark, text, time):
    # read back as text, so that the zone of this machine plays no part
    found = one(spark, parse_time(F.lit(text).cast("string")).cast("string"))
    assert found == (str(time) if time else None)


@pytest.mark.parametrize(
    "text, number", [("12.5", 12.5), ("-3", -3.0), ("x", None), ("", None), (None, None)]
)
def test_to_double(spark, text, number):
    assert one(spark, to_double(F.lit(text).cast("string"))) == number


def test_missing_numbers(spark):
    values = {1.0: False, float("nan"): True, None: True}
    for value, missing in values.items():
        assert one(spark, is_missing(F.lit(value).cast("double"))) is missing


def test_zone_text_and_back(spark):
    instant = F.lit("2024-01-01 20:00:00").cast("timestamp")
    text = zone_text(instant, "Asia/Kolkata")
    assert one(spark, text) == "2024-01-02 01:30:00"
    back = from_zone(parse_time(text), "Asia/Kolkata").cast("string")
    assert one(spark, back) == "2024-01-01 20:00:00"


@pytest.mark.parametrize("text", ["not json", "", None, "[1]", '{"card_number": '])
def test_broken_json_gives_nulls(spark, text):
    parsed = one(spark, payload_struct(F.lit(text).cast("string")))
    assert parsed is None or not any(parsed)


def test_json_payload(spark):
    text = '{"card_number":"7","amount":12.5,"extra":1,"transaction_time":"2024-01-01 01:02:03"}'
    parsed = one(spark, payload_struct(F.lit(text)))
    assert (parsed["card_number"], parsed["amount"], parsed["category"]) == ("7", "12.5", None)
    assert parsed["transaction_time"] is not None


def test_payload_round_trip(spark):
    columns = {c: F.lit(f"{c} \"x\"") for c in PAYMENT_COLUMNS}
    columns["transaction_time"] = F.lit("2024-01-01 01:02:03")
    columns["category"] = F.lit(None).cast("string")
    text = one(spark, payload_text(**columns))
    assert '"category"' not in text
    parsed = one(spark, payload_struct(F.lit(text)))
    assert parsed["merchant_name"] == 'merchant_name "x"'
    assert parsed["category"] is None
