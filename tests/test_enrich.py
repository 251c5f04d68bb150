from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from checks.base import view
from tests.plans import executed, planned
from txscore.operators.enrich import (
    accepted,
    broadcast_if_small,
    customer_side,
    customers_for,
    enrich,
    enrich_broadcast,
    match_customers,
    measured_bytes,
    parse_payments,
    rejected,
)
from txscore.operators.latest import latest_by_key


@contextmanager
def conf(spark, **values):
    names = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": -1,
    "spark__sql__adaptive__autoBroadcastJoinThreshold": -1,
}
SMALL_SKEW = {
    **NO_BROADCAST,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20k",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": 2,
}


def customers(spark, n=50, without=-1):
    return spark.range(n).filter(f"id <> {without}").select(
        F.col("id").cast("string").alias("card_number"),
        (F.col("id") % 60 + 1.5).alias("latitude"),
        (F.col("id") % 90 + 0.5).alias("longitude"),
        F.lit("1980-01-02").cast("timestamp").alias("date_of_birth"),
        F.lit("other").alias("job"),
    )


def payments(spark, n=20_000, card="cast(id % 50 as string)"):
    return spark.range(0, n, 1, 8).select(
        F.expr(card).alias("card_number"),
        F.col("id").cast("string").alias("transaction_number"),
        F.lit("2024-01-01").cast("timestamp").alias("transaction_time"),
        F.lit("food").alias("category"),
        F.lit("m").alias("merchant_name"),
        F.lit(1.0).alias("amount"),
        (F.col("id") % 70 + 0.25).alias("merchant_latitude"),
        (F.col("id") % 80 + 0.75).alias("merchant_longitude"),
    )


def records(spark, *values):
    rows = [(v, i % 2, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value string, partition int, offset long")


def payload(**changes):
    fields = {
        "card_number": "7",
        "transaction_number": "n",
        "transaction_time": "2024-01-01 00:00:00",
        "category": "food",
        "merchant_name": "m",
        "amount": "1.5",
        "merchant_latitude": "1",
        "merchant_longitude": "2",
    } | changes
    pairs = ",".join(f'"{k}":"{v}"' for k, v in fields.items() if v is not None)
    return "{" + pairs + "}"


def test_reasons(spark):
    texts = {
        "malformed_json": "not json",
        "missing_card": payload(card_number=None),
        "bad_time": payload(transaction_time="yesterday"),
        "bad_amount": payload(amount="x"),
        "bad_location": payload(merchant_latitude="NaN"),
        "unknown_card": payload(card_number="9999"),
        "incomplete_customer": payload(card_number="nowhere"),
        None: payload(),
    }
    lost = customers(spark, 1).select(
        F.lit("nowhere").alias("card_number"),
        F.lit(None).cast("double").alias("latitude"),
        "longitude",
        "date_of_birth",
        "job",
    )
    known = customers(spark).unionByName(lost)
    matched = match_customers(parse_payments(records(spark, *texts.values())), known)
    found = [r["reject_reason"] for r in matched.orderBy("offset").collect()]
    assert found == list(texts)
    assert accepted(matched).count() == 1
    assert sorted(r["value"] for r in rejected(matched).collect()) == sorted(
        v for k, v in texts.items() if k
    )


def test_nothing_is_lost(spark, sf_dir):
    source = view(spark, sf_dir, "payments_json")
    matched = match_customers(parse_payments(source), view(spark, sf_dir, "customers"))
    assert accepted(matched).count() + rejected(matched).count() == source.count()


def test_doubled_customer_doubles_payments(spark):
    doubled = customers(spark).unionByName(customers(spark))
    assert enrich(payments(spark, 100), doubled).count() == 200
    matched = match_customers(parse_payments(records(spark, payload())), doubled)
    assert accepted(matched).count() == 2


def test_source_zone(spark):
    parsed = parse_payments(records(spark, payload()), "Asia/Kolkata")
    text = parsed.select(F.col("transaction_time").cast("string").alias("t")).first()["t"]
    assert text == "2023-12-31 18:30:00"


def test_all_join_ways_agree(spark):
    rows, side = payments(spark, 2_000, "cast(id % 60 as string)"), customers(spark)
    expected = sorted(map(tuple, enrich(rows, side).collect()))
    # 33 rounds of 60 cards, of which 50 are known, and 20 more
    assert len(expected) == 33 * 50 + 20
    assert sorted(map(tuple, enrich_broadcast(rows, side).collect())) == expected
    with conf(spark, **NO_BROADCAST):
        assert sorted(map(tuple, enrich(rows, side).collect())) == expected
        assert sorted(map(tuple, enrich_broadcast(rows, side, limit=10).collect())) == expected


def test_broadcast_only_if_measured_small(spark):
    side = customer_side(customers(spark))
    size = measured_bytes(side)
    assert 50 * 64 < size < 50 * 200
    with conf(spark, **NO_BROADCAST):
        rows = payments(spark, 100)
        assert "BroadcastHashJoin" in planned(rows.join(broadcast_if_small(side), "card_number"))
        beyond = rows.join(broadcast_if_small(side, size - 1), "card_number")
        assert "SortMergeJoin" in planned(beyond)
    assert measured_bytes(side.limit(0)) == 0


def test_plan_is_pruned_and_native(spark, sf_dir):
    plan = planned(enrich(view(spark, sf_dir, "payments"), view(spark, sf_dir, "customers")))
    assert "Python" not in plan and "BroadcastHashJoin" in plan
    customer_scan = [line for line in plan.splitlines() if "customer.parquet" in line][0]
    assert "c_name" not in customer_scan and "c_mktsegment" not in customer_scan
    line_scan = [line for line in plan.splitlines() if "lineitem.parquet" in line][0]
    assert "l_tax" not in line_scan and "l_discount" not in line_scan


# a third of all payments on one card
HOT = "case when id % 3 = 0 then '7' else cast(id % 5000 as string) end"


@pytest.mark.parametrize("hot_is_known", [True, False])
def test_hot_card_is_split(spark, hot_is_known):
    side = customers(spark, 5000, without=-1 if hot_is_known else 7)
    rows = payments(spark, 60_000, HOT).select(
        F.lit(None).cast("string").alias("reject_reason"),
        F.lit("raw").alias("value"),
        F.lit(0).alias("partition"),
        F.col("transaction_number").cast("long").alias("offset"),
        "*",
    )
    known = rows.filter("card_number <> '7'").count() if not hot_is_known else 60_000
    with conf(spark, **SMALL_SKEW):
        inner = enrich(rows, side)
        assert "skew=true" in executed(inner)
        assert inner.count() == known
        # cached, as in the stream
        matched = match_customers(rows, side).persist()
        assert "skew=true" in executed(matched)
        assert accepted(matched).count() == known
        assert rejected(matched).count() == 60_000 - known
        matched.unpersist()


def test_broken_records_do_not_share_a_join_key(spark):
    source = records(spark, *["not json"] * 1000)
    with conf(spark, **NO_BROADCAST):
        matched = match_customers(parse_payments(source), customers(spark))
        plan = executed(matched)
    assert rejected(matched).count() == 1000
    assert "LeftOuter" in plan


def test_latest_keeps_one_row_per_task_before_the_shuffle(spark):
    rows = spark.range(0, 9_000, 1, 4).selectExpr("if(id % 3 = 0, 'hot', string(id)) as k", "id")
    newest = latest_by_key(rows, "k", F.col("id").desc())
    plan = planned(newest)
    partial, exchange = plan.index("Partial"), plan.index("Exchange")
    assert plan.count("WindowGroupLimit") == 2 and exchange < partial
    assert newest.filter("k = 'hot'").first()["id"] == 8_997
    assert newest.count() == 6_001


def test_customers_of_a_batch_come_three_ways(spark):
    side, rows = customers(spark, 5_000), payments(spark, 300, "cast(id % 70 as string)")
    small_cards = measured_bytes(rows.select("card_number").distinct())
    found = {}
    with conf(spark, **NO_BROADCAST):
        for way, limit in (("whole", 10**9), ("cut", small_cards), ("shuffled", 10)):
            joined = enrich(rows, customers_for(rows, side, limit))
            found[way] = (planned(joined), sorted(map(tuple, joined.collect())))
    assert found["whole"][1] == found["cut"][1] == found["shuffled"][1]
    assert len(found["whole"][1]) == 300
    assert "SortMergeJoin" not in found["whole"][0]
    assert "LeftSemi, BuildRight" in found["cut"][0]
    assert "Broadcast" not in found["shuffled"][0]


def test_many_cards_cut_many_customers_by_a_bloom_filter(spark, tmp_path):
    customers(spark, 5_000).write.parquet(f"{tmp_path}/customers")
    side = spark.read.parquet(f"{tmp_path}/customers")
    rows = payments(spark, 300, "cast(id % 70 as string)").unionByName(
        payments(spark, 2, "if(id = 0, '', null)")
    ).persist()
    small = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    with conf(spark, **NO_BROADCAST, **small):
        joined = enrich(rows, customers_for(rows, side, 10))
        plan = planned(joined)
        found = sorted(map(tuple, joined.collect()))
        assert found == sorted(map(tuple, enrich(rows, side).collect()))
    assert len(found) == 300
    # the filter stands where the customers are scanned; payments, customers and cards are shuffled once
    assert "might_contain" in plan and "bloom_filter_agg" in plan
    assert plan.count("Exchange hashpartitioning") == 3
    rows.unpersist()


def test_hint_reaches_the_join_of_a_micro_batch(spark):
    source, side = records(spark, payload()), customers(spark)
    with conf(spark, **NO_BROADCAST):
        payments_in = parse_payments(source)
        plan = planned(match_customers(payments_in, customers_for(payments_in, side)))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
