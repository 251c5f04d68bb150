"""Projections, filters, joins, aggregates, unions and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import (
    FEATURES_SQL,
    SCORED_SQL,
    age_sql,
    query,
    scratch_settings,
    table,
    view,
    with_views,
)
from checks.scans import AS_OF
from txscore.functions import (
    age_in_years,
    date_part,
    distance_km,
    from_zone,
    joined_time_text,
    parse_time,
    zone_text,
)
from txscore.operators.columns import rename_columns
from txscore.operators.enrich import (
    accepted,
    enrich,
    enrich_broadcast,
    match_customers,
    parse_payments,
    rejected,
)
from txscore.operators.evaluate import accuracy, confusion_counts
from txscore.operators.history import clean_transactions, with_customer_age
from txscore.operators.routing import class_counts as counted_classes
from txscore.operators.routing import of_class
from txscore.operators.splits import hash_split as split_by_hash
from txscore.plans.load_history import enriched_history
from txscore.schemas import MODEL_COLUMNS, SCORED_COLUMNS
from txscore.sources.tables import read_class, union_by_class, write_by_class

# date text in all its forms: ISO with a time, date only, missing
_DATE_FORMS = (
    "case category when 'view' then substr(transaction_date, 1, 10)"
    " when 'click' then null else transaction_date end"
)
# time text in all its forms: fitting, not fitting, missing
_TIME_FORMS = (
    "case category when 'view' then 'at ' || transaction_time"
    " when 'click' then null else substr(transaction_date, 1, 10) || ' ' || transaction_time end"
)


def history(spark, sf_dir):
    """Cleaned and enriched history payments, still with their label."""
    return enriched_history(
        view(spark, sf_dir, "transactions_raw"), view(spark, sf_dir, "customers")
    )


def matched(spark, sf_dir):
    records = view(spark, sf_dir, "payments_json")
    return match_customers(parse_payments(records), view(spark, sf_dir, "customers"))


# --- projections and filters


@query(
    "model_input_columns",
    with_views("history") + f"select {', '.join(MODEL_COLUMNS)} from history",
)
def model_input_columns(spark, sf_dir):
    return history(spark, sf_dir).select(*MODEL_COLUMNS)


@query(
    "rename_columns",
    with_views("customers")
    + f"select card_number, {age_sql('date_of_birth', repr(AS_OF))} as age_at_transaction"
    " from customers",
)
def renamed(spark, sf_dir):
    aged = with_customer_age(view(spark, sf_dir, "customers"), F.to_date(F.lit(AS_OF)))
    return rename_columns(
        aged.select("card_number", "customer_age"), {"customer_age": "age_at_transaction"}
    )


@query("filter_fraud", with_views("history") + f"select {SCORED_SQL} from history where is_fraud = 1")
def filter_fraud(spark, sf_dir):
    return of_class(history(spark, sf_dir), 1).select(*SCORED_COLUMNS)


@query(
    "filter_non_fraud", with_views("history") + f"select {SCORED_SQL} from history where is_fraud = 0"
)
def filter_non_fraud(spark, sf_dir):
    return of_class(history(spark, sf_dir), 0).select(*SCORED_COLUMNS)


@query(
    "route_by_label",
    with_views("history")
    + f"select {SCORED_SQL}, is_fraud from history where category <> 'view'",
)
def route_by_label(spark, sf_dir):
    """Both classes stored and read back; views lose their label, so they go to neither."""
    cfg = scratch_settings(spark)
    label = F.when(F.col("category") != "view", F.col("is_fraud"))
    write_by_class(
        history(spark, sf_dir).withColumn("is_fraud", label), cfg, "loaded", "first", 0, unique=True
    )
    return union_by_class(read_class(spark, cfg, 0), read_class(spark, cfg, 1)).select(
        *SCORED_COLUMNS, "is_fraud"
    )


# --- joins


@query(
    "enrich_batch_join",
    with_views("payments", "customers")
    + f"""select p.*, {FEATURES_SQL}
from payments p join customers c on p.card_number = c.card_number""",
)
def enrich_batch_join(spark, sf_dir):
    return enrich(view(spark, sf_dir, "payments"), view(spark, sf_dir, "customers"))


@query(
    "enrich_broadcast_join",
    with_views("typed", "customers")
    + f"""select partition, "offset", {SCORED_SQL} from (
  select t.*, {FEATURES_SQL} from typed t join customers c on t.card_number = c.card_number)""",
)
def enrich_broadcast_join(spark, sf_dir):
    payments = parse_payments(view(spark, sf_dir, "payments_json"))
    joined = enrich_broadcast(payments, view(spark, sf_dir, "customers"))
    return joined.select("partition", "offset", *SCORED_COLUMNS)


@query(
    "scored_input",
    with_views("outcome")
    + f'select partition, "offset", {SCORED_SQL} from outcome where reject_reason is null',
)
def scored_input(spark, sf_dir):
    return accepted(matched(spark, sf_dir)).select("partition", "offset", *SCORED_COLUMNS)


@query(
    "rejects",
    with_views("outcome")
    + 'select value, partition, "offset", reject_reason from outcome where reject_reason is not null',
)
def rejects(spark, sf_dir):
    return rejected(matched(spark, sf_dir))


# --- aggregates and unions


@query(
    "class_counts",
    with_views("payments") + "select is_fraud, count(*) as n from payments group by is_fraud",
)
def class_counts(spark, sf_dir):
    return counted_classes(view(spark, sf_dir, "payments"))


def _rule_predictions(spark, sf_dir):
    """A prediction by rule: large payments are fraud."""
    large = (F.col("amount") >= 90000).cast("double")
    return view(spark, sf_dir, "payments").select(
        F.col("is_fraud").alias("label"), large.alias("prediction")
    )


_RULE_SQL = with_views("payments") + (
    ", predicted as (select is_fraud as label, cast(amount >= 90000 as double) as prediction"
    " from payments)\n"
)


@query(
    "eval_accuracy",
    _RULE_SQL
    + "select count(*) as n, avg(cast(label = prediction as double)) as accuracy from predicted",
)
def eval_accuracy(spark, sf_dir):
    return accuracy(_rule_predictions(spark, sf_dir))


@query(
    "confusion_counts",
    _RULE_SQL + "select label, prediction, count(*) as n from predicted group by label, prediction",
)
def confusion(spark, sf_dir):
    return confusion_counts(_rule_predictions(spark, sf_dir))


@query(
    "history_union",
    with_views("history")
    + f"select {', '.join(MODEL_COLUMNS)} from history where is_fraud = 0"
    f" union all select {', '.join(MODEL_COLUMNS)} from history where is_fraud = 1",
)
def history_union(spark, sf_dir):
    rows = history(spark, sf_dir)
    parts = [of_class(rows, value).select(*MODEL_COLUMNS) for value in (0, 1)]
    return parts[0].unionByName(parts[1])


@query(
    "label_union",
    with_views("payments")
    + "select transaction_number, amount, 0 as label from payments where is_fraud = 0"
    " union all select transaction_number, amount, 1 from payments where is_fraud = 1",
)
def label_union(spark, sf_dir):
    rows = view(spark, sf_dir, "payments")
    parts = [of_class(rows, value).select("transaction_number", "amount") for value in (0, 1)]
    return union_by_class(*parts, label="label")


@query(
    "hash_split",
    with_views("payments")
    + "select transaction_number, amount, substr(md5(transaction_number), 1, 4) < 'b333' as is_train"
    " from payments",
)
def hash_split(spark, sf_dir):
    rows = view(spark, sf_dir, "payments").select("transaction_number", "amount")
    train, test = split_by_hash(rows, "transaction_number")
    return train.withColumn("is_train", F.lit(True)).unionByName(
        test.withColumn("is_train", F.lit(False))
    )


# --- scalar functions


@query(
    "split_date_part",
    with_views("transactions_raw")
    + f"select transaction_number, split_part({_DATE_FORMS}, 'T', 1) as date_part"
    " from transactions_raw",
)
def split_date_part(spark, sf_dir):
    return view(spark, sf_dir, "transactions_raw").select(
        "transaction_number", date_part(F.expr(_DATE_FORMS)).alias("date_part")
    )


@query(
    "concat_date_time",
    with_views("transactions_raw")
    + f"select transaction_number, concat_ws(' ', {_DATE_FORMS}, transaction_time) as time_text"
    " from transactions_raw",
)
def concat_date_time(spark, sf_dir):
    text = joined_time_text(F.expr(_DATE_FORMS), F.col("transaction_time"))
    return view(spark, sf_dir, "transactions_raw").select(
        "transaction_number", text.alias("time_text")
    )


@query(
    "parse_transaction_time",
    with_views("transactions_raw")
    + f"""select transaction_number,
       try_strptime({_TIME_FORMS}, '%Y-%m-%d %H:%M:%S') as transaction_time
from transactions_raw""",
)
def parse_transaction_time(spark, sf_dir):
    return view(spark, sf_dir, "transactions_raw").select(
        "transaction_number", parse_time(F.expr(_TIME_FORMS)).alias("transaction_time")
    )


@query(
    "age_at_transaction",
    with_views("payments", "customers")
    + f"""select transaction_number, transaction_time, p.card_number,
       {age_sql('date_of_birth', 'transaction_time')} as age_at_transaction,
       {age_sql('transaction_time', 'date_of_birth')} as age_reversed
from payments p join customers c on p.card_number = c.card_number""",
)
def age_at_transaction(spark, sf_dir):
    """Ages, and negative ages when the dates are swapped."""
    born, at = F.col("date_of_birth"), F.col("transaction_time")
    customers = view(spark, sf_dir, "customers").select("card_number", "date_of_birth")
    return (
        view(spark, sf_dir, "payments")
        .join(customers, "card_number")
        .select(
            "transaction_number",
            "transaction_time",
            "card_number",
            age_in_years(born, at).alias("age_at_transaction"),
            age_in_years(at, born).alias("age_reversed"),
        )
    )


@query(
    "customer_age",
    with_views("customers")
    + f"select card_number, {age_sql('date_of_birth', repr(AS_OF))} as customer_age from customers",
)
def customer_age(spark, sf_dir):
    aged = with_customer_age(view(spark, sf_dir, "customers"), F.to_date(F.lit(AS_OF)))
    return aged.select("card_number", "customer_age")


@query(
    "geo_distance",
    with_views("cleaned", "customers")
    + f"""select transaction_number, distance_from_customer_address from (
  select t.*, {FEATURES_SQL}
  from cleaned t left join customers c on t.card_number = c.card_number)""",
)
def geo_distance(spark, sf_dir):
    """Distances, and null for cards without a customer."""
    customers = view(spark, sf_dir, "customers").select("card_number", "latitude", "longitude")
    distance = distance_km(
        F.col("latitude"),
        F.col("longitude"),
        F.col("merchant_latitude"),
        F.col("merchant_longitude"),
    )
    return (
        view(spark, sf_dir, "transactions_raw")
        .join(customers, "card_number", "left")
        .select("transaction_number", distance.alias("distance_from_customer_address"))
    )


@query(
    "parse_payment_json",
    with_views("typed")
    + """select partition, "offset", card_number, transaction_number, transaction_time, category,
       merchant_name from typed""",
)
def parse_payment_json(spark, sf_dir):
    return parse_payments(view(spark, sf_dir, "payments_json")).select(
        "partition",
        "offset",
        "card_number",
        "transaction_number",
        "transaction_time",
        "category",
        "merchant_name",
    )


@query(
    "typed_amounts",
    with_views("typed")
    + 'select partition, "offset", amount, merchant_latitude, merchant_longitude from typed',
)
def typed_amounts(spark, sf_dir):
    return parse_payments(view(spark, sf_dir, "payments_json")).select(
        "partition", "offset", "amount", "merchant_latitude", "merchant_longitude"
    )


@query(
    "zone_time_text",
    """select event_id, strftime(ts + interval 330 minute, '%Y-%m-%d %H:%M:%S') as zone_text,
       date_trunc('second', ts) as instant
from events""",
)
def zone_time_text(spark, sf_dir):
    """Wall clock of a zone as text, and back to the instant."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp"))
    text = zone_text(F.col("ts"), "Asia/Kolkata")
    return events.select(
        "event_id",
        text.alias("zone_text"),
        from_zone(parse_time(text), "Asia/Kolkata").alias("instant"),
    )


# the cleaning step is checked by itself as `load_transactions`; here it runs without files
@query(
    "clean_history",
    with_views("cleaned")
    + "select transaction_number, transaction_time, is_fraud from cleaned",
)
def clean_history(spark, sf_dir):
    return clean_transactions(view(spark, sf_dir, "transactions_raw")).select(
        "transaction_number", "transaction_time", "is_fraud"
    )
