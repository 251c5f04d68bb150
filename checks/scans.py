"""Sources, sinks and stream positions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import (
    SCORED_SQL,
    age_sql,
    query,
    scratch_settings,
    view,
    with_views,
)
from txscore.operators.latest import latest_by_key
from txscore.operators.offsets import max_offset_per_partition, start_position
from txscore.operators.history import clean_transactions
from txscore.plans import load_history as load
from txscore.plans.merge_tables import fold_payments
from txscore.plans.replay import encode_payments, replay
from txscore.schemas import CUSTOMER_CSV, CUSTOMER_TABLE, TRANSACTION_CSV
from txscore.functions import zone_text
from txscore.sources.csv import read_csv, read_replay_csv
from txscore.sources.kafka import project_records
from txscore.sources.manifest import commit
from txscore.sources.tables import (
    append_table,
    current_scored,
    read_scored,
    read_snapshot,
    read_table,
    write_part,
)
from txscore.streaming.scoring import stored_offsets

AS_OF = "2024-01-01"


def history_settings(spark, sf_dir):
    """Settings whose history files hold the customers and the transactions of the tables."""
    cfg = scratch_settings(spark)
    view(spark, sf_dir, "customers").write.option("header", True).csv(cfg.customer_csv)
    view(spark, sf_dir, "transactions_raw").write.option("header", True).csv(cfg.transaction_csv)
    return cfg


@query("csv_scan_customers", with_views("customers") + "select * from customers")
def csv_scan_customers(spark, sf_dir):
    path = scratch_settings(spark).customer_csv
    view(spark, sf_dir, "customers").write.option("header", True).csv(path)
    return read_csv(spark, path, CUSTOMER_CSV)


@query(
    "load_customers",
    with_views("customers")
    + f"select *, {age_sql('date_of_birth', repr(AS_OF))} as customer_age from customers",
)
def load_customers(spark, sf_dir):
    cfg = scratch_settings(spark)
    view(spark, sf_dir, "customers").write.option("header", True).csv(cfg.customer_csv)
    load.load_customers(spark, cfg, "first", F.to_date(F.lit(AS_OF)))
    return read_snapshot(spark, cfg, cfg.customer_table, CUSTOMER_TABLE)


@query("load_transactions", with_views("cleaned") + "select * from cleaned")
def load_transactions(spark, sf_dir):
    path = scratch_settings(spark).transaction_csv
    view(spark, sf_dir, "transactions_raw").write.option("header", True).csv(path)
    return clean_transactions(read_csv(spark, path, TRANSACTION_CSV))


@query(
    "load_history",
    with_views("history") + f"select {SCORED_SQL}, is_fraud, 'loaded' as label_source from history",
)
def load_history(spark, sf_dir):
    cfg = history_settings(spark, sf_dir)
    load.load_history(spark, cfg, "first", F.to_date(F.lit(AS_OF)))
    return read_scored(spark, cfg).drop("run_id", "batch_id")


# every kind of broken history row, by the number of the payment
_BREAKS = {"transaction_date": 53, "amount": 59, "merchant_latitude": 61, "is_fraud": 67, "card_number": 71}


def broken_settings(spark, sf_dir):
    """Like `history_settings`, with rows of the transactions broken."""
    cfg = scratch_settings(spark)
    view(spark, sf_dir, "customers").write.option("header", True).csv(cfg.customer_csv)
    rows = view(spark, sf_dir, "transactions_raw")
    number = F.col("transaction_number").cast("long")
    wrong = {"transaction_date": None, "amount": "x", "merchant_latitude": "nan?", "is_fraud": None, "card_number": None}
    rows = rows.withColumns({
        c: F.when(number % n == 0, F.lit(wrong[c])).otherwise(F.col(c).cast("string"))
        for c, n in _BREAKS.items()
    })
    rows.write.option("header", True).csv(cfg.transaction_csv)
    return cfg


def _unless_broken(column: str) -> str:
    return f"case when cast(t.transaction_number as bigint) % {_BREAKS[column]} <> 0 then t.{column} end"


_OUTCOMES = (
    with_views("transactions_raw", "cleaned", "customers")
    + f""", broken as (
  select {_unless_broken('card_number')} as card_number, t.transaction_number,
    case when cast(t.transaction_number as bigint) % {_BREAKS['transaction_date']} <> 0
      then t.transaction_time end as transaction_time,
    t.category, t.merchant_name, {_unless_broken('amount')} as amount,
    {_unless_broken('merchant_latitude')} as merchant_latitude, t.merchant_longitude,
    {_unless_broken('is_fraud')} as is_fraud,
    case when cast(t.transaction_number as bigint) % {_BREAKS['amount']} = 0
           or cast(t.transaction_number as bigint) % {_BREAKS['merchant_latitude']} = 0
      then concat_ws(',', coalesce({_unless_broken('card_number')}, ''), r.transaction_number,
        coalesce(case when cast(t.transaction_number as bigint) % {_BREAKS['transaction_date']} <> 0
          then r.transaction_date end, ''), r.transaction_time, r.unix_time, r.category, r.merchant_name,
        coalesce(cast({_unless_broken('amount')} as varchar), 'x'),
        coalesce(cast({_unless_broken('merchant_latitude')} as varchar), 'nan?'), r.merchant_longitude,
        coalesce(cast({_unless_broken('is_fraud')} as varchar), '')) end as raw_line
  from cleaned t join transactions_raw r on t.transaction_number = r.transaction_number),
outcomes as (
  select t.*, case when t.card_number is null then 'missing_card'
    when t.transaction_time is null then 'bad_time' when t.amount is null then 'bad_amount'
    when t.merchant_latitude is null then 'bad_location'
    when not exists (select 1 from customers c where c.card_number = t.card_number) then 'unknown_card'
    when t.is_fraud is null then 'no_label' end as reject_reason
  from broken t)
"""
)


@query("load_rejects", _OUTCOMES + "select * from outcomes where reject_reason is not null")
def load_rejects(spark, sf_dir):
    cfg = broken_settings(spark, sf_dir)
    load.load_customers(spark, cfg, "first", F.to_date(F.lit(AS_OF)))
    return load.history_rejects(spark, cfg)


@query(
    "load_report",
    _OUTCOMES
    + "select coalesce(reject_reason, 'stored') as outcome, count(*) as n from outcomes group by 1",
)
def load_report(spark, sf_dir):
    """What the load says of its input: stored or rejected, and why."""
    cfg = broken_settings(spark, sf_dir)
    report = load.load_history(spark, cfg, "first", F.to_date(F.lit(AS_OF)))
    rows = [(name, n) for name, n in report.items() if n]
    return spark.createDataFrame(rows, "outcome string, n long")


@query(
    "malformed_lines",
    with_views("transactions_raw")
    + """select case when n % 2 = 0 then card_number || ',' || transaction_number || ',' || transaction_date
         else concat_ws(',', card_number, transaction_number, transaction_date, transaction_time, unix_time,
           category, merchant_name, amount, merchant_latitude, merchant_longitude, is_fraud, '"a,b"') end
         as raw_line, 'malformed_csv' as reject_reason
from (select *, cast(transaction_number as bigint) as n from transactions_raw) where n % 31 = 0""",
)
def malformed_lines(spark, sf_dir):
    """Lines with too few and with too many fields among good ones, as the load rejects them."""
    cfg = history_settings(spark, sf_dir)
    rows = view(spark, sf_dir, "transactions_raw")
    n = F.col("transaction_number").cast("long")
    short = F.concat_ws(",", "card_number", "transaction_number", "transaction_date")
    long = F.concat_ws(",", *[F.col(c).cast("string") for c in rows.columns], F.lit('"a,b"'))
    lines = rows.filter(n % 31 == 0).select(F.when(n % 2 == 0, short).otherwise(long).alias("value"))
    # a file of text begins with the names, as every file of the history does
    header = spark.range(1).select(F.lit(",".join(rows.columns)).alias("value"))
    header.unionAll(lines).coalesce(1).write.mode("append").text(cfg.transaction_csv)
    load.load_customers(spark, cfg, "first", F.to_date(F.lit(AS_OF)))
    rejects = load.history_rejects(spark, cfg)
    return rejects.filter("reject_reason = 'malformed_csv'").select("raw_line", "reject_reason")


def _amounts(spark, cfg, rows, *factors):
    """Files that hold every payment once per factor, its amount multiplied, in that order.

    A union keeps the tasks of its sides in order, and files are numbered by task: no sort is needed.
    """
    both = rows.withColumn("amount", F.col("amount") * factors[0])
    for factor in factors[1:]:
        both = both.unionAll(rows.withColumn("amount", F.col("amount") * factor))
    both.write.mode("overwrite").option("header", True).csv(cfg.transaction_csv)


_CURRENT = "select transaction_number, amount, run_id, is_fraud from"


@query(
    "upsert_repeats_in_one_load",
    with_views("history")
    + f"{_CURRENT} (select * replace (amount * 4 as amount), 'second' as run_id from history)",
)
def upsert_repeats_in_one_load(spark, sf_dir):
    """Files that hold every payment three times, loaded three times: their last rows stay."""
    cfg = history_settings(spark, sf_dir)
    _amounts(spark, cfg, view(spark, sf_dir, "transactions_raw"), 1, 2, 4)
    for load_id in ("first", "first", "second"):
        load.load_history(spark, cfg, load_id, F.to_date(F.lit(AS_OF)))
    return current_scored(spark, cfg).select("transaction_number", "amount", "run_id", "is_fraud")


@query(
    "upsert_after_compaction",
    with_views("history")
    + f"""{_CURRENT} (select * replace (
        case when cast(transaction_number as bigint) % 3 = 0 then amount * 2 else amount end as amount),
      case when cast(transaction_number as bigint) % 3 = 0 then 'second' else 'first' end as run_id
    from history)""",
)
def upsert_after_compaction(spark, sf_dir):
    """A load folded into the base, then a third of the payments written again beside it."""
    cfg = history_settings(spark, sf_dir)
    rows = view(spark, sf_dir, "transactions_raw")
    load.load_customers(spark, cfg, "first", F.to_date(F.lit(AS_OF)))
    load.load_transactions(spark, cfg, "first")
    fold_payments(spark, cfg, always=True)
    _amounts(spark, cfg, rows.filter(F.col("transaction_number").cast("long") % 3 == 0), 1, 2)
    load.load_transactions(spark, cfg, "second")
    return current_scored(spark, cfg).select("transaction_number", "amount", "run_id", "is_fraud")


@query(
    "load_twice_two_ids",
    with_views("history") + f"select {SCORED_SQL}, is_fraud, 'second/2' as run_id from history",
)
def load_twice_two_ids(spark, sf_dir):
    """The same files loaded under two ids: each payment once, as last written."""
    cfg = history_settings(spark, sf_dir)
    for load_id in ("first", "second/2"):
        load.load_history(spark, cfg, load_id, F.to_date(F.lit(AS_OF)))
    return current_scored(spark, cfg).drop("label_source", "batch_id")


@query(
    "customers_corrected",
    with_views("customers")
    + f"""select * replace (case when cast(card_number as bigint) % 3 = 0 then latitude + 1e0 else latitude end
  as latitude), {age_sql('date_of_birth', repr(AS_OF))} as customer_age from customers""",
)
def customers_corrected(spark, sf_dir):
    """Every customer twice in the file, then a corrected file under the same id."""
    cfg = scratch_settings(spark)
    customers = view(spark, sf_dir, "customers")
    moved = F.when(F.col("card_number").cast("long") % 3 == 0, F.col("latitude") + 1)
    corrected = customers.withColumn("latitude", F.coalesce(moved, "latitude"))
    for rows in (customers.withColumn("city", F.lit("old")), corrected):
        twice = rows.unionAll(rows)
        twice.write.mode("overwrite").option("header", True).csv(cfg.customer_csv)
        load.load_customers(spark, cfg, "2024/01/01", F.to_date(F.lit(AS_OF)))
    return read_snapshot(spark, cfg, cfg.customer_table, CUSTOMER_TABLE)


@query("table_scan", with_views("payments") + "select * from payments")
def table_scan(spark, sf_dir):
    cfg = scratch_settings(spark)
    append_table(view(spark, sf_dir, "payments"), cfg, "payments")
    return read_table(spark, cfg, "payments")


@query(
    "table_append",
    with_views("payments", "cleaned")
    + "select card_number, transaction_number, amount from payments"
    " union all select card_number, transaction_number, amount from cleaned",
)
def table_append(spark, sf_dir):
    cfg = scratch_settings(spark)
    for name in ("payments", "transactions_raw"):
        rows = view(spark, sf_dir, name).select("card_number", "transaction_number", "amount")
        append_table(rows, cfg, "appended")
    return read_table(spark, cfg, "appended")


@query(
    "record_projection",
    with_views("payments_json") + 'select value, partition, "offset" from payments_json',
)
def record_projection(spark, sf_dir):
    consumed = view(spark, sf_dir, "payments_json").select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("payments").alias("topic"),
        "partition",
        "offset",
    )
    return project_records(consumed)


_OFFSETS = with_views("payments_json") + (
    'select partition, max("offset") as "offset" from payments_json group by partition'
)


@query("max_offset_per_partition", _OFFSETS)
def max_offsets(spark, sf_dir):
    return max_offset_per_partition(view(spark, sf_dir, "payments_json"))


@query("stored_offsets", _OFFSETS)
def offsets_after_batches(spark, sf_dir):
    """Positions of two topics, one row per batch (here a record length) and partition, looked up for one."""
    cfg = scratch_settings(spark)
    records = view(spark, sf_dir, "payments_json").withColumn(
        "batch_id", F.length("value").cast("long")
    )
    batches = records.groupBy("partition", "batch_id").agg(F.max("offset").alias("offset"))
    rows = batches.select(F.lit(cfg.topic).alias("topic"), "partition", "offset")
    other = rows.withColumns({"topic": F.lit("other"), "offset": F.col("offset") + 1})
    parts = [write_part(r, cfg, cfg.offset_table, k) for k, r in (("mine", rows), ("other", other))]
    commit(spark, cfg, parts)
    return stored_offsets(spark, cfg)


@query(
    "starting_offsets_json",
    with_views("payments_json")
    + """, done as (select partition, max("offset") + 1 as next_offset from payments_json
              group by partition)
select '{"payments":{' || string_agg('"' || partition || '":' || next_offset, ',' order by partition)
         || '}}' as starting_offsets,
       '{"payments":[' || string_agg(cast(partition as string), ',' order by partition) || ']}'
         as assigned
from done""",
)
def starting_offsets_json(spark, sf_dir):
    return start_position(view(spark, sf_dir, "payments_json"), "payments")


@query(
    "starting_offsets_new_partition",
    with_views("payments_json")
    + """, done as (select partition, max("offset") + 1 as next_offset from payments_json
              where partition <> 1 group by partition),
starts as (select p.partition, coalesce(next_offset, -2) as next_offset
           from (select distinct partition from payments_json) p left join done using (partition))
select '{"payments":{' || string_agg('"' || partition || '":' || next_offset, ',' order by partition)
         || '}}' as starting_offsets,
       '{"payments":[' || string_agg(cast(partition as string), ',' order by partition) || ']}'
         as assigned
from starts""",
)
def starting_offsets_new_partition(spark, sf_dir):
    """A partition that has no stored position starts at its first record."""
    records = view(spark, sf_dir, "payments_json")
    stored = records.filter("partition <> 1")
    return start_position(stored, "payments", records.select("partition"))


# the payment columns at the positions of the replay file, filler elsewhere
_REPLAY_LAYOUT = [
    "card_number",
    "transaction_date",
    "transaction_time",
    "transaction_number",
    "unix_time",
    "is_fraud",
    "transaction_date",
    "category",
    "merchant_name",
    "amount",
    "merchant_latitude",
    "merchant_longitude",
]


def _replay_file(spark, sf_dir, path):
    rows = view(spark, sf_dir, "transactions_raw")
    rows.select(*[F.col(c).alias(f"f{i}") for i, c in enumerate(_REPLAY_LAYOUT)]).write.option(
        "escape", '"'
    ).csv(path)


@query(
    "csv_positional_pick",
    with_views("transactions_raw")
    + """select card_number, transaction_number, category, merchant_name,
       cast(amount as string) as amount, cast(merchant_latitude as string) as merchant_latitude,
       cast(merchant_longitude as string) as merchant_longitude
from transactions_raw""",
)
def csv_positional_pick(spark, sf_dir):
    path = scratch_settings(spark).replay_csv
    _replay_file(spark, sf_dir, path)
    return read_replay_csv(spark, path)


def _payload_sql(time: str, merchant: str, source: str) -> str:
    return f"""
select '{{"card_number":"' || card_number || '","transaction_number":"' || transaction_number ||
       '","transaction_time":"' || {time} || '","category":"' || category ||
       {merchant} || '","amount":"' || cast(amount as string) ||
       '","merchant_latitude":"' || cast(merchant_latitude as string) ||
       '","merchant_longitude":"' || cast(merchant_longitude as string) || '"}}' as value
from {source}"""


@query(
    "encode_payment_json",
    with_views("cleaned")
    + _payload_sql(
        "strftime(transaction_time + interval 330 minute, '%Y-%m-%d %H:%M:%S')",
        "case when category = 'view' then '' else '\",\"merchant_name\":\"' || merchant_name end",
        "cleaned",
    ),
)
def encode_payment_json(spark, sf_dir):
    """JSON payments with the wall clock of the replay zone; a null field is left out."""
    payments = clean_transactions(view(spark, sf_dir, "transactions_raw")).withColumns({
        "transaction_time": zone_text(F.col("transaction_time"), "Asia/Kolkata"),
        "merchant_name": F.when(F.col("category") != "view", F.col("merchant_name")),
    })
    return encode_payments(payments)


@query(
    "replay_file",
    with_views("transactions_raw")
    + _payload_sql(
        "'2024-01-01 05:30:00'", "'\",\"merchant_name\":\"' || merchant_name", "transactions_raw"
    ),
)
def replay_file(spark, sf_dir):
    """Replay job end to end, into text files, with the sending time held at one instant."""
    cfg = scratch_settings(spark)
    _replay_file(spark, sf_dir, cfg.replay_csv)
    sent = f"{cfg.warehouse}/sent"
    replay(spark, cfg, sink="text", path=sent, sent_at=F.lit(AS_OF).cast("timestamp"))
    return spark.read.text(sent)


@query(
    "latest_per_transaction",
    with_views("payments")
    + """select * exclude (place) from (
  select *, row_number() over (
    partition by transaction_number
    order by transaction_time desc, amount desc, card_number, category, merchant_name, is_fraud
  ) as place from payments) where place = 1""",
)
def latest_per_transaction(spark, sf_dir):
    return latest_by_key(
        view(spark, sf_dir, "payments"),
        "transaction_number",
        F.col("transaction_time").desc(),
        F.col("amount").desc(),
        F.col("card_number"),
        F.col("category"),
        F.col("merchant_name"),
        F.col("is_fraud"),
    )
