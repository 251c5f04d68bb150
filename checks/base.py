"""Views over the given tables, and the register of queries.

A view is one SQL text that both engines read the same way; `{name}` stands for a given table.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txscore.session import new_folder, tune
from txscore.settings import Settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

VIEWS = {
    # customers in debt hold no card, so their payments are payments of unknown cards
    "customers": """
select cast(c_custkey as string) as card_number,
       substr(c_name, 1, 8) as first_name, substr(c_name, 10) as last_name,
       case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
       'street' as street, 'city' as city, cast(c_nationkey as string) as state, '00000' as zip,
       25e0 + (c_custkey * 7919 % 2400) / 100e0 as latitude,
       -125e0 + (c_custkey * 104729 % 5800) / 100e0 as longitude,
       c_mktsegment as job,
       cast(date '1940-01-01' + cast(c_custkey * 31 % 22000 as int) as timestamp) as date_of_birth
from {customer} where c_acctbal >= 0""",
    "transactions_raw": """
select cast(user_id as string) as card_number,
       cast(event_id as string) as transaction_number,
       substr(cast(ts as string), 1, 10) || 'T00:00:00.000Z' as transaction_date,
       substr(cast(ts as string), 12, 8) as transaction_time,
       cast(1704067200 + (day(ts) - 1) * 86400 + hour(ts) * 3600 + minute(ts) * 60 + second(ts)
            as bigint) as unix_time,
       event_type as category,
       'merchant_' || cast(event_id % 50 as string) as merchant_name,
       value as amount,
       25e0 + (event_id * 6007 % 2400) / 100e0 as merchant_latitude,
       -125e0 + (event_id * 3001 % 5800) / 100e0 as merchant_longitude,
       cast(value >= 100 and event_type in ('error', 'purchase') as int) as is_fraud
from {events}""",
    "payments_json": """
select case when event_id % 97 = 0 then 'not json' else
         '{{"card_number":"' || cast(user_id as string) ||
         '","transaction_number":"' || cast(event_id as string) ||
         '","transaction_time":"' || substr(cast(ts as string), 1, 19) ||
         '","category":"' || event_type ||
         '","merchant_name":"merchant_' || cast(event_id % 50 as string) ||
         '","amount":"' || case when event_id % 89 = 0 then 'x' else cast(value as string) end ||
         '","merchant_latitude":"' ||
         cast(25e0 + (event_id * 6007 % 2400) / 100e0 as string) ||
         '","merchant_longitude":"' ||
         cast(-125e0 + (event_id * 3001 % 5800) / 100e0 as string) || '"}}'
       end as value,
       cast(event_id % 3 as int) as partition, event_id as offset
from {events}""",
    "payments": """
select cast(o_custkey as string) as card_number,
       cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as transaction_number,
       l_shipdate as transaction_time,
       o_orderpriority as category,
       'supplier_' || cast(l_suppkey as string) as merchant_name,
       l_extendedprice as amount,
       25e0 + (l_suppkey * 6007 % 2400) / 100e0 as merchant_latitude,
       -125e0 + (l_suppkey * 3001 % 5800) / 100e0 as merchant_longitude,
       cast(l_extendedprice >= 90000 and l_returnflag = 'R' as int) as is_fraud
from {lineitem} join {orders} on l_orderkey = o_orderkey""",
}

# SQL twins of the library's own steps, for use in the oracles
_DISTANCE = """round(2 * 6371 * atan2(
         sqrt(pow(sin(radians(merchant_latitude - latitude) / 2), 2)
              + cos(radians(latitude)) * cos(radians(merchant_latitude))
                * pow(sin(radians(merchant_longitude - longitude) / 2), 2)),
         sqrt(1 - pow(sin(radians(merchant_latitude - latitude) / 2), 2)
              - cos(radians(latitude)) * cos(radians(merchant_latitude))
                * pow(sin(radians(merchant_longitude - longitude) / 2), 2))), 2)"""


def age_sql(born: str, at: str) -> str:
    days = f"date_diff('day', cast({born} as date), cast({at} as date))"
    return f"cast(trunc({days} / 365e0) as int)"


FEATURES_SQL = f"""{_DISTANCE} as distance_from_customer_address,
       {age_sql('date_of_birth', 'transaction_time')} as age_at_transaction"""

STEPS = {
    "cleaned": """
select card_number, transaction_number,
       strptime(split_part(transaction_date, 'T', 1) || ' ' || transaction_time,
                '%Y-%m-%d %H:%M:%S') as transaction_time,
       category, merchant_name, amount, merchant_latitude, merchant_longitude, is_fraud
from transactions_raw""",
    "history": f"""
select t.card_number, transaction_number, transaction_time, category, merchant_name, amount,
       merchant_latitude, merchant_longitude, is_fraud,
       {FEATURES_SQL}
from cleaned t join customers c on t.card_number = c.card_number""",
    "parsed": """
select value, partition, "offset",
       js->>'$.card_number' as card_number,
       js->>'$.transaction_number' as transaction_number,
       try_cast(js->>'$.transaction_time' as timestamp) as transaction_time,
       js->>'$.category' as category,
       js->>'$.merchant_name' as merchant_name,
       js->>'$.amount' as amount,
       js->>'$.merchant_latitude' as merchant_latitude,
       js->>'$.merchant_longitude' as merchant_longitude
from (select *, case when json_valid(value) then value end as js from payments_json)""",
    "typed": """
select value, partition, "offset", card_number, transaction_number, transaction_time, category,
       merchant_name,
       try_cast(amount as double) as amount,
       try_cast(merchant_latitude as double) as merchant_latitude,
       try_cast(merchant_longitude as double) as merchant_longitude
from parsed""",
    "outcome": f"""
select t.*, {FEATURES_SQL},
       case when t.card_number is null then 'malformed_json'
            when t.amount is null then 'bad_amount'
            when c.card_number is null then 'unknown_card' end as reject_reason
from typed t left join customers c on t.card_number = c.card_number""",
}
_NEEDS = {
    "cleaned": ["transactions_raw"],
    "history": ["cleaned", "customers"],
    "parsed": ["payments_json"],
    "typed": ["parsed"],
    "outcome": ["typed", "customers"],
}

SCORED_SQL = """card_number, transaction_time, transaction_number, category, merchant_name,
       amount, merchant_latitude, merchant_longitude, distance_from_customer_address,
       age_at_transaction"""


def with_views(*names: str) -> str:
    """`with` clause that defines the named views and steps and all they need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    texts = {**VIEWS, **STEPS}
    parts = []
    for name in ordered:
        tables = {t: t for t in _tables(VIEWS[name])} if name in VIEWS else None
        text = texts[name].format(**tables) if tables else texts[name]
        parts.append(f"{name} as ({text})")
    return "with " + ",\n".join(parts) + "\n"


def _tables(text: str) -> list[str]:
    return sorted({name for _, name, _, _ in string.Formatter().parse(text) if name})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in _tables(text)})


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream of its files, whether it is one file or a folder of them."""
    layout = table(spark, sf_dir, name).schema
    # a pattern, as the file source takes a plain path for a folder
    pattern = f"{sf_dir}/[{name[0]}]{name[1:]}.parquet"
    return spark.readStream.schema(layout).option("maxFilesPerTrigger", 1000).parquet(pattern)


def view_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    return spark.sql(text, **{t: table_stream(spark, sf_dir, t) for t in _tables(text)})


def scratch_settings(spark: SparkSession, **values: object) -> Settings:
    """Settings whose tables, models and checkpoint lie in a new shared folder."""
    root = new_folder(spark, "check")
    return Settings(
        warehouse=f"{root}/tables",
        preprocessor_path=f"{root}/models/preprocessor",
        forest_path=f"{root}/models/forest",
        checkpoint_location=f"{root}/checkpoint",
        topic="payments",
        customer_csv=f"{root}/customers_csv",
        transaction_csv=f"{root}/transactions_csv",
        replay_csv=f"{root}/replay_csv",
        **values,
    )


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows if SQL can say it."""

    def register(run: Query) -> Query:
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(tune(spark), sf_dir)

        QUERIES[name] = tuned
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register
