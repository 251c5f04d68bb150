"""Record layouts. Names, order and types are fixed values: inputs are bound by them."""

from pyspark.sql import types as T

CUSTOMER_CSV = T.StructType([
    T.StructField("card_number", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("street", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("job", T.StringType()),
    T.StructField("date_of_birth", T.TimestampType()),
])

CUSTOMER_TABLE = T.StructType([*CUSTOMER_CSV, T.StructField("customer_age", T.IntegerType())])

TRANSACTION_CSV = T.StructType([
    T.StructField("card_number", T.StringType()),
    T.StructField("transaction_number", T.StringType()),
    T.StructField("transaction_date", T.StringType()),
    T.StructField("transaction_time", T.StringType()),
    T.StructField("unix_time", T.LongType()),
    T.StructField("category", T.StringType()),
    T.StructField("merchant_name", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("merchant_latitude", T.DoubleType()),
    T.StructField("merchant_longitude", T.DoubleType()),
    T.StructField("is_fraud", T.IntegerType()),
])

# JSON payment: numbers travel as text and are typed after parsing
PAYMENT_JSON = T.StructType([
    T.StructField("card_number", T.StringType()),
    T.StructField("transaction_number", T.StringType()),
    T.StructField("transaction_time", T.TimestampType()),
    T.StructField("category", T.StringType()),
    T.StructField("merchant_name", T.StringType()),
    T.StructField("amount", T.StringType()),
    T.StructField("merchant_latitude", T.StringType()),
    T.StructField("merchant_longitude", T.StringType()),
])

# what is stored for each payment, whichever class it belongs to
SCORED = T.StructType([
    T.StructField("card_number", T.StringType()),
    T.StructField("transaction_time", T.TimestampType()),
    T.StructField("transaction_number", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("merchant_name", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("merchant_latitude", T.DoubleType()),
    T.StructField("merchant_longitude", T.DoubleType()),
    T.StructField("distance_from_customer_address", T.DoubleType()),
    T.StructField("age_at_transaction", T.IntegerType()),
])

# what is stored with a payment; is_fraud is a folder of each part
SCORED_SLICES = T.StructType([
    T.StructField("label_source", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("is_fraud", T.IntegerType()),
])

# columns of stored payments that say which write they come from, if they were merged
MERGED = T.StructType([
    T.StructField("sequence", T.LongType()),
    T.StructField("is_current", T.BooleanType()),
])

REJECTS = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("reject_reason", T.StringType()),
])

OFFSETS = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

BATCH_SLICES = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])

STREAM_METRICS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("started_at", T.StringType()),
    T.StructField("n_read", T.LongType()),
    T.StructField("n_stored", T.LongType()),
    T.StructField("n_rejected", T.LongType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("end_offsets", T.StringType()),
])

# how often a value stands in a column of current payments; classes under the column `is_fraud`
COUNTS = T.StructType([
    T.StructField("column_name", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("is_usable", T.BooleanType()),
    T.StructField("trains", T.BooleanType()),
    T.StructField("n", T.LongType()),
])

VERSIONS = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("committed_at", T.TimestampType()),
])

SCORED_COLUMNS = SCORED.fieldNames()
PAYMENT_COLUMNS = PAYMENT_JSON.fieldNames()
MODEL_COLUMNS = [
    "card_number",
    "category",
    "merchant_name",
    "distance_from_customer_address",
    "amount",
    "age_at_transaction",
]
# columns of the header-less replay file, by position
REPLAY_POSITIONS = {
    "card_number": 0,
    "transaction_number": 3,
    "category": 7,
    "merchant_name": 8,
    "amount": 9,
    "merchant_latitude": 10,
    "merchant_longitude": 11,
}
