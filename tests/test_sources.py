import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txscore.operators.columns import rename_columns
from txscore.operators.offsets import LATEST, start_position
from txscore.schemas import CUSTOMER_CSV, OFFSETS, SCORED
from txscore.settings import Settings
from txscore.sources.csv import read_csv, read_replay_csv
from txscore.sources.kafka import sink_options, source_options, write_records
from txscore.sources.tables import (
    append_table,
    commit_version,
    current_scored,
    latest_version,
    read_class,
    read_scored,
    read_snapshot,
    read_table,
    upsert_snapshot,
    write_by_class,
)

CUSTOMERS = T.StructType([
    T.StructField("card_number", T.StringType()),
    T.StructField("city", T.StringType()),
])


@pytest.fixture
def cfg(tmp_path):
    return Settings(warehouse=str(tmp_path / "tables"), topic="payments")


def payments(spark, labels):
    rows = spark.createDataFrame([(str(i), v) for i, v in enumerate(labels)], "n string, label int")
    return rows.select(
        *[
            (F.col("n") if f.name == "transaction_number" else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in SCORED
        ],
        F.col("label").alias("is_fraud"),
    )


def test_csv_binds_by_position_and_nulls_bad_fields(spark, tmp_path):
    header = ",".join(f"h{i}" for i in range(12))
    lines = [
        header,
        "1,a,b,F,s,c,st,z,25.5,-1.5,job,1980-01-02",
        "2,a,b,F,s,c,st,z,north,-1.5,job,never",
        "3,a",
    ]
    path = tmp_path / "customers.csv"
    path.write_text("\n".join(lines))
    rows = read_csv(spark, str(path), CUSTOMER_CSV).orderBy("card_number").collect()
    assert [r["card_number"] for r in rows] == ["1", "2", "3"]
    assert rows[0]["latitude"] == 25.5 and rows[0]["date_of_birth"] is not None
    assert rows[1]["latitude"] is None and rows[1]["date_of_birth"] is None
    assert rows[1]["longitude"] == -1.5
    assert rows[2]["city"] is None


def test_replay_csv_picks_by_position(spark, tmp_path):
    path = tmp_path / "replay.csv"
    path.write_text('7,,,n1,,,,food,"Shop ""A"", Ltd",9.5,1.0,2.0\n8,,,n2,,,,,M,1,2,3\n')
    first, second = read_replay_csv(spark, str(path)).orderBy("card_number").collect()
    assert first["merchant_name"] == 'Shop "A", Ltd'
    assert (first["transaction_number"], first["amount"]) == ("n1", "9.5")
    assert second["category"] == ""


def test_empty_tables_read_as_empty(spark, cfg):
    assert read_scored(spark, cfg).count() == 0
    assert read_snapshot(spark, cfg, "customers", CUSTOMERS).count() == 0
    assert latest_version(spark, cfg, "models") is None


def test_missing_table_without_schema_fails(spark, cfg):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_table(spark, cfg, "nothing")


def test_append_keeps_earlier_rows(spark, cfg):
    for _ in range(2):
        append_table(spark.range(3), cfg, "numbers")
    assert read_table(spark, cfg, "numbers").count() == 6


@pytest.mark.parametrize("compact", [False, True])
def test_route_drops_other_labels(spark, cfg, compact):
    write_by_class(payments(spark, [0, 1, None, 2, 0]), cfg, "loaded", "a", 0, compact)
    numbers = [
        sorted(r["transaction_number"] for r in read_class(spark, cfg, c).collect()) for c in (0, 1)
    ]
    assert numbers == [["0", "4"], ["1"]]


def test_predictions_between_the_classes_go_nowhere(spark, cfg):
    rows = payments(spark, [0, 1, 2, 3]).withColumn(
        "is_fraud", F.expr("element_at(array(0D, 0.5D, 1D, double('NaN')), is_fraud + 1)")
    )
    write_by_class(rows, cfg, "predicted", "a", 0)
    stored = {r["transaction_number"]: r["is_fraud"] for r in read_scored(spark, cfg).collect()}
    assert stored == {"0": 0, "2": 1}


def test_repeated_slice_leaves_one_copy(spark, cfg):
    write_by_class(payments(spark, [0, 1, 1]), cfg, "predicted", "a", 0)
    write_by_class(payments(spark, [0]), cfg, "predicted", "a", 1)
    # the same batch again, now with a model that finds no fraud
    write_by_class(payments(spark, [0, 0, 0]), cfg, "predicted", "a", 0)
    assert read_class(spark, cfg, 1, latest=False).count() == 0
    assert read_class(spark, cfg, 0, latest=False).count() == 4
    # the payment of both batches is one, as it was written last
    newest = {r["transaction_number"]: r["batch_id"] for r in read_class(spark, cfg, 0).collect()}
    assert newest == {"0": 0, "1": 0, "2": 0}


def test_reading_a_class_prunes_folders(spark, cfg):
    write_by_class(payments(spark, [0, 1]), cfg, "loaded", "a", 0)
    plan = read_class(spark, cfg, 1, latest=False)._jdf.queryExecution().executedPlan().toString()
    assert "is_fraud" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_snapshot_replaces_keys_that_come_again(spark, cfg):
    def customers(*rows):
        return spark.createDataFrame(list(rows), CUSTOMERS)

    upsert_snapshot(spark, customers(("1", "a"), ("2", "b")), cfg, "customers", "card_number", "v1")
    before = read_snapshot(spark, cfg, "customers", CUSTOMERS)
    upsert_snapshot(spark, customers(("2", "B"), ("3", "C")), cfg, "customers", "card_number", "v2")
    now = read_snapshot(spark, cfg, "customers", CUSTOMERS).orderBy("card_number").collect()
    assert [tuple(r) for r in now] == [("1", "a"), ("2", "B"), ("3", "C")]
    assert before.count() == 2
    # a corrected second try of the version: what only the first try had is gone
    upsert_snapshot(spark, customers(("2", "b2"), ("2", "b1")), cfg, "customers", "card_number", "v2")
    now = read_snapshot(spark, cfg, "customers", CUSTOMERS).orderBy("card_number").collect()
    assert [tuple(r) for r in now] == [("1", "a"), ("2", "b2")]
    upsert_snapshot(spark, customers(("4", "d")), cfg, "customers", "card_number", "v1")
    now = read_snapshot(spark, cfg, "customers", CUSTOMERS).orderBy("card_number").collect()
    assert [tuple(r) for r in now] == [("1", "a"), ("2", "b2"), ("4", "d")]


@pytest.mark.parametrize("run_id", ["2024/01/01", "a=b", "50%", "x y", "é"])
def test_any_id_names_a_slice(spark, cfg, run_id):
    write_by_class(payments(spark, [0, 1]), cfg, "loaded", run_id, 0)
    write_by_class(payments(spark, [0, 1]), cfg, "loaded", run_id, 0)
    assert [r["run_id"] for r in read_scored(spark, cfg).collect()] == [run_id] * 2


def test_rows_without_a_number_all_stay(spark, cfg):
    rows = payments(spark, [0, 1]).withColumn("transaction_number", F.lit(None).cast("string"))
    for batch in (0, 1):
        write_by_class(rows, cfg, "loaded", "a", batch)
    assert current_scored(spark, cfg).count() == 4


def test_nothing_stored_reads_as_empty(spark, cfg):
    assert current_scored(spark, cfg, ("loaded",)).count() == 0


def test_latest_version_is_the_last_committed(spark, cfg):
    for version in ("b", "a"):
        commit_version(spark, cfg, "models", version)
    commit_version(spark, cfg, "other", "z")
    assert latest_version(spark, cfg, "models") == "a"


def test_rename_names_what_is_missing(spark):
    df = spark.range(1).withColumn("prediction", F.lit(1.0))
    assert rename_columns(df, {"prediction": "is_fraud"}).columns == ["id", "is_fraud"]
    with pytest.raises(ValueError, match="customer_age"):
        rename_columns(df, {"customer_age": "age"})


def test_source_by_topic(cfg):
    options = source_options(cfg)
    assert options["subscribe"] == "payments" and options["startingOffsets"] == "latest"
    assert "assign" not in options


def test_source_from_stored_offsets(spark, cfg):
    stored = spark.createDataFrame([(cfg.topic, 0, 5), (cfg.topic, 10, 7), (cfg.topic, 2, 9), (cfg.topic, 0, 8)], OFFSETS)
    position = start_position(stored, cfg.topic).first()
    options = source_options(cfg, position["starting_offsets"], position["assigned"])
    assert options["startingOffsets"] == '{"payments":{"0":9,"2":10,"10":8}}'
    assert options["assign"] == '{"payments":[0,2,10]}'
    assert "subscribe" not in options


def test_new_partitions_get_a_start(spark, cfg):
    stored = spark.createDataFrame([(cfg.topic, 0, 5), (cfg.topic, 7, 1)], OFFSETS)
    now = spark.createDataFrame([(0,), (1,), (2,)], "partition int")
    position = start_position(stored, cfg.topic, now).first()
    assert position["starting_offsets"] == '{"payments":{"0":6,"1":-2,"2":-2,"7":2}}'
    options = source_options(cfg, position["starting_offsets"])
    assert options["subscribe"] == "payments" and "assign" not in options
    latest = start_position(stored, cfg.topic, now, LATEST).first()
    assert latest["starting_offsets"] == '{"payments":{"0":6,"1":-1,"2":-1,"7":2}}'


def test_no_stored_offsets_no_position(spark, cfg):
    assert start_position(spark.createDataFrame([], OFFSETS), cfg.topic).first() is None


def test_sink_options(cfg):
    options = sink_options(cfg)
    assert options["kafka.acks"] == "all" and options["topic"] == "payments"


def test_text_sink(spark, cfg, tmp_path):
    path = str(tmp_path / "sent")
    write_records(spark.createDataFrame([("a",)], "value string"), cfg, "text", path)
    assert spark.read.text(path).first()["value"] == "a"


def test_settings_from_dict():
    cfg = Settings.from_dict({"warehouse": "w", "batch_interval_ms": "500"})
    assert (cfg.warehouse, cfg.batch_interval_ms) == ("w", 500)
    with pytest.raises(ValueError, match="warehose"):
        Settings.from_dict({"warehose": "w"})


def test_settings_from_spark(spark):
    spark.conf.set("spark.txscore.topic", "t")
    spark.conf.set("spark.txscore.table_options.connection.host", "h")
    try:
        cfg = Settings.from_spark(spark)
    finally:
        spark.conf.unset("spark.txscore.topic")
        spark.conf.unset("spark.txscore.table_options.connection.host")
    assert cfg.topic == "t" and cfg.table_options == {"connection.host": "h"}
    assert cfg.batch_interval_ms == 10_000
