import pytest
from pyspark.sql import functions as F

from checks import scans
from checks.base import view
from txscore.plans.load_history import history_rejects, load_history
from txscore.plans.replay import replay
from txscore.plans.train_models import TrainingOptions, train_models
from txscore.settings import Settings
from txscore.sources.models import newest_model_version
from txscore.sources.tables import read_class, read_scored, read_table
from txscore.operators.enrich import parse_payments
from txscore.operators.latest import latest_scored
from txscore.streaming.scoring import score_batch


@pytest.fixture
def cfg(spark, sf_dir, tmp_path):
    cfg = Settings(
        warehouse=str(tmp_path / "tables"),
        customer_csv=str(tmp_path / "customers"),
        transaction_csv=str(tmp_path / "transactions"),
        preprocessor_path=str(tmp_path / "preprocessor"),
        forest_path=str(tmp_path / "forest"),
    )
    view(spark, sf_dir, "customers").write.option("header", True).csv(cfg.customer_csv)
    odd = (
        F.when(F.col("transaction_number") == "3", None)
        .when(F.col("transaction_number") == "4", 2)
        .otherwise(F.col("is_fraud"))
    )
    rows = view(spark, sf_dir, "transactions_raw").withColumns({
        "is_fraud": odd,
        "card_number": F.when(F.col("transaction_number") != "5", F.col("card_number")),
    })
    rows.write.option("header", True).csv(cfg.transaction_csv)
    return cfg


def test_load_counts_and_repeats(spark, sf_dir, cfg):
    report = load_history(spark, cfg, "day-1")
    total = view(spark, sf_dir, "transactions_raw").count()
    assert sum(report.values()) == total
    assert report["missing_card"] == 1
    assert 1 <= report["no_label"] <= 2
    assert read_scored(spark, cfg).count() == report["stored"]
    assert load_history(spark, cfg, "day-1", compact=True) == report
    assert read_scored(spark, cfg).count() == report["stored"]
    reasons = {
        r["reject_reason"]: r["count"]
        for r in history_rejects(spark, cfg).groupBy("reject_reason").count().collect()
    }
    assert reasons == {k: n for k, n in report.items() if n and k != "stored"}


def test_predictions_become_training_rows_unless_left_out(spark, sf_dir, cfg):
    loaded = load_history(spark, cfg, "day-1")["stored"]
    options = TrainingOptions(trees=3)
    assert train_models(spark, cfg, "v1", options).first()["n_rows"] == loaded

    def by_amount(payments):
        return payments.withColumn("prediction", (F.col("amount") >= 100).cast("double"))

    score_batch(view(spark, sf_dir, "payments_json"), 0, "run", cfg, by_amount)
    assert read_class(spark, cfg, 0).filter("label_source = 'predicted'").count() > 0
    # most numbers were loaded before, and count once
    numbers = read_scored(spark, cfg).select("transaction_number").distinct().count()
    assert loaded <= numbers < read_scored(spark, cfg).count()
    assert train_models(spark, cfg, "v2", options).first()["n_rows"] == numbers
    only = TrainingOptions(trees=3, label_sources=("loaded",))
    assert train_models(spark, cfg, "v3", only).first()["n_rows"] == loaded
    assert newest_model_version(spark, cfg) == "v3"
    # the same version again, as after a failed run
    train_models(spark, cfg, "v3", only)
    metrics = read_table(spark, cfg, cfg.metric_table)
    assert sorted(r["version"] for r in metrics.collect()) == ["v1", "v2", "v3"]


def test_replay_to_text(spark, cfg, tmp_path):
    file = tmp_path / "replay.csv"
    file.write_text("7,,,n1,,,,food,shop,9.5,1.0,2.0\n")
    cfg = Settings(replay_csv=str(file))
    sent = str(tmp_path / "sent")
    replay(spark, cfg, "text", sent, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    text = spark.read.text(sent).first()["value"]
    assert '"transaction_time":"2024-01-01 05:30:00"' in text
    record = spark.createDataFrame([(text, 0, 0)], "value string, partition int, offset long")
    back = parse_payments(record, "Asia/Kolkata").first()
    assert back["reject_reason"] is None and back["amount"] == 9.5


def test_latest_view_has_one_row_per_number(spark, sf_dir, cfg):
    load_history(spark, cfg, "day-1")

    def all_clean(payments):
        return payments.withColumn("prediction", F.lit(0.0))

    for batch in (0, 1):
        score_batch(view(spark, sf_dir, "payments_json"), batch, "run", cfg, all_clean)
    rows = read_scored(spark, cfg).filter("label_source = 'predicted'")
    newest = latest_scored(rows)
    assert newest.count() * 2 == rows.count()
    assert newest.filter("batch_id <> 1").count() == 0


def test_repeats_are_written_in_order_and_not_by_one_task(spark):
    """What the upsert queries load: each payment once per factor, later factors in later files."""
    cfg = scans.scratch_settings(spark)
    rows = spark.range(0, 400, 1, 4).select(
        F.col("id").cast("string").alias("transaction_number"), F.lit(1.0).alias("amount")
    )
    scans._amounts(spark, cfg, rows, 1, 2, 4)
    written = spark.read.option("header", True).csv(cfg.transaction_csv).select(
        "transaction_number", F.col("amount").cast("double").alias("amount"),
        F.col("_metadata.file_path").alias("file"),
    )
    found = sorted((r.file, r.amount) for r in written.collect())
    assert [a for _, a in found] == [1.0] * 400 + [2.0] * 400 + [4.0] * 400
    assert len({f for f, _ in found}) == 12
