import json
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks.base import view
from checks.streams import large_is_fraud
from txscore.operators.enrich import (
    accepted,
    customer_side,
    match_customers,
    measured_bytes,
    parse_payments,
    rejected,
)
from txscore.operators.history import with_customer_age
from txscore.operators.routing import class_counts
from txscore.plans.train_models import TrainingOptions, train
from txscore.schemas import CUSTOMER_TABLE, MODEL_COLUMNS, OFFSETS, SCORED_COLUMNS
from txscore.session import write_new_file
from txscore.settings import Settings
from txscore.sources.manifest import commit
from txscore.sources.models import save_models
from txscore.sources.tables import (
    read_class,
    read_scored,
    read_snapshot,
    upsert_snapshot,
    write_part,
)
from txscore.streaming import scoring
from txscore.streaming.control import BatchMetrics, await_end, read_batch_metrics
from txscore.streaming.scoring import (
    ForestScorer,
    SnapshotSize,
    has_checkpoint,
    read_rejects,
    score_batch,
    start_scoring,
    stored_offsets,
    topic_records,
)
from tests.test_training import rows as training_rows

RECORD = "value string, partition int, offset long"


@pytest.fixture
def cfg(spark, sf_dir, tmp_path):
    cfg = Settings(
        warehouse=str(tmp_path / "tables"),
        preprocessor_path=str(tmp_path / "preprocessor"),
        forest_path=str(tmp_path / "forest"),
        checkpoint_location=str(tmp_path / "checkpoint"),
        topic="payments",
    )
    customers = with_customer_age(view(spark, sf_dir, "customers"))
    upsert_snapshot(spark, customers, cfg, cfg.customer_table, "card_number", "first")
    return cfg


@pytest.fixture
def inbox(spark, sf_dir, tmp_path):
    """A folder of record files that a stream can watch."""
    path = str(tmp_path / "inbox")
    view(spark, sf_dir, "payments_json").repartition(3).write.parquet(path)
    return path


def watch(spark, inbox, files=1000):
    return spark.readStream.schema(RECORD).option("maxFilesPerTrigger", files).parquet(inbox)


def run(spark, cfg, records, scorer=large_is_fraud):
    stream = start_scoring(spark, cfg, records, scorer, until_caught_up=True)
    stream.awaitTermination()
    return stream


def stored(spark, cfg):
    rows = read_scored(spark, cfg).select(*SCORED_COLUMNS, "is_fraud")
    return sorted(map(tuple, rows.collect()), key=repr)


def test_stream_equals_batch(spark, sf_dir, cfg, inbox):
    run(spark, cfg, watch(spark, inbox, files=1))
    matched = match_customers(
        parse_payments(view(spark, sf_dir, "payments_json")), view(spark, sf_dir, "customers")
    )
    batch = large_is_fraud(accepted(matched)).withColumn("is_fraud", F.col("prediction").cast("int"))
    expected = batch.select(*SCORED_COLUMNS, "is_fraud").collect()
    assert stored(spark, cfg) == sorted(map(tuple, expected), key=repr)
    assert read_scored(spark, cfg).select("batch_id").distinct().count() == 3
    assert read_class(spark, cfg, 1).count() > 0
    assert read_rejects(spark, cfg).count() == rejected(matched).count()
    assert read_rejects(spark, cfg).count() + len(expected) == spark.read.parquet(inbox).count()


def test_second_run_adds_only_what_is_new(spark, cfg, inbox):
    run(spark, cfg, watch(spark, inbox))
    first, positions = stored(spark, cfg), dict(stored_offsets(spark, cfg).collect())
    run(spark, cfg, watch(spark, inbox))
    assert stored(spark, cfg) == first
    sample = spark.read.parquet(inbox).filter("value <> 'not json'").limit(5)
    later = sample.withColumn("offset", F.col("offset") + 1_000_000).cache()
    assert later.count() == 5
    later.write.mode("append").parquet(inbox)
    run(spark, cfg, watch(spark, inbox))
    outcome = len(stored(spark, cfg)) + read_rejects(spark, cfg).count()
    assert outcome == spark.read.parquet(inbox).count()
    assert max(dict(stored_offsets(spark, cfg).collect()).values()) >= 1_000_000
    assert max(positions.values()) < 1_000_000


def test_repeated_batch_leaves_one_copy(spark, cfg, inbox):
    batch = spark.read.parquet(inbox)
    for _ in range(2):
        score_batch(batch, 7, "run", cfg, large_is_fraud)
    total = read_scored(spark, cfg).count() + read_rejects(spark, cfg).count()
    assert total == batch.count()
    assert stored_offsets(spark, cfg).count() == 3


@pytest.mark.parametrize("step", ["scored_part", "write_part", "second write_part", "commit"])
def test_failure_between_writes_leaves_nothing(spark, cfg, inbox, monkeypatch, step):
    """The stream dies before one of its writes; no reader sees half a batch, the restart repeats it."""
    calls, name = [], step.split()[-1]
    real = getattr(scoring, name)

    def broken(*args, **more):
        calls.append(args)
        if len(calls) == (2 if step.startswith("second") else 1):
            raise RuntimeError("lost")
        return real(*args, **more)

    monkeypatch.setattr(scoring, name, broken)
    with pytest.raises(Exception, match="lost"):
        run(spark, cfg, watch(spark, inbox))
    assert read_scored(spark, cfg).count() == read_rejects(spark, cfg).count() == 0
    assert stored_offsets(spark, cfg).count() == 0
    monkeypatch.setattr(scoring, name, real)
    run(spark, cfg, watch(spark, inbox))
    total = read_scored(spark, cfg).count() + read_rejects(spark, cfg).count()
    assert total == spark.read.parquet(inbox).count() and stored_offsets(spark, cfg).count() == 3


@pytest.mark.parametrize("limit", [5_000, 10])
def test_many_customers_give_the_same_outcome(spark, cfg, inbox, limit):
    batch = spark.read.parquet(inbox)
    score_batch(batch, 0, "few", cfg, large_is_fraud)
    score_batch(batch, 0, "many", cfg, large_is_fraud, broadcast_limit=limit)
    for table in (read_scored(spark, cfg), read_rejects(spark, cfg)):
        few, many = (table.filter(F.col("run_id") == r).drop("run_id") for r in ("few", "many"))
        assert few.count() == many.count() > 0
        assert few.exceptAll(many).isEmpty()


def test_new_checkpoint_does_not_overwrite_old_batches(spark, cfg, inbox):
    run(spark, cfg, watch(spark, inbox))
    once = read_scored(spark, cfg).count()
    run(spark, replace(cfg, checkpoint_location=cfg.checkpoint_location + "-2"), watch(spark, inbox))
    assert read_scored(spark, cfg).count() == 2 * once
    assert read_scored(spark, cfg).select("run_id").distinct().count() == 2


def test_empty_input(spark, cfg, tmp_path):
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], RECORD).write.parquet(empty)
    run(spark, cfg, watch(spark, empty))
    assert read_scored(spark, cfg).count() == 0 and stored_offsets(spark, cfg).count() == 0


def test_customers_of_today_are_known_today(spark, cfg, inbox):
    batch = spark.read.parquet(inbox)
    score_batch(batch, 0, "run", cfg, large_is_fraud)
    unknown = read_rejects(spark, cfg).filter("reject_reason = 'unknown_card'")
    assert unknown.count() > 0
    cards = unknown.select(F.get_json_object("value", "$.card_number").alias("card_number"))
    newcomers = with_customer_age(
        cards.distinct().select(
            "card_number",
            *[F.lit("x").alias(c) for c in ("first_name", "last_name", "gender", "street")],
            *[F.lit("x").alias(c) for c in ("city", "state", "zip")],
            F.lit(1.0).alias("latitude"),
            F.lit(2.0).alias("longitude"),
            F.lit("x").alias("job"),
            F.lit("1990-01-01").cast("timestamp").alias("date_of_birth"),
        )
    )
    upsert_snapshot(spark, newcomers, cfg, cfg.customer_table, "card_number", "second")
    score_batch(batch, 1, "run", cfg, large_is_fraud)
    now = read_rejects(spark, cfg).filter("batch_id = 1 and reject_reason = 'unknown_card'")
    assert now.count() == 0


def test_newest_models_are_picked_up(spark, cfg, inbox):
    history = training_rows(spark).select("transaction_number", *MODEL_COLUMNS, "label")
    scorer = ForestScorer(cfg)
    batch = spark.read.parquet(inbox)
    with pytest.raises(ValueError, match="no trained models"):
        score_batch(batch, 0, "run", cfg, scorer)
    for version in ("day-1", "day-2"):
        trained = train(history, TrainingOptions(trees=2))
        save_models(spark, cfg, trained.preprocessor, trained.forest, version)
        score_batch(batch, 0, "run", cfg, scorer)
        assert scorer.version == version
    assert class_counts(read_scored(spark, cfg)).agg(F.sum("n")).first()[0] > 0
    run(spark, cfg, watch(spark, inbox), scorer=None)
    assert read_scored(spark, cfg).select("run_id").distinct().count() == 2


def test_micro_batches_adapt(spark, cfg, inbox):
    """Skewed cards and small files rely on AQE, which plain streaming plans do not have."""
    seen = {}

    def look(payments):
        conf = payments.sparkSession.conf
        seen.update(aqe=conf.get("spark.sql.adaptive.enabled"), zone=conf.get("spark.sql.session.timeZone"))
        return large_is_fraud(payments)

    run(spark, cfg, watch(spark, inbox), look)
    assert seen == {"aqe": "true", "zone": "UTC"}
    assert len(read_scored(spark, cfg).inputFiles()) == 2


def test_stream_output_is_compact(spark, cfg, inbox):
    batch = spark.read.parquet(inbox).repartition(50)
    score_batch(batch, 0, "run", cfg, large_is_fraud)
    # one file per class, not one per task and class
    assert len(read_scored(spark, cfg).inputFiles()) == 2


def test_topic_needs_the_connector(spark, cfg):
    """No connector is bundled, so the topic path can be followed only up to the source."""
    assert not has_checkpoint(spark, cfg)
    with pytest.raises(Exception, match="(?i)kafka"):
        topic_records(spark, cfg)
    position = spark.createDataFrame([(cfg.topic, 0, 5)], OFFSETS)
    commit(spark, cfg, [write_part(position, cfg, cfg.offset_table, "topic")])
    with pytest.raises(Exception, match="(?i)kafka|JavaPackage"):
        topic_records(spark, cfg)


def test_checkpoint_is_found(spark, cfg, inbox):
    run(spark, cfg, watch(spark, inbox))
    assert has_checkpoint(spark, cfg)


@pytest.mark.parametrize("path", ["broadcast", "cut down", "shuffle"])
def test_a_batch_reads_its_source_once(spark, cfg, inbox, path):
    customers = read_snapshot(spark, cfg, cfg.customer_table, CUSTOMER_TABLE)
    cards = parse_payments(spark.read.parquet(inbox)).select("card_number").distinct()
    small, large = sorted([measured_bytes(cards), measured_bytes(customer_side(customers))])
    assert small < large
    limit = {"broadcast": large, "cut down": small, "shuffle": 1}[path]
    stream = start_scoring(
        spark, cfg, watch(spark, inbox), large_is_fraud, until_caught_up=True, broadcast_limit=limit
    )
    stream.awaitTermination()
    read = sum(p["numInputRows"] for p in stream.recentProgress)
    assert read == spark.read.parquet(inbox).count()
    assert read_scored(spark, cfg).count() + read_rejects(spark, cfg).count() == read


def test_customers_are_measured_once_per_snapshot(spark, cfg):
    size = SnapshotSize()
    customers = read_snapshot(spark, cfg, cfg.customer_table, CUSTOMER_TABLE)
    first = size(customers, "v1")
    assert size(customers.limit(0), "v1") == first > 0
    assert size(customers.limit(0), "v2") == 0 and size(customers, None) == first


def test_stream_by_interval(spark, cfg, inbox):
    stream = start_scoring(spark, replace(cfg, batch_interval_ms=200), watch(spark, inbox), large_is_fraud)
    try:
        stream.processAllAvailable()
        assert stream.isActive
    finally:
        stream.stop()
    assert read_scored(spark, cfg).count() > 0


def until(holds, seconds=60):
    end = time.time() + seconds
    while not holds() and time.time() < end:
        time.sleep(0.1)
    return holds()


def test_batches_leave_metrics(spark, cfg, inbox):
    metrics = BatchMetrics(spark, cfg)
    spark.streams.addListener(metrics)
    try:
        stream = start_scoring(
            spark, cfg, watch(spark, inbox, files=1), large_is_fraud, until_caught_up=True, metrics=metrics
        )
        stream.awaitTermination()
        assert until(lambda: read_batch_metrics(spark, cfg).count() == 3)
    finally:
        spark.streams.removeListener(metrics)
    assert not metrics.failed
    rows = sorted(read_batch_metrics(spark, cfg).collect(), key=lambda r: r.batch_id)
    assert [r.batch_id for r in rows] == [0, 1, 2] and len({r.run_id for r in rows}) == 1
    assert sum(r.n_read for r in rows) == spark.read.parquet(inbox).count()
    assert sum(r.n_stored for r in rows) == read_scored(spark, cfg).count()
    assert sum(r.n_rejected for r in rows) == read_rejects(spark, cfg).count()
    assert all(r.duration_ms > 0 and json.loads(r.end_offsets) for r in rows)


def test_marker_ends_the_stream(spark, cfg, inbox, tmp_path):
    cfg = replace(cfg, batch_interval_ms=200, stop_marker=str(tmp_path / "stop"))
    stream = start_scoring(spark, cfg, watch(spark, inbox), large_is_fraud)
    try:
        stream.processAllAvailable()
        write_new_file(spark, cfg.stop_marker, "")
        assert await_end(stream, spark, cfg, look_every=0.2)
        assert not stream.isActive
    finally:
        stream.stop()
    assert read_scored(spark, cfg).count() > 0


def test_a_stream_that_ends_by_itself_needs_no_marker(spark, cfg, inbox):
    stream = start_scoring(spark, cfg, watch(spark, inbox), large_is_fraud, until_caught_up=True)
    assert not await_end(stream, spark, cfg, look_every=0.2)


def test_only_rejects_keep_their_text(spark, sf_dir, cfg, monkeypatch):
    """Before, the kept rows of a batch held the text of every payment, most of a row."""
    kept = []
    store = scoring.store_batch

    def watched(scored, matched, *rest):
        text = F.col("value").isNotNull()
        kept.append(matched.groupBy(F.col("reject_reason").isNotNull()).agg(F.count_if(text), F.count("*")).collect())
        return store(scored, matched, *rest)

    monkeypatch.setattr(scoring, "store_batch", watched)
    records = view(spark, sf_dir, "payments_json")
    n_stored, n_rejected = score_batch(records, 0, "one", cfg, large_is_fraud)
    assert {tuple(r) for r in kept[0]} == {(False, 0, n_stored), (True, n_rejected, n_rejected)}
    lost = rejected(match_customers(parse_payments(records), view(spark, sf_dir, "customers")))
    stored = read_rejects(spark, cfg).select(*lost.columns)
    assert stored.exceptAll(lost).isEmpty() and lost.exceptAll(stored).isEmpty()
