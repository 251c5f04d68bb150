"""The scoring stream, run over the given tables until it has caught up."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import (
    SCORED_SQL,
    query,
    scratch_settings,
    view,
    view_stream,
    with_views,
)
from checks.models import labelled, mostly_right
from checks.scans import AS_OF
from txscore.operators.enrich import accepted, match_customers, parse_payments
from txscore.operators.history import with_customer_age
from txscore.plans.train_models import TrainingOptions, train
from txscore.schemas import SCORED_COLUMNS
from txscore.sources.models import save_models
from txscore.sources.tables import read_scored, upsert_snapshot
from txscore.streaming.scoring import read_rejects, start_scoring, stored_offsets

LARGE = 100


def large_is_fraud(payments):
    """A stand-in for the forest that SQL can repeat."""
    return payments.withColumn("prediction", (F.col("amount") >= LARGE).cast("double"))


def scored_stream(spark, sf_dir, scorer=large_is_fraud, prepare=None):
    """Run the stream to its end; returns the settings that say where its tables are."""
    cfg = scratch_settings(spark)
    customers = with_customer_age(view(spark, sf_dir, "customers"), F.to_date(F.lit(AS_OF)))
    upsert_snapshot(spark, customers, cfg, cfg.customer_table, "card_number", "first")
    if prepare:
        prepare(cfg)
    stream = start_scoring(
        spark, cfg, view_stream(spark, sf_dir, "payments_json"), scorer, until_caught_up=True
    )
    stream.awaitTermination()
    return cfg


@query(
    "stream_scored",
    with_views("outcome")
    + f"""select {SCORED_SQL}, cast(amount >= {LARGE} as int) as is_fraud,
       'predicted' as label_source
from outcome where reject_reason is null""",
)
def stream_scored(spark, sf_dir):
    cfg = scored_stream(spark, sf_dir)
    return read_scored(spark, cfg).drop("run_id", "batch_id")


@query(
    "stream_enriched",
    with_views("outcome")
    + f'select partition, "offset", {SCORED_SQL} from outcome where reject_reason is null',
)
def stream_enriched(spark, sf_dir):
    """The enrichment as one streaming plan: stream joined with a table, into a file sink."""
    cfg = scratch_settings(spark)
    payments = parse_payments(view_stream(spark, sf_dir, "payments_json"))
    matched = match_customers(payments, view(spark, sf_dir, "customers"))
    enriched = accepted(matched).select("partition", "offset", *SCORED_COLUMNS)
    path = f"{cfg.warehouse}/enriched"
    stream = (
        enriched.writeStream.format("parquet")
        .option("checkpointLocation", cfg.checkpoint_location)
        .trigger(availableNow=True)
        .start(path)
    )
    stream.awaitTermination()
    return spark.read.schema(enriched.schema).parquet(path)


@query(
    "stream_rejects",
    with_views("outcome")
    + 'select value, partition, "offset", reject_reason from outcome where reject_reason is not null',
)
def stream_rejects(spark, sf_dir):
    cfg = scored_stream(spark, sf_dir)
    return read_rejects(spark, cfg).drop("run_id", "batch_id")


@query(
    "stream_offsets",
    with_views("payments_json")
    + 'select partition, max("offset") as "offset" from payments_json group by partition',
)
def stream_offsets(spark, sf_dir):
    return stored_offsets(spark, scored_stream(spark, sf_dir))


_TRUE_CLASS = f"cast(amount >= {LARGE} and category in ('error', 'purchase') as int)"


@query(
    "stream_forest",
    with_views("outcome")
    + f"""select {_TRUE_CLASS} as label, count(*) as n, true as is_mostly_right
from outcome where reject_reason is null group by {_TRUE_CLASS}""",
)
def stream_forest(spark, sf_dir):
    """The stream with trained models: every payment is stored, most in their true class."""

    def train_first(cfg):
        trained = train(labelled(spark, sf_dir), TrainingOptions())
        save_models(spark, cfg, trained.preprocessor, trained.forest, "first")

    cfg = scored_stream(spark, sf_dir, scorer=None, prepare=train_first)
    truth = F.expr(_TRUE_CLASS)
    return mostly_right(read_scored(spark, cfg).withColumn("label", truth), prediction="is_fraud")
