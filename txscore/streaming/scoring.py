"""Scoring stream: records in, payments by class, rejects and positions out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from txscore.operators.columns import rename_columns
from txscore.operators.enrich import (
    accepted,
    customer_side,
    customers_for,
    match_customers,
    measured_bytes,
    parse_payments,
    rejected,
)
from txscore.operators.forest import score
from txscore.operators.latest import latest_by_key
from txscore.operators.offsets import max_offset_per_partition, start_position
from txscore.plans.merge_tables import merge_parts
from txscore.schemas import BATCH_SLICES, CUSTOMER_TABLE, OFFSETS, REJECTS
from txscore.session import BROADCAST_LIMIT, path_exists
from txscore.settings import Settings
from txscore.sources.kafka import read_records, topic_partitions
from txscore.sources.manifest import commit, newest
from txscore.sources.models import load_models, newest_model_version
from txscore.sources.tables import (
    append_table,
    latest_version,
    read_parts,
    read_snapshot,
    read_table,
    scored_part,
    write_by_class,
    write_part,
)
from txscore.streaming.control import BatchMetrics

# set by Spark on the thread that runs a micro-batch; the id lives in the checkpoint
QUERY_ID = "sql.streaming.queryId"

Scorer = Callable[[DataFrame], DataFrame]


class SnapshotSize:
    """Bytes of the customers a join needs, measured once per snapshot.

    A store without snapshots is measured each time.
    """

    def __init__(self) -> None:
        self.version: str | None = None
        self._bytes = 0

    def __call__(self, customers: DataFrame, version: str | None) -> int:
        if version is None or version != self.version:
            self._bytes = measured_bytes(customer_side(customers))
            self.version = version
        return self._bytes


class ForestScorer:
    """Adds `prediction` with the newest committed models; loads them only when they change."""

    def __init__(self, cfg: Settings) -> None:
        self.cfg = cfg
        self.version: str | None = None
        self._models = None

    def __call__(self, payments: DataFrame) -> DataFrame:
        newest = newest_model_version(payments.sparkSession, self.cfg)
        if newest is None:
            raise ValueError("no trained models yet: run the training job first")
        if newest != self.version:
            self._models = load_models(self.cfg, newest)
            self.version = newest
        return score(payments, *self._models)


def score_batch(
    records: DataFrame,
    batch_id: int,
    run_id: str,
    cfg: Settings,
    scorer: Scorer,
    broadcast_limit: int = BROADCAST_LIMIT,
    size: SnapshotSize | None = None,
) -> tuple[int, int]:
    """Score one micro-batch of (value, partition, offset) and store the outcome.

    The parsed batch is kept before anything looks at it, so its source is read once. Customers are read anew each time, so a card opened today is known today. All that is
    stored goes live in one step, and a repeated batch leaves one copy. Returns how many payments were
    stored and rejected.
    """
    spark = records.sparkSession
    version = latest_version(spark, cfg, cfg.customer_table) if cfg.stores_files else None
    customers = read_snapshot(spark, cfg, cfg.customer_table, CUSTOMER_TABLE)
    payments = parse_payments(records, cfg.source_zone).persist()
    try:
        known = (size or SnapshotSize())(customers, version)
        side = customers_for(payments, customers, broadcast_limit, known)
        matched = match_customers(payments, side)
        # the text is stored with rejects alone, and is most of a row
        text = F.when(F.col("reject_reason").isNotNull(), F.col("value"))
        matched = matched.withColumn("value", text).persist()
        try:
            scored = rename_columns(scorer(accepted(matched)), {"prediction": "is_fraud"})
            # of payments with the same number in a batch the one with the last offset
            lone = scored.filter("transaction_number is null")
            keyed = scored.filter("transaction_number is not null")
            last = latest_by_key(keyed, "transaction_number", F.desc("offset"), F.desc("partition"))
            return store_batch(last.unionByName(lone), matched, cfg, run_id, batch_id)
        finally:
            matched.unpersist()
    finally:
        payments.unpersist()


def store_batch(
    scored: DataFrame, matched: DataFrame, cfg: Settings, run_id: str, batch_id: int
) -> tuple[int, int]:
    """Store payments, rejects and positions of a batch; how many payments were stored and rejected.

    `scored` has each payment number once. Files: three parts that go live in one commit, so no reader sees half a batch, and one that
    fails before it leaves nothing. A batch that comes again replaces its parts. Positions are
    one row per partition: what is stored and the batch, whichever is further. A connector's tables
    are written one after the other, positions last.
    """
    spark = matched.sparkSession
    lost = rejected(matched).select(
        "*", F.lit(run_id).alias("run_id"), F.lit(batch_id).cast("long").alias("batch_id")
    )
    done = max_offset_per_partition(matched)
    if not cfg.stores_files:
        write_by_class(scored, cfg, "predicted", run_id, batch_id)
        append_table(lost, cfg, cfg.reject_table)
        append_table(done.withColumn("topic", F.lit(cfg.topic)), cfg, cfg.offset_table)
        return accepted(matched).count(), lost.count()
    key = f"{run_id}/{batch_id}"
    positions = max_offset_per_partition(stored_offsets(spark, cfg).unionByName(done))
    # rejects first: they read the kept rows once, and so make them once; payments read them twice at a time
    reject_part = write_part(lost, cfg, cfg.reject_table, key)
    parts = [
        scored_part(scored, cfg, "predicted", run_id, batch_id, compact=True, unique=True),
        reject_part,
        write_part(
            positions.select(F.lit(cfg.topic).alias("topic"), "partition", "offset"),
            cfg,
            cfg.offset_table,
            f"topic/{cfg.topic}",
        ),
    ]
    commit(spark, cfg, parts)
    return parts[0].rows, parts[1].rows


def stored_offsets(spark: SparkSession, cfg: Settings) -> DataFrame:
    """(partition, offset) of the topic: the last offset done."""
    if cfg.stores_files:
        parts = newest(spark, cfg).of(cfg.offset_table)
        stored = read_parts(spark, cfg, cfg.offset_table, parts, OFFSETS)
    else:
        stored = read_table(spark, cfg, cfg.offset_table)
    return max_offset_per_partition(stored.filter(F.col("topic") == cfg.topic))


def read_rejects(spark: SparkSession, cfg: Settings) -> DataFrame:
    layout = T.StructType([*REJECTS, *BATCH_SLICES])
    if not cfg.stores_files:
        return read_table(spark, cfg, cfg.reject_table)
    parts = newest(spark, cfg).of(cfg.reject_table)
    return read_parts(spark, cfg, cfg.reject_table, parts, layout).drop("part")


def has_checkpoint(spark: SparkSession, cfg: Settings) -> bool:
    return path_exists(spark, f"{cfg.checkpoint_location}/metadata")


def topic_records(spark: SparkSession, cfg: Settings) -> DataFrame:
    """The topic; without a checkpoint it goes on after the stored positions, if any.

    Partitions without a stored position, added since, are read from their first record.
    """
    if not has_checkpoint(spark, cfg):
        stored = stored_offsets(spark, cfg)
        if not stored.isEmpty():
            position = start_position(stored, cfg.topic, topic_partitions(spark, cfg)).first()
            return read_records(spark, cfg, position["starting_offsets"])
    return read_records(spark, cfg)


def start_scoring(
    spark: SparkSession,
    cfg: Settings,
    records: DataFrame | None = None,
    scorer: Scorer | None = None,
    until_caught_up: bool = False,
    broadcast_limit: int = BROADCAST_LIMIT,
    metrics: BatchMetrics | None = None,
) -> StreamingQuery:
    """Start the stream and return its handle; stopping it is up to the caller.

    `metrics`, a listener that was added to the session, is told what became of each batch.

    `records` stands in for the topic and needs the columns value, partition, offset.
    """
    source = topic_records(spark, cfg) if records is None else records
    chosen = scorer or ForestScorer(cfg)
    size = SnapshotSize()

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        run_id = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
        outcome = score_batch(batch, batch_id, run_id, cfg, chosen, broadcast_limit, size)
        if metrics is not None:
            metrics.outcome(run_id, batch_id, *outcome)
        merge_parts(batch.sparkSession, cfg)

    writer = source.writeStream.foreachBatch(each_batch).option(
        "checkpointLocation", cfg.checkpoint_location
    )
    if until_caught_up:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{cfg.batch_interval_ms} milliseconds").start()
