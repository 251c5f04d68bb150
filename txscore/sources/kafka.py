"""Kafka source and sink: options only, the connector comes with the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txscore.settings import Settings


def source_options(
    cfg: Settings, starting_offsets: str | None = None, assigned: str | None = None
) -> dict[str, str]:
    """By topic, from stored offsets when there are any.

    With `assigned` only those partitions are read. Without, the topic is subscribed to, which needs a
    start for each partition it has now, and takes up those that are added later.
    """
    options = {"kafka.bootstrap.servers": cfg.bootstrap_servers}
    if cfg.group_id:
        options["kafka.group.id"] = cfg.group_id
    options.update(cfg.consumer_options)
    if starting_offsets and assigned:
        options.update(assign=assigned, startingOffsets=starting_offsets)
    elif starting_offsets:
        options.update(subscribe=cfg.topic, startingOffsets=starting_offsets)
    else:
        options.update(subscribe=cfg.topic, startingOffsets=cfg.auto_offset_reset)
    return options


def topic_partitions(spark: SparkSession, cfg: Settings) -> DataFrame:
    """The partitions that the topic has now, by the client that comes with the connector."""
    jvm = spark._jvm
    properties = jvm.java.util.Properties()
    text = "org.apache.kafka.common.serialization.StringDeserializer"
    properties.put("key.deserializer", text)
    properties.put("value.deserializer", text)
    for name, value in source_options(cfg).items():
        if name.startswith("kafka."):
            properties.put(name.removeprefix("kafka."), str(value))
    consumer = jvm.org.apache.kafka.clients.consumer.KafkaConsumer(properties)
    try:
        found = [(one.partition(),) for one in consumer.partitionsFor(cfg.topic)]
    finally:
        consumer.close()
    return spark.createDataFrame(found, "partition int")


def read_records(
    spark: SparkSession,
    cfg: Settings,
    starting_offsets: str | None = None,
    assigned: str | None = None,
) -> DataFrame:
    """Streaming frame of (value, partition, offset)."""
    options = source_options(cfg, starting_offsets, assigned)
    return project_records(spark.readStream.format("kafka").options(**options).load())


def project_records(raw: DataFrame) -> DataFrame:
    """Keep what scoring needs of a consumer record."""
    return raw.select(F.col("value").cast("string").alias("value"), "partition", "offset")


def sink_options(cfg: Settings) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": cfg.bootstrap_servers,
        "kafka.enable.idempotence": cfg.producer_idempotence,
        "kafka.acks": cfg.producer_acks,
        "kafka.retries": cfg.producer_retries,
        "kafka.max.in.flight.requests.per.connection": cfg.producer_in_flight,
        "topic": cfg.topic,
    }


def write_records(payloads: DataFrame, cfg: Settings, sink: str = "kafka", path: str = "") -> None:
    """Send a column `value` to the topic, or to text files under `path`."""
    writer = payloads.select("value").write
    if sink == "kafka":
        writer.format("kafka").options(**sink_options(cfg)).save()
    else:
        writer.mode("append").text(path)
