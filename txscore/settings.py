"""Settings of the jobs, as one plain dataclass."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields

CONF_PREFIX = "spark.txscore."
FILE_FORMATS = ("parquet", "orc")


@dataclass(frozen=True)
class Settings:
    # inputs
    customer_csv: str = ""
    transaction_csv: str = ""

    # stored tables: folders under `warehouse` for file formats, else tables of a connector
    warehouse: str = ""
    table_format: str = "parquet"
    table_options: Mapping[str, str] = field(default_factory=dict)
    keyspace: str = "payments"
    customer_table: str = "customers"
    scored_table: str = "scored"
    fraud_table: str = "fraud_transactions"
    non_fraud_table: str = "non_fraud_transactions"
    offset_table: str = "stream_offsets"
    reject_table: str = "rejects"
    metric_table: str = "model_metrics"
    version_table: str = "versions"
    stream_metric_table: str = "stream_metrics"
    count_table: str = "payment_counts"

    # parts that a table may gather before they are merged, and folders of the merged payments
    merge_after: int = 16
    buckets: int = 8

    # models
    preprocessor_path: str = ""
    forest_path: str = ""

    # stream
    checkpoint_location: str = ""
    # while something is at this path, the stream ends after its batch
    stop_marker: str = ""
    batch_interval_ms: int = 10_000
    source_zone: str = "UTC"
    topic: str = "payments"
    bootstrap_servers: str = ""
    group_id: str = ""
    auto_offset_reset: str = "latest"
    consumer_options: Mapping[str, str] = field(default_factory=dict)

    # replay of a file into a topic
    replay_csv: str = ""
    replay_zone: str = "Asia/Kolkata"
    producer_idempotence: str = "true"
    producer_acks: str = "all"
    producer_retries: str = "2147483647"
    producer_in_flight: str = "5"

    @property
    def stores_files(self) -> bool:
        return self.table_format in FILE_FORMATS

    @classmethod
    def from_dict(cls, values: Mapping[str, object]) -> Settings:
        """Build settings from a mapping; a misspelt name is an error, not a silent default."""
        known = {f.name: f for f in fields(cls)}
        unknown = sorted(set(values) - set(known))
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        return cls(**{k: int(v) if known[k].type == "int" else v for k, v in values.items()})

    @classmethod
    def from_spark(cls, spark) -> Settings:
        """Read `spark.txscore.<name>`; maps use `spark.txscore.<name>.<key>`."""
        given = spark.conf.getAll
        values: dict[str, object] = {}
        for f in fields(cls):
            name = CONF_PREFIX + f.name
            if f.type.startswith("Mapping"):
                values[f.name] = {
                    k[len(name) + 1:]: v for k, v in given.items() if k.startswith(name + ".")
                }
            elif name in given:
                values[f.name] = given[name]
        return cls.from_dict(values)
