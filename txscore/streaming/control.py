"""What a running stream says of its batches, and how it is asked to end."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from txscore.schemas import STREAM_METRICS
from txscore.session import path_exists
from txscore.settings import Settings
from txscore.sources.manifest import commit, newest
from txscore.sources.tables import append_table, read_parts, read_table, write_part

# set as long as a batch is under way
_TRIGGER = "isTriggerActive"


class BatchMetrics(StreamingQueryListener):
    """Stores one row per batch: rows read, stored and rejected, how long it took, and how far it came.

    What Spark reports of a batch comes from its progress event, what was stored and rejected from the
    batch itself (`outcome`). A batch that comes again replaces its row. A row that cannot be written
    is kept in `failed`, and the stream goes on.
    """

    def __init__(self, spark: SparkSession, cfg: Settings) -> None:
        super().__init__()
        self.spark, self.cfg = spark, cfg
        self.failed: list[tuple] = []
        self._outcomes: dict[tuple[str, int], tuple[int, int]] = {}

    def outcome(self, run_id: str, batch_id: int, stored: int, rejected: int) -> None:
        self._outcomes[run_id, batch_id] = stored, rejected

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        done = event.progress
        outcome = self._outcomes.pop((str(done.id), done.batchId), None)
        if outcome is None:  # no batch of this stream, or one without rows
            return
        ends = [source.endOffset for source in done.sources]
        row = (
            str(done.id), done.batchId, done.timestamp, done.numInputRows, *outcome,
            done.durationMs.get("triggerExecution"), json.dumps(ends),
        )
        try:
            self._store(row)
        except Exception as fault:  # a listener's fault would be logged and lost
            self.failed.append((row, fault))

    def _store(self, row: tuple) -> None:
        table = self.cfg.stream_metric_table
        rows = self.spark.createDataFrame([row], STREAM_METRICS).coalesce(1)
        if self.cfg.stores_files:
            commit(self.spark, self.cfg, [write_part(rows, self.cfg, table, f"{row[0]}/{row[1]}")])
        else:
            append_table(rows, self.cfg, table)


def read_batch_metrics(spark: SparkSession, cfg: Settings) -> DataFrame:
    if not cfg.stores_files:
        return read_table(spark, cfg, cfg.stream_metric_table)
    parts = newest(spark, cfg).of(cfg.stream_metric_table)
    return read_parts(spark, cfg, cfg.stream_metric_table, parts, STREAM_METRICS).drop("part")


def await_end(stream: StreamingQuery, spark: SparkSession, cfg: Settings, look_every: float = 5.0) -> bool:
    """Wait until the stream ends by itself or its stop marker is there; true if it was the marker.

    A batch under way is let finish. A fault of the stream is raised.
    """
    while not stream.awaitTermination(look_every):
        if cfg.stop_marker and path_exists(spark, cfg.stop_marker):
            while stream.isActive and stream.status[_TRIGGER]:
                time.sleep(min(0.1, look_every))
            stream.stop()
            return True
    return False
