"""The path of a store that is reached through a connector: options, two class tables, appends.

The connector here is a small Python data source that keeps rows as JSON lines. It knows no keys,
so what a store does with a repeated key is not part of these tests.
"""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, WriterCommitMessage

from tests.test_sources import payments
from txscore.schemas import SCORED
from txscore.settings import Settings
from txscore.sources.tables import (
    append_table,
    current_scored,
    read_class,
    read_scored,
    read_table,
    write_by_class,
)


def line_store():
    """Defined here, so that the classes travel to the workers by value."""

    class Lines(DataSource):
        @classmethod
        def name(cls):
            return "lines"

        def folder(self):
            return "/".join(self.options[k] for k in ("root", "keyspace", "table"))

        def schema(self):
            return self.options["layout"]

        def reader(self, schema):
            return LineReader(self.folder(), schema.fieldNames())

        def writer(self, schema, overwrite):
            assert not overwrite
            return LineWriter(self.folder())

    class LineReader(DataSourceReader):
        def __init__(self, folder, names):
            self.folder, self.names = folder, names

        def read(self, partition):
            import json
            from pathlib import Path

            for path in Path(self.folder).glob("*.json"):
                for line in path.read_text().splitlines():
                    row = json.loads(line)
                    yield tuple(row[n] for n in self.names)

    class LineWriter(DataSourceWriter):
        def __init__(self, folder):
            self.folder = folder

        def write(self, iterator):
            import json
            import uuid
            from pathlib import Path

            folder = Path(self.folder)
            folder.mkdir(parents=True, exist_ok=True)
            lines = [json.dumps(row.asDict()) for row in iterator]
            (folder / f"{uuid.uuid4()}.json").write_text("\n".join(lines))
            return WriterCommitMessage()

    return Lines


@pytest.fixture
def cfg(spark, tmp_path):
    spark.dataSource.register(line_store())
    layout = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in SCORED if f.name != "transaction_time"
    )
    options = {"root": str(tmp_path), "layout": layout + ", transaction_time string"}
    return Settings(table_format="lines", keyspace="bank", table_options=options)


def test_classes_go_to_two_tables(spark, cfg, tmp_path):
    rows = payments(spark, [0, 1, None, 0]).withColumn(
        "transaction_time", F.col("transaction_time").cast("string")
    )
    write_by_class(rows, cfg, "loaded", "a", 0)
    assert sorted(p.name for p in (tmp_path / "bank").iterdir()) == [
        "fraud_transactions",
        "non_fraud_transactions",
    ]
    assert [r["transaction_number"] for r in read_class(spark, cfg, 1).collect()] == ["1"]
    assert read_class(spark, cfg, 0).columns == read_class(spark, cfg, 1).columns
    found = {r["transaction_number"]: r["is_fraud"] for r in read_scored(spark, cfg).collect()}
    assert found == {"0": 0, "1": 1, "3": 0}
    assert current_scored(spark, cfg, ("loaded", "predicted")).count() == 3
    with pytest.raises(ValueError, match="does not tell"):
        current_scored(spark, cfg, ("loaded",))


def test_append_and_scan(spark, cfg):
    from dataclasses import replace

    cfg = replace(cfg, table_options={**cfg.table_options, "layout": "partition int, offset long"})
    for offset in (5, 9):
        df = spark.createDataFrame([(0, offset)], "partition int, offset long")
        append_table(df, cfg, cfg.offset_table)
    assert sorted(r["offset"] for r in read_table(spark, cfg, cfg.offset_table).collect()) == [5, 9]
