"""Side-by-side run of a registered query and its SQL twin."""

from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def normal(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple(None if pd.isna(value) else _plain(value) for value in row)
        for row in frame.itertuples(index=False)
    ]
    return sorted(rows, key=repr)


def _plain(value):
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "item"):
        value = value.item()
    # counts with a null beside them arrive as floats in one engine only
    return float(value) if isinstance(value, int) and not isinstance(value, bool) else value


def both(spark, connection, sf_dir, run, sql):
    mine = run(spark, sf_dir).toPandas()
    theirs = connection.execute(sql).df()
    return mine, theirs
