"""Projections that fail loudly."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; a column that is not there is an error, not a no-op."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    return df.withColumnsRenamed(dict(names))
