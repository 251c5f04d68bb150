"""CSV scans: columns are bound by position, never by guessing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txscore.schemas import REPLAY_POSITIONS


# the line of a row with a field that does not fit, or with too few or too many of them
RAW_LINE = "raw_line"
_BEHIND = "\u0001"
# where a row stands: its file, the split of the file, and its place among the rows of a task
FILE_ORDER = ["file_path", "split_start", "place_in_task"]


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, raw_line: str | None = None
) -> DataFrame:
    """Headed CSV under a fixed schema; a field that does not fit its type is null.

    The schema is given, so no pass over the data is spent on inferring it, and files stay
    splittable. With `raw_line`, a column of that name keeps the text of lines that do not fit.
    """
    reader = spark.read
    if raw_line is not None:
        schema = T.StructType([*schema, T.StructField(raw_line, T.StringType())])
        # else a line is only read as far as the chosen columns reach, and too short ones go unseen
        reader = reader.option("columnNameOfCorruptRecord", raw_line).option("columnPruning", False)
    return (
        reader.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def with_file_order(scan: DataFrame) -> DataFrame:
    """A scan with its rows' places. A task numbers its rows upwards, and a split is within one task,
    so the three columns together give the order in the files, alike in every run over them."""
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias(FILE_ORDER[0]),
        F.col("_metadata.file_block_start").alias(FILE_ORDER[1]),
        F.monotonically_increasing_id().alias(FILE_ORDER[2]),
    )


def has_wrong_width(raw_line: Column, width: int) -> Column:
    """Whether a kept line has fewer or more fields than `width`; false for a null line."""
    layout = ", ".join(f"c{i} string" for i in range(width + 1))
    # one more field behind the line is the last of the row if the line has its width
    fields = F.from_csv(F.concat(raw_line, F.lit("," + _BEHIND)), layout)
    return raw_line.isNotNull() & ~fields[f"c{width}"].eqNullSafe(_BEHIND)


def read_replay_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header-less CSV with doubled quotes; picks the payment fields by position, all as text."""
    width = 1 + max(REPLAY_POSITIONS.values())
    layout = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    raw = (
        spark.read.schema(layout)
        .option("header", False)
        .option("escape", '"')
        .csv(path)
    )
    return raw.select(
        *[F.coalesce(F.col(f"_c{at}"), F.lit("")).alias(name) for name, at in REPLAY_POSITIONS.items()]
    )
