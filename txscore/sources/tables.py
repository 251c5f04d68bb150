"""Stored tables.

A file format keeps a table in `<warehouse>/<table>`; any other format name is handed to its
connector with `keyspace` and `table` options, and upserting by key is then the store's work.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txscore.operators.latest import SEQUENCE, latest_by_key, latest_scored
from txscore.schemas import MERGED, SCORED, SCORED_SLICES, VERSIONS
from txscore.session import BROADCAST_LIMIT, path_exists
from txscore.settings import Settings
from txscore.sources.manifest import BASE, Part, commit, new_part_folder, newest

CLASSES = (0, 1)
LABEL_SOURCES = ("loaded", "predicted")


def table_path(cfg: Settings, table: str) -> str:
    return f"{cfg.warehouse.rstrip('/')}/{table}"


def _connector_options(cfg: Settings, table: str) -> dict[str, str]:
    return {"keyspace": cfg.keyspace, "table": table, **cfg.table_options}


def read_table(
    spark: SparkSession,
    cfg: Settings,
    table: str,
    schema: T.StructType | None = None,
    folder: str = "",
) -> DataFrame:
    """Scan a stored table. With a schema, a table nobody has written yet reads as empty."""
    reader = spark.read.format(cfg.table_format)
    if not cfg.stores_files:
        return reader.options(**_connector_options(cfg, table)).load()
    path = table_path(cfg, table) + folder
    if schema is not None:
        if not path_exists(spark, path):
            return spark.createDataFrame([], schema)
        reader = reader.schema(schema)
    return reader.options(**cfg.table_options).load(path)


# characters that mean something in a path or in the name of a partition folder
_UNSAFE = set("\"#%'*/:=?\\{}[]^\x7f") | {chr(i) for i in range(32)}


def slice_folder(name: str, value: object) -> str:
    """Folder of one slice, written as Spark writes and reads the values of partition columns."""
    text = str(value)
    if not text:
        raise ValueError(f"{name} must not be empty")
    return f"/{name}=" + "".join(f"%{ord(c):02X}" if c in _UNSAFE else c for c in text)


def append_table(df: DataFrame, cfg: Settings, table: str) -> None:
    writer = df.write.format(cfg.table_format).mode("append")
    if cfg.stores_files:
        writer.options(**cfg.table_options).save(table_path(cfg, table))
    else:
        writer.options(**_connector_options(cfg, table)).save()


def replace_slice(
    df: DataFrame,
    cfg: Settings,
    table: str,
    slices: Mapping[str, object],
    partition_by: tuple[str, ...] = (),
) -> None:
    """Write one slice of a table so that writing it again leaves one copy.

    The slice is a folder of its own and is replaced whole, including classes that a second
    run no longer fills. A connector appends, and its key makes the repeat an upsert.
    """
    if not cfg.stores_files:
        append_table(df, cfg, table)
        return
    folder = "".join(slice_folder(name, value) for name, value in slices.items())
    (
        df.drop(*slices)
        .write.format(cfg.table_format)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .options(**cfg.table_options)
        .partitionBy(*partition_by)
        .save(table_path(cfg, table) + folder)
    )


# bytes that a key takes in a hash table, on the generous side
KEY_BYTES = 160


def write_part(
    df: DataFrame,
    cfg: Settings,
    table: str,
    key: str,
    partition_by: tuple[str, ...] = (),
    **about: object,
) -> Part:
    """Write a folder of its own, which is not live before it is committed. Repeats do no harm."""
    folder = new_part_folder()
    path = f"{table_path(cfg, table)}/{folder}"
    writer = df.write.format(cfg.table_format).mode("error").options(**cfg.table_options)
    writer.partitionBy(*partition_by).save(path)
    # of the files' own counts, without reading rows
    stored = df.sparkSession.read.format(cfg.table_format).schema(df.schema).options(**cfg.table_options)
    return Part(table, folder, key, stored.load(path).count(), **about)


def read_parts(
    spark: SparkSession, cfg: Settings, table: str, parts: Sequence[Part], schema: T.StructType
) -> DataFrame:
    """One scan over the given parts, with the column `part`."""
    layout = T.StructType([*schema, T.StructField("part", T.StringType())])
    if not parts:
        return spark.createDataFrame([], layout)
    path = table_path(cfg, table)
    reader = spark.read.format(cfg.table_format).schema(layout).options(**cfg.table_options)
    return reader.option("basePath", path).load([f"{path}/{part.folder}" for part in parts])


def scored_part(
    df: DataFrame,
    cfg: Settings,
    label_source: str,
    run_id: str,
    batch_id: int,
    compact: bool = False,
    unique: bool = False,
) -> Part:
    """Payments of one write by class, not live yet. `unique` says that no number comes twice."""
    label = F.col("is_fraud")
    rows = df.filter(label.isin(*CLASSES)).select(
        *SCORED.fieldNames(),
        F.lit(label_source).alias("label_source"),
        F.lit(run_id).alias("run_id"),
        F.lit(batch_id).cast("long").alias("batch_id"),
        label.cast("int").alias("is_fraud"),
    )
    if compact:
        rows = rows.hint("rebalance", "is_fraud")
    key = f"{label_source}/{run_id}/{batch_id}"
    about = {"source": label_source, "unique": unique}
    return write_part(rows, cfg, cfg.scored_table, key, ("is_fraud",), **about)


def write_by_class(
    df: DataFrame,
    cfg: Settings,
    label_source: str,
    run_id: str,
    batch_id: int,
    compact: bool = False,
    unique: bool = False,
) -> None:
    """Store payments by class; `is_fraud` other than 0 or 1 goes to neither class.

    Files: one pass writes both classes as folders of one part, so nothing is cached and the
    input is not read twice; the part is live once it is committed, and replaces the part of an
    earlier run of the same load. Rows of that one which were merged since are replaced by key.
    Connector: two tables, two filtered writes over a cached frame.

    Each task writes a file per class. `compact` shuffles the rows by class first, into even
    pieces, so that the rare class does not end up in as many small files as there are tasks.
    """
    if cfg.stores_files:
        part = scored_part(df, cfg, label_source, run_id, batch_id, compact, unique)
        commit(df.sparkSession, cfg, [part])
        return
    label = F.col("is_fraud")
    rows = df.filter(label.isin(*CLASSES)).select(
        *SCORED.fieldNames(), label.cast("int").alias("is_fraud")
    ).persist()
    try:
        for value, table in zip(CLASSES, (cfg.non_fraud_table, cfg.fraud_table)):
            append_table(rows.filter(F.col("is_fraud") == value).drop("is_fraud"), cfg, table)
    finally:
        rows.unpersist()


def read_scored_parts(spark: SparkSession, cfg: Settings, parts: Sequence[Part]) -> DataFrame:
    """Stored payments of some parts, with the number of the commit that stored each row."""
    layout = T.StructType([*SCORED, *SCORED_SLICES, *MERGED])
    rows = read_parts(spark, cfg, cfg.scored_table, parts, layout)
    if not parts:
        return rows.drop("part")
    # few, as merging keeps them few; a merged row carries its number itself
    numbers = [x for p in parts for x in (F.lit(p.folder.partition("=")[2]), F.lit(p.sequence))]
    committed = F.element_at(F.create_map(*numbers), F.col("part")).cast("long")
    return rows.withColumn(SEQUENCE, F.coalesce(SEQUENCE, committed)).drop("part")


def read_scored(spark: SparkSession, cfg: Settings) -> DataFrame:
    """All stored payments, with `is_fraud`, `label_source`, `run_id`, `batch_id`.

    A payment that was written again comes again, until its writes are merged.
    """
    if cfg.stores_files:
        parts = newest(spark, cfg).of(cfg.scored_table)
        return read_scored_parts(spark, cfg, parts).drop(*MERGED.fieldNames())
    return union_by_class(
        read_table(spark, cfg, cfg.non_fraud_table), read_table(spark, cfg, cfg.fraud_table)
    )


def base_and_since(parts: Sequence[Part]) -> tuple[list[Part], list[Part]]:
    """Parts that have one row per key among them, and all that were committed after them.

    Those are the merged ones, and before there are any the first part, if its keys are unique.
    """
    base = [p for p in parts if p.level == BASE]
    if not base and parts and parts[0].unique:
        base = [parts[0]]
    return base, [p for p in parts if p not in base]


def has_every_source(label_sources: Sequence[str] | None) -> bool:
    return label_sources is None or set(label_sources) >= set(LABEL_SOURCES)


def current_scored(
    spark: SparkSession, cfg: Settings, label_sources: Sequence[str] | None = None
) -> DataFrame:
    """One row per transaction number: the last write of the given sources wins.

    A connector's store keeps one row per key, and does not know sources.
    """
    if not cfg.stores_files:
        if not has_every_source(label_sources):
            raise ValueError("this store does not tell loaded labels from predicted ones")
        return read_scored(spark, cfg)
    return current_of_parts(spark, cfg, newest(spark, cfg).of(cfg.scored_table), label_sources)


def current_of_parts(
    spark: SparkSession,
    cfg: Settings,
    parts: Sequence[Part],
    label_sources: Sequence[str] | None = None,
) -> DataFrame:
    """One row per transaction number of some parts, which are in the order of their commits.

    Merged payments, or those of the first load, have one row per key already. Only the parts written
    since are brought down to their last writes, and the keys of those leave the others by an anti join;
    they are broadcast while they are few.
    """
    every = has_every_source(label_sources)
    merged, later = base_and_since(parts)
    since = [p for p in later if every or p.source is None or p.source in label_sources]
    wanted = F.lit(True) if every else F.col("label_source").isin(*label_sources)
    current = F.coalesce("is_current", F.lit(True))
    old = read_scored_parts(spark, cfg, merged).filter(current if every else wanted)
    if merged and not since:
        return old.drop(*MERGED.fieldNames())
    new = latest_scored(read_scored_parts(spark, cfg, since).filter(wanted))
    if merged:
        keys = new.select("transaction_number").filter("transaction_number is not null")
        old = old.join(few_keys(keys, since), "transaction_number", "left_anti")
    return old.unionByName(new).drop(*MERGED.fieldNames())


def few_keys(keys: DataFrame, parts: Sequence[Part]) -> DataFrame:
    """Keys of rows of the parts, broadcast if all of them fit."""
    return F.broadcast(keys) if sum(p.rows for p in parts) * KEY_BYTES <= BROADCAST_LIMIT else keys


def read_class(spark: SparkSession, cfg: Settings, is_fraud: int, latest: bool = True) -> DataFrame:
    """Payments whose last write has this class.

    With `latest` false every write counts. Of files, only that class's folders of merged payments are read.
    """
    if cfg.stores_files:
        rows = current_scored(spark, cfg) if latest else read_scored(spark, cfg)
        return rows.filter(F.col("is_fraud") == is_fraud).drop("is_fraud")
    return read_table(spark, cfg, cfg.fraud_table if is_fraud else cfg.non_fraud_table)


def union_by_class(non_fraud: DataFrame, fraud: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Both classes in one frame, matched by column name, each with its constant label."""
    return non_fraud.withColumn(label, F.lit(0)).unionByName(fraud.withColumn(label, F.lit(1)))


def commit_version(spark: SparkSession, cfg: Settings, name: str, version: str) -> None:
    """Record a finished version. It is written last, so readers never see half of one."""
    row = spark.range(1).select(
        F.lit(name).alias("name"),
        F.lit(version).alias("version"),
        F.current_timestamp().alias("committed_at"),
    )
    append_table(row, cfg, cfg.version_table)


def latest_version(spark: SparkSession, cfg: Settings, name: str) -> str | None:
    """Newest finished version of a name: one row, whatever the size of the table."""
    newest = (
        read_table(spark, cfg, cfg.version_table, VERSIONS)
        .filter(F.col("name") == name)
        .agg(F.max_by("version", F.struct("committed_at", "version")).alias("version"))
        .first()
    )
    return newest["version"]


def upsert_snapshot(
    spark: SparkSession, df: DataFrame, cfg: Settings, table: str, key: str, version: str
) -> None:
    """Add rows to a versioned table; a key that comes again replaces its old row.

    A new snapshot is written beside the old one, so a stream that reads the old one meanwhile
    is not disturbed. A version that comes again is built anew from the newest snapshot of
    another version, so a corrected file under the same name takes effect. Of rows with the same
    key within `df` the greatest, column by column, is kept.
    """
    if not cfg.stores_files:
        append_table(df, cfg, table)
        return
    df = latest_by_key(df, key, *[F.col(c).desc() for c in df.columns if c != key])
    previous, tries = _before(spark, cfg, table, version)
    if previous is not None:
        kept = read_table(spark, cfg, table, df.schema, slice_folder("version", previous))
        df = kept.join(df.select(key), key, "left_anti").unionByName(df)
    stored_as = version if not tries else f"{version}{TRY_MARK}{tries}"
    replace_slice(df, cfg, table, {"version": stored_as})
    commit_version(spark, cfg, table, stored_as)


# between the name of a version and the number of its repeated try
TRY_MARK = "~"


def _before(
    spark: SparkSession, cfg: Settings, name: str, version: str
) -> tuple[str | None, int]:
    """Newest snapshot of another version, and how often this version was committed already."""
    known = F.substring_index("version", TRY_MARK, 1)
    own = known == version.split(TRY_MARK)[0]
    found = (
        read_table(spark, cfg, cfg.version_table, VERSIONS)
        .filter(F.col("name") == name)
        .agg(
            F.max_by(
                F.when(~own, F.col("version")),
                F.when(~own, F.struct("committed_at", "version")),
            ).alias("previous"),
            F.count_if(own).alias("tries"),
        )
        .first()
    )
    return found["previous"], found["tries"]


def read_snapshot(
    spark: SparkSession, cfg: Settings, table: str, schema: T.StructType
) -> DataFrame:
    """Newest finished snapshot of a versioned table."""
    if not cfg.stores_files:
        return read_table(spark, cfg, table)
    version = latest_version(spark, cfg, table)
    if version is None:
        return spark.createDataFrame([], schema)
    return read_table(spark, cfg, table, schema, slice_folder("version", version))
