import random
from dataclasses import replace
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_sources import cfg, payments  # noqa: F401
from txscore.plans import merge_tables
from txscore.plans.merge_tables import fold_payments, merge_parts
from txscore.schemas import BATCH_SLICES, REJECTS
from txscore.session import file_names, path_exists, read_small_file, write_new_file
from txscore.sources import manifest
from txscore.sources.manifest import BASE, Part, commit, newest
from txscore.sources.tables import (
    current_scored,
    read_class,
    read_parts,
    read_scored,
    table_path,
    write_by_class,
)


def test_a_small_file_is_written_once(spark, tmp_path):
    path = f"{tmp_path}/folder/a.json"
    assert write_new_file(spark, path, "één")
    assert not write_new_file(spark, path, "two")
    assert read_small_file(spark, path) == "één"
    assert [n for n in file_names(spark, f"{tmp_path}/folder") if not n.startswith(".")] == ["a.json"]
    assert file_names(spark, f"{tmp_path}/none") == []


def test_of_two_writers_none_is_lost(spark, cfg, monkeypatch):  # noqa: F811
    real, stale = manifest.newest, manifest.newest(spark, cfg)
    commit(spark, cfg, [Part("t", "a", "a", 1)])
    answers = [stale]
    monkeypatch.setattr(manifest, "newest", lambda *a: answers.pop() if answers else real(*a))
    commit(spark, cfg, [Part("t", "b", "b", 1)])
    monkeypatch.undo()
    assert [(p.folder, p.sequence) for p in newest(spark, cfg).of("t")] == [("a", 1), ("b", 2)]


def test_a_merge_that_came_too_late_changes_nothing(spark, cfg):  # noqa: F811
    commit(spark, cfg, [Part("t", "a", "a", 1)])
    old = newest(spark, cfg).of("t")
    commit(spark, cfg, [Part("t", "b", "a", 1)])
    with pytest.raises(manifest.Moved):
        manifest.swap(spark, cfg, "t", old, [Part("t", "c", "c", 1)])
    assert [p.folder for p in newest(spark, cfg).of("t")] == ["b"]


def by_hand(writes, sources):
    """Last write per number of (source, [(number, amount, label)])."""
    last, alone = {}, []
    for source, rows in writes:
        for number, amount, label in rows if source in sources else []:
            if number is None:
                alone.append((number, amount, label))
            else:
                last[number] = (number, amount, label)
    return sorted([*last.values(), *alone], key=repr)


def test_merges_change_no_answer(spark, cfg):  # noqa: F811
    dice = random.Random(2)
    cfg = replace(cfg, merge_after=2, buckets=2)
    template = payments(spark, [0])
    writes = []

    def answer(sources):
        rows = current_scored(spark, cfg, sources).select("transaction_number", "amount", "is_fraud")
        return sorted(map(tuple, rows.collect()), key=repr)

    for step in range(9):
        source = dice.choice(["loaded", "predicted"])
        numbers = [*dice.sample("abcdefgh", 3), None]
        rows = [(n, float(10 * step + i), dice.randrange(2)) for i, n in enumerate(numbers)]
        writes.append((source, rows))
        df = spark.createDataFrame(rows, "n string, a double, l int").crossJoin(template.limit(1))
        df = df.withColumns({"transaction_number": F.col("n"), "amount": F.col("a"), "is_fraud": F.col("l")})
        write_by_class(df.drop("n", "a", "l"), cfg, source, "run", step)
        {0: merge_parts, 1: fold_payments, 2: lambda *a: fold_payments(*a, always=True)}.get(
            dice.randrange(4), lambda *a: None
        )(spark, cfg)
        if step in (4, 8):
            for sources in (("loaded", "predicted"), ("loaded",), ("predicted",)):
                assert answer(sources) == by_hand(writes, sources)
    fold_payments(spark, cfg, always=True)
    parts = newest(spark, cfg).of(cfg.scored_table)
    assert [p.level for p in parts] == [BASE] * 2
    assert answer(None) == by_hand(writes, ("loaded", "predicted"))
    frauds = sorted(r.amount for r in read_class(spark, cfg, 1).collect())
    assert frauds == sorted(a for _, a, label in by_hand(writes, ("loaded", "predicted")) if label == 1)
    # read with another number of buckets, nothing is lost
    other = replace(cfg, buckets=1)
    write_by_class(template.withColumn("transaction_number", F.lit("a")), other, "loaded", "run", 99)
    before = answer(None)
    assert fold_payments(spark, other, always=True) and answer(None) == before


def test_a_read_of_merged_payments_has_no_window(spark, cfg):  # noqa: F811
    write_by_class(payments(spark, [0, 1, 0]), cfg, "loaded", "a", 0)
    fold_payments(spark, cfg, always=True)
    assert "Window" not in current_scored(spark, cfg)._jdf.queryExecution().executedPlan().toString()
    write_by_class(payments(spark, [1]), cfg, "loaded", "b", 0)
    assert current_scored(spark, cfg).filter("is_fraud = 1").count() == 2


def test_folders_stay_few_over_many_batches(spark, cfg):  # noqa: F811
    cfg = replace(cfg, merge_after=8)
    layout = T.StructType([*REJECTS, *BATCH_SLICES])
    for batch in range(200):
        row = {"value": "bad", "partition": 0, "offset": batch, "reject_reason": "x", "run_id": "r", "batch_id": batch}
        parts = [Part(cfg.reject_table, manifest.new_part_folder(), f"run/{batch}", 1)]
        place = Path(table_path(cfg, cfg.reject_table)) / parts[0].folder
        place.mkdir(parents=True)
        fields = {"partition": pa.int32(), "offset": pa.int64(), "batch_id": pa.int64()}
        schema = pa.schema([(name, fields.get(name, pa.string())) for name in row])
        pq.write_table(pa.Table.from_pylist([row], schema), place / "part-0.parquet")
        # the positions of a topic replace those before
        parts.append(Part(cfg.offset_table, f"part={batch}", "topic/t", 1))
        commit(spark, cfg, parts)
        merge_parts(spark, cfg)
        live = newest(spark, cfg).of(cfg.reject_table)
        assert len(live) <= 8 * 3 and len(newest(spark, cfg).of(cfg.offset_table)) == 1
    stored = read_parts(spark, cfg, cfg.reject_table, live, layout)
    assert sorted(r.batch_id for r in stored.collect()) == list(range(200))
    # what was merged is gone from the disk, too, up to the last merges
    assert len(file_names(spark, table_path(cfg, cfg.reject_table))) <= 8 * 6
    assert len(file_names(spark, f"{cfg.warehouse}/_manifest")) <= 2 * (manifest.KEPT_RECORDS + 9)


def test_dropped_folders_outlive_one_merge(spark, cfg):  # noqa: F811
    write_by_class(payments(spark, [0, 1]), cfg, "loaded", "a", 0)
    first = newest(spark, cfg).of(cfg.scored_table)[0].folder
    old_reader = read_scored(spark, cfg)
    fold_payments(spark, cfg, always=True)
    assert old_reader.count() == 2
    for batch in (1, 2):
        write_by_class(payments(spark, [0, 1]), cfg, "loaded", "a", batch)
        fold_payments(spark, cfg, always=True)
    assert not path_exists(spark, f"{table_path(cfg, cfg.scored_table)}/{first}")
    assert merge_tables.FOLD_SHARE < 1
