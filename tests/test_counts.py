import random
from dataclasses import replace

from pyspark.sql import functions as F

from tests.test_sources import cfg, payments  # noqa: F401
from txscore.operators import features
from txscore.plans import payment_counts
from txscore.plans.merge_tables import fold_payments, merge_parts
from txscore.plans.payment_counts import (
    Counted,
    count_values,
    counted_payments,
    ordered_labels,
    read_counts,
    stored_counts,
)
from txscore.schemas import MODEL_COLUMNS
from txscore.sources.manifest import newest
from txscore.sources.tables import current_scored, write_by_class

WANTED = Counted(("category", "merchant_name"), ("amount",), 0.7)
LOADED = replace(WANTED, label_sources=("loaded",))


def some_rows(spark, dice, numbers):
    """Rows with repeats of numbers, null numbers, null values and null amounts."""
    rows = [
        (n, dice.choice(["a", "b", "Ü", "", None]), dice.choice("xyz"), dice.choice([1.0, 2.0, None]), dice.choice([0, 1]))
        for n in numbers
    ]
    made = spark.createDataFrame(
        rows, "transaction_number string, category string, merchant_name string, amount double, is_fraud int"
    )
    empty = payments(spark, [0]).limit(0)
    return empty.unionByName(made, allowMissingColumns=True)


def as_rows(counts):
    return sorted(map(tuple, counts.collect()), key=repr)


def holds(spark, cfg, counted):  # noqa: F811
    stored, counts = counted_payments(spark, cfg, counted)
    anew = count_values(current_scored(spark, cfg, counted.label_sources), counted)
    assert as_rows(counts) == as_rows(anew)
    assert as_rows(count_values(stored, counted)) == as_rows(anew)


def states(spark, cfg):  # noqa: F811
    return {p.key: p.covers for p in newest(spark, cfg).of(cfg.count_table)}


def test_counts_equal_a_recount_after_any_writes(spark, cfg):  # noqa: F811
    dice = random.Random(1)
    cfg = replace(cfg, merge_after=2, buckets=2)
    for step in range(10):
        source = dice.choice(["loaded", "loaded", "predicted"])
        rows = some_rows(spark, dice, [*dice.choices("abcdefghij", k=4), None])
        # a run id that comes again replaces its own part, unless that was merged
        write_by_class(rows, cfg, source, f"run-{dice.randrange(6)}", 0)
        dice.choice([merge_parts, fold_payments, lambda *a: None])(spark, cfg)
        if step % 3 == 2:
            holds(spark, cfg, WANTED)
            holds(spark, cfg, LOADED)


def test_a_day_reads_its_own_writes(spark, cfg, monkeypatch):  # noqa: F811
    dice = random.Random(3)
    old_rows = some_rows(spark, dice, [f"old-{i}" for i in range(40)])
    write_by_class(old_rows, cfg, "loaded", "first", 0, unique=True)
    counted_payments(spark, cfg, WANTED)
    write_by_class(some_rows(spark, dice, ["new-1", "new-2", None]), cfg, "predicted", "s", 1)
    seen = []
    real = payment_counts.count_values
    monkeypatch.setattr(
        payment_counts, "count_values", lambda rows, *a: seen.append(rows.count()) or real(rows, *a)
    )
    counted_payments(spark, cfg, WANTED)
    assert seen == [3]
    # nothing was written since: nothing is counted
    counted_payments(spark, cfg, WANTED)
    assert seen == [3]
    # replaced rows are taken off, and no others
    write_by_class(some_rows(spark, dice, ["old-3", "new-1", "new-4"]), cfg, "predicted", "s", 2)
    counted_payments(spark, cfg, WANTED)
    assert seen == [3, 3, 2]
    monkeypatch.undo()
    holds(spark, cfg, WANTED)


def test_a_part_written_again_drops_the_counts(spark, cfg):  # noqa: F811
    dice = random.Random(4)
    for run in ("a", "b"):
        write_by_class(some_rows(spark, dice, ["1", "2"]), cfg, "loaded", run, 0)
    stored_counts(spark, cfg, WANTED)
    write_by_class(some_rows(spark, dice, ["3"]), cfg, "loaded", "c", 0)
    assert WANTED.key in states(spark, cfg)
    # the part that is replaced is not covered
    write_by_class(some_rows(spark, dice, ["4"]), cfg, "loaded", "c", 0)
    assert WANTED.key in states(spark, cfg)
    write_by_class(some_rows(spark, dice, ["5"]), cfg, "loaded", "a", 0)
    assert states(spark, cfg) == {}
    holds(spark, cfg, WANTED)


def test_merges_leave_the_counts_usable(spark, cfg):  # noqa: F811
    dice = random.Random(5)
    cfg = replace(cfg, merge_after=2, buckets=2)
    for batch in range(2):
        write_by_class(some_rows(spark, dice, ["1", "2"]), cfg, "predicted", "s", batch)
    stored_counts(spark, cfg, WANTED)
    for batch in range(2, 9):
        write_by_class(some_rows(spark, dice, ["1", str(batch)]), cfg, "predicted", "s", batch)
        merge_parts(spark, cfg)
    assert WANTED.key in states(spark, cfg)
    assert len(newest(spark, cfg).of(cfg.scored_table)) <= 8
    holds(spark, cfg, WANTED)
    # a fold goes across the end of the counts, which are dropped rather than wrong
    write_by_class(some_rows(spark, dice, ["1"]), cfg, "predicted", "s", 9)
    fold_payments(spark, cfg, always=True)
    assert states(spark, cfg) == {}
    holds(spark, cfg, WANTED)


def test_counts_of_parts_that_went_are_not_stored(spark, cfg, monkeypatch):  # noqa: F811
    dice = random.Random(6)
    write_by_class(some_rows(spark, dice, ["1", "2"]), cfg, "loaded", "a", 0)
    real = payment_counts.write_part

    def overtaken(*args, **about):
        part = real(*args, **about)
        write_by_class(some_rows(spark, dice, ["1"]), cfg, "loaded", "a", 0)
        return part

    monkeypatch.setattr(payment_counts, "write_part", overtaken)
    parts, part = stored_counts(spark, cfg, WANTED)
    monkeypatch.undo()
    assert states(spark, cfg) == {}
    assert sum(r.n for r in read_counts(spark, cfg, part).collect() if r.column_name == "is_fraud") == 2
    holds(spark, cfg, WANTED)


def test_empty_store(spark, cfg):  # noqa: F811
    holds(spark, cfg, WANTED)


def test_labels_of_counts_are_those_of_a_fit(spark):
    dice = random.Random(7)
    # no empty text: the indexer's own fit refuses one
    texts = ["b", "a", "ä", "\U0001f600", "～", "Z", None]
    rows = spark.createDataFrame(
        [(str(i), "1", dice.choice(texts), dice.choice("xy"), 1.0, 2.0, 3) for i in range(200)],
        "transaction_number string, card_number string, category string, merchant_name string,"
        " distance_from_customer_address double, amount double, age_at_transaction int",
    ).withColumn("is_fraud", F.lit(0))
    columns = ("category", "merchant_name")
    labels = ordered_labels(count_values(rows, WANTED), columns)
    fitted = features.fit_preprocessor(rows.select(*MODEL_COLUMNS))
    given = features.fit_preprocessor(rows.select(*MODEL_COLUMNS), labels=labels)
    assert [list(a) for a in fitted.stages[0].labelsArray] == [list(m.labels) for m in given.stages[:2]]
    assert fitted.stages[1].categorySizes == given.stages[2].categorySizes
    both = [m.transform(rows).select("features").collect() for m in (fitted, given)]
    assert both[0] == both[1]
