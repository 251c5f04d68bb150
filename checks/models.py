"""Features, balancing, forest and retraining."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.base import query, scratch_settings, view, with_views
from checks.columns import history
from checks.scans import AS_OF, history_settings
from txscore.operators import balance, features
from txscore.operators.forest import fit_forest, score
from txscore.operators.labels import label_index
from txscore.operators.splits import random_split as split_at_random
from txscore.plans.load_history import load_history
from txscore.plans.payment_counts import CLASS, VALUE, count_values, counted_payments
from txscore.plans.train_models import (
    CLUSTERED,
    KEY,
    NUMBERS,
    TrainingOptions,
    counted_by,
    train,
    train_models,
)
from txscore.schemas import MODEL_COLUMNS
from txscore.sources.models import load_models, save_models
from txscore.sources.tables import current_scored, write_by_class
from txscore.streaming.scoring import score_batch

STRINGS = ["category", "merchant_name"]


def labelled(spark, sf_dir):
    """Key, model columns and label of the enriched history."""
    return history(spark, sf_dir).select(
        "transaction_number", *MODEL_COLUMNS, F.col("is_fraud").alias("label")
    )


_LABELLED = (
    ", labelled as (select transaction_number, "
    + ", ".join(MODEL_COLUMNS)
    + ", is_fraud as label from history)\n"
)


def _ranked(name: str, column: str, where: str = "true") -> str:
    return f""", {name} as (
  select {column} as label_text, count(*) as n,
         row_number() over (order by count(*) desc, {column}) - 1 as label_index
  from labelled where {where} group by {column})
"""


# --- labels and vectors


@query(
    "index_labels",
    with_views("payments")
    + """, pairs as (select 'category' as column_name, category as label from payments
              union all select 'merchant_name', merchant_name from payments
              union all select 'card_number', card_number from payments)
select column_name, label, count(*) as n,
       row_number() over (partition by column_name order by count(*) desc, label) - 1 as label_index
from pairs group by column_name, label""",
)
def index_labels(spark, sf_dir):
    return label_index(view(spark, sf_dir, "payments"), [*STRINGS, "card_number"])


# fitted on fraud alone, so that other categories are unseen values
_FRAUD_LABELS = (
    with_views("history")
    + _LABELLED
    + _ranked("categories", "category", "label = 1")
    + _ranked("merchants", "merchant_name", "label = 1")
)


def _encoded_by_fraud(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    model = features.fit_preprocessor(rows.filter("label = 1").select(*MODEL_COLUMNS))
    return model.transform(rows)


@query(
    "index_values",
    _FRAUD_LABELS
    + """select transaction_number,
       cast(coalesce(c.label_index, (select count(*) from categories)) as double)
         as category_indexed,
       cast(coalesce(m.label_index, (select count(*) from merchants)) as double)
         as merchant_name_indexed
from labelled t
left join categories c on t.category = c.label_text
left join merchants m on t.merchant_name = m.label_text""",
)
def index_values(spark, sf_dir):
    return _encoded_by_fraud(spark, sf_dir).select(
        "transaction_number", "category_indexed", "merchant_name_indexed"
    )


@query(
    "one_hot_sums",
    _FRAUD_LABELS
    + """, slots as (
  select 'category_encoded' as vector, label_index as slot, label_text from categories
  union all select 'merchant_name_encoded', label_index, label_text from merchants)
select l.label, s.vector, cast(s.slot as int) as slot,
       cast(count(t.transaction_number) as double) as total
from (select distinct label from labelled) l cross join slots s
left join labelled t on t.label = l.label
  and s.label_text = case s.vector when 'category_encoded' then t.category else t.merchant_name end
group by l.label, s.vector, s.slot""",
)
def one_hot_sums(spark, sf_dir):
    encoded = _encoded_by_fraud(spark, sf_dir)
    return balance.slot_sums(encoded, "label", [f"{c}_encoded" for c in STRINGS])


_ALL_LABELS = (
    with_views("history")
    + _LABELLED
    + _ranked("categories", "category")
    + _ranked("merchants", "merchant_name")
)


def _vectors(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    model = features.fit_preprocessor(rows.select(*MODEL_COLUMNS))
    return model.transform(rows).select("transaction_number", features.FEATURES, "label")


# what every slot of the assembled vector sums up to, by label
_SLOT_SUMS = (
    _ALL_LABELS
    + """, nc as (select count(*) as n from categories), nm as (select count(*) as n from merchants)
, entries as (
  select t.label, c.label_index as slot, 1e0 as x
    from labelled t join categories c on t.category = c.label_text
  union all select t.label, nc.n + m.label_index, 1e0
    from labelled t join merchants m on t.merchant_name = m.label_text cross join nc
  union all select t.label, nc.n + nm.n, distance_from_customer_address
    from labelled t cross join nc cross join nm
  union all select t.label, nc.n + nm.n + 1, amount from labelled t cross join nc cross join nm
  union all select t.label, nc.n + nm.n + 2, age_at_transaction
    from labelled t cross join nc cross join nm)
, grid as (
  select label, slot from (select distinct label from labelled)
  cross join (select unnest(range(nc.n + nm.n + 3)) as slot from nc cross join nm))
""")


@query(
    "assemble_features",
    _SLOT_SUMS
    + """select g.label, cast(g.slot as int) as slot, round(coalesce(sum(e.x), 0e0), 2) as total
from grid g left join entries e on g.label = e.label and g.slot = e.slot
group by g.label, g.slot""",
)
def assemble_features(spark, sf_dir):
    """Every slot of the assembled vector, summed over the rows of a label."""
    sums = balance.slot_sums(_vectors(spark, sf_dir), "label", [features.FEATURES])
    return sums.select("label", "slot", F.round("total", 2).alias("total"))


@query(
    "feature_stages",
    with_views("history")
    + """select 'category_encoded' as input, count(distinct category) as slots from history
union all select 'merchant_name_encoded', count(distinct merchant_name) from history
union all select 'distance_from_customer_address', 1 union all select 'amount', 1
union all select 'age_at_transaction', 1""",
)
def feature_stages(spark, sf_dir):
    """Inputs of the vector by column type, and how many slots each got from the data."""
    rows = labelled(spark, sf_dir).select(*MODEL_COLUMNS)
    indexer, _, assembler = features.fit_preprocessor(rows).stages
    slots = {
        f"{c}_encoded": len(labels)
        for c, labels in zip(indexer.getInputCols(), indexer.labelsArray)
    }
    inputs = [(name, slots.get(name, 1)) for name in assembler.getInputCols()]
    return spark.createDataFrame(inputs, "input string, slots long")


# --- balancing


@query(
    "class_weights",
    with_views("payments")
    + """select is_fraud, count(*) as n, min(count(*)) over () / cast(count(*) as double) as weight
from payments group by is_fraud""",
)
def class_weights(spark, sf_dir):
    return balance.class_weights(view(spark, sf_dir, "payments"), "is_fraud")


@query(
    "cluster_means",
    with_views("history")
    + """, long_rows as (
  select category, 0 as slot, distance_from_customer_address as x from history
  union all select category, 1, amount from history
  union all select category, 2, age_at_transaction from history)
select category, count(*) as n, slot, round(avg(x), 6) as mean from long_rows
group by category, slot""",
)
def cluster_means(spark, sf_dir):
    """Mean vector per group, for groups that SQL can name."""
    rows = VectorAssembler(inputCols=NUMBERS, outputCol=features.FEATURES).transform(
        history(spark, sf_dir).select("category", *NUMBERS)
    )
    means = balance.cluster_means(rows, "category")
    exploded = means.select(
        "category", "n", F.posexplode(vector_to_array(features.FEATURES)).alias("slot", "mean")
    )
    return exploded.withColumn("mean", F.round("mean", 6))


def _fraud_many_centers(vectors):
    """Centres of the rows without fraud, as many as there are rows with fraud."""
    size = balance.class_sizes(vectors)[1]
    return balance.cluster_centers(vectors.filter("label = 0"), size), size


@query(
    "kmeans_centers",
    _SLOT_SUMS
    + """select cast(g.slot as int) as slot, (select count(*) from labelled where label = 0) as n_rows,
       round(coalesce(sum(e.x), 0e0), 2) as total
from grid g left join entries e on g.label = e.label and g.slot = e.slot
where g.label = 0 group by g.slot""",
)
def kmeans_centers(spark, sf_dir):
    """Centres times the rows they stand for: slot by slot what all those rows sum up to."""
    centers, _ = _fraud_many_centers(_vectors(spark, sf_dir))
    parts = centers.select(
        "n", F.posexplode(vector_to_array(features.FEATURES)).alias("slot", "mean")
    )
    return parts.groupBy("slot").agg(
        F.sum("n").alias("n_rows"), F.round(F.sum(F.col("n") * F.col("mean")), 2).alias("total")
    )


@query(
    "kmeans_far_groups",
    with_views("history")
    + """select category, count(*) as n, round(avg(amount), 6) as mean_amount,
       round(avg(age_at_transaction), 6) as mean_age
from history group by category""",
)
def kmeans_far_groups(spark, sf_dir):
    """Groups much farther apart than wide: one centre each, on the exact mean."""
    rows = history(spark, sf_dir).select("category", "amount", "age_at_transaction")
    names = [r["category"] for r in rows.select("category").distinct().orderBy("category").collect()]
    far = F.array_position(F.array(*map(F.lit, names)), F.col("category")) * 1e7
    placed = VectorAssembler(
        inputCols=["far", "amount", "age_at_transaction"], outputCol=features.FEATURES
    ).transform(rows.withColumn("far", far.cast("double")))
    centers = balance.cluster_centers(placed, len(names))
    at = vector_to_array(features.FEATURES)
    return centers.select(
        F.element_at(F.array(*map(F.lit, names)), F.round(at[0] / 1e7).cast("int")).alias("category"),
        "n",
        F.round(at[1], 6).alias("mean_amount"),
        F.round(at[2], 6).alias("mean_age"),
    )


@query(
    "balanced_training_set",
    _SLOT_SUMS
    + """, sizes as (select label, count(*) as n from labelled group by label)
, fraud as (select n from sizes where label = 1)
select g.label, cast(g.slot as int) as slot, cast(max(fraud.n) as double) as total_weight,
       round(coalesce(sum(e.x), 0e0) * max(fraud.n) / max(sizes.n), 2) as total
from grid g join sizes on g.label = sizes.label cross join fraud
left join entries e on g.label = e.label and g.slot = e.slot
group by g.label, g.slot""",
)
def balanced_training_set(spark, sf_dir):
    """All fraud rows, and centres in place of the rest: both classes weigh the same, and the
    weighted centres sum up to the other rows, scaled down."""
    vectors = _vectors(spark, sf_dir)
    centers, size = _fraud_many_centers(vectors)
    rows = balance.clustered(vectors.filter("label = 1"), centers, size)
    parts = rows.select(
        "label", "weight", F.posexplode(vector_to_array(features.FEATURES)).alias("slot", "x")
    )
    return parts.groupBy("label", "slot").agg(
        F.round(F.sum("weight"), 3).alias("total_weight"),
        F.round(F.sum(F.col("weight") * F.col("x")), 2).alias("total"),
    )


@query(
    "wide_column_slots",
    with_views("payments")
    + """select count(distinct transaction_number) as n_labels, count(*) as n_rows,
       count(distinct transaction_number) + 1 as n_slots from payments""",
)
def wide_column_slots(spark, sf_dir):
    """A column of tens of thousands of values gets a slot for each, like any other."""
    rows = view(spark, sf_dir, "payments").select("transaction_number", "amount")
    model = features.fit_preprocessor(rows, leave_out=())
    encoded = model.transform(rows)
    slots = encoded.schema[features.FEATURES].metadata["ml_attr"]["num_attrs"]
    return encoded.agg(
        F.countDistinct("transaction_number_indexed").alias("n_labels"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(slots).cast("long").alias("n_slots"),
    )


@query(
    "clustered_retrain",
    with_views("history")
    + """select 'kmeans' as method, 'balanced' as evaluated_on, count(*) as n_rows,
       cast(0 as bigint) as n_unusable, true as beats_guessing from history""",
)
def clustered_retrain(spark, sf_dir):
    """Every string column encoded, as many centres as fraud rows, measured on balanced rows."""
    measured = train(labelled(spark, sf_dir).select(KEY, *MODEL_COLUMNS, "label"), CLUSTERED).metrics
    return measured.select("method", "evaluated_on", "n_rows", "n_unusable", _beats_guessing())


def _beats_guessing():
    found = F.col("true_positives") / (F.col("true_positives") + F.col("false_negatives"))
    cleared = F.col("true_negatives") / (F.col("true_negatives") + F.col("false_positives"))
    return (found + cleared > 1).alias("beats_guessing")


@query(
    "undersampled_classes",
    with_views("payments")
    + """select is_fraud as label, case when is_fraud = 1 then count(*) else 0 end as n_kept, true as is_near
from payments group by is_fraud""",
)
def undersampled_classes(spark, sf_dir):
    """All fraud rows are kept; of the rest, about as many."""
    rows = view(spark, sf_dir, "payments").select(
        "transaction_number", F.col("is_fraud").alias("label")
    )
    sizes = balance.class_sizes(rows)
    kept = balance.undersampled(rows, sizes, "transaction_number").groupBy("label")
    # a number that repeats is kept or left out as a whole, which widens the spread
    near = F.abs(F.col("n") - sizes[1]) <= 8 * F.sqrt(F.lit(float(sizes[1])))
    return kept.agg(F.count(F.lit(1)).alias("n")).select(
        "label", F.when(F.col("label") == 1, F.col("n")).otherwise(0).alias("n_kept"), near.alias("is_near")
    )


@query(
    "random_split",
    with_views("payments")
    + "select is_fraud, count(*) as n_rows, true as is_near from payments group by is_fraud",
)
def random_split(spark, sf_dir):
    """Every row lands on exactly one side, about seven in ten in training."""
    train, test = split_at_random(view(spark, sf_dir, "payments").select("is_fraud"))
    sides = train.withColumn("is_train", F.lit(True)).unionByName(
        test.withColumn("is_train", F.lit(False))
    )
    counted = sides.groupBy("is_fraud").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("is_train").alias("n_train")
    )
    spread = F.sqrt(F.col("n_rows") * 0.21)
    near = F.abs(F.col("n_train") - 0.7 * F.col("n_rows")) <= 5 * spread
    return counted.select("is_fraud", "n_rows", near.alias("is_near"))


# --- forest


def _weighted_models(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    preprocessor = features.fit_preprocessor(rows.select(*MODEL_COLUMNS))
    vectors = preprocessor.transform(rows).select(features.FEATURES, "label")
    weighted = balance.weighted(vectors, balance.class_sizes(vectors))
    return rows, preprocessor, fit_forest(weighted, weight=balance.WEIGHT)


def mostly_right(predictions, label="label", prediction="prediction"):
    """(label, n, is_mostly_right): rows per true class, and whether nine in ten were found."""
    right = F.avg((F.col(label) == F.col(prediction)).cast("double")) > 0.9
    return predictions.groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"), right.alias("is_mostly_right")
    )


@query(
    "rf_fit_predict",
    with_views("history")
    + "select is_fraud as label, count(*) as n, true as is_mostly_right from history"
    " group by is_fraud",
)
def rf_fit_predict(spark, sf_dir):
    """Every row is scored, and both classes are recognised."""
    rows, preprocessor, forest = _weighted_models(spark, sf_dir)
    return mostly_right(score(rows, preprocessor, forest))


@query(
    "model_roundtrip",
    with_views("history")
    + "select is_fraud as label, count(*) as n, cast(0 as bigint) as n_different from history group by is_fraud",
)
def model_roundtrip(spark, sf_dir):
    """Saved and loaded models predict what the fitted ones predict, row by row."""
    rows, preprocessor, forest = _weighted_models(spark, sf_dir)
    cfg = scratch_settings(spark)
    save_models(spark, cfg, preprocessor, forest, "first")
    loaded = load_models(cfg, "first")
    fitted = score(rows, preprocessor, forest).withColumnRenamed("prediction", "fitted")
    both = score(fitted, *loaded)
    return both.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("fitted") != F.col("prediction")).alias("n_different"),
    )


@query(
    "retrain_job",
    with_views("history")
    + """select version, cast(count(*) as bigint) as n_rows, cast(0 as bigint) as n_unusable,
       cast(count(*) filter (substr(md5(transaction_number), 1, 4) >= 'b333') as bigint) as n_test,
       true as beats_guessing
from history cross join (select unnest(['day-1', 'day-2']) as version)
group by version""",
)
def retrain_job(spark, sf_dir):
    """Load, train, train again on the next day: two versions, each measured on held-out rows."""
    cfg = history_settings(spark, sf_dir)
    load_history(spark, cfg, "first", F.to_date(F.lit(AS_OF)))
    days = [
        train_models(spark, cfg, version, TrainingOptions(method=method))
        for version, method in (("day-1", "weights"), ("day-2", "undersample"))
    ]
    return (
        days[0]
        .unionByName(days[1])
        .select("version", "n_rows", "n_unusable", "n_test", _beats_guessing())
    )


@query(
    "retrain_after_replay",
    with_views("outcome", "history")
    + """select count(distinct transaction_number) as n_rows, cast(0 as bigint) as n_unusable
from (select transaction_number from history
      union all select transaction_number from outcome where reject_reason is null)""",
)
def retrain_after_replay(spark, sf_dir):
    """A load, the same records scored by two streams, then a training: each payment counts once."""
    cfg = history_settings(spark, sf_dir)
    load_history(spark, cfg, "first", F.to_date(F.lit(AS_OF)))
    records = view(spark, sf_dir, "payments_json")

    def by_amount(payments):
        return payments.withColumn("prediction", (F.col("amount") >= 100).cast("double"))

    for run_id in ("one", "two"):
        score_batch(records, 0, run_id, cfg, by_amount)
    metrics = train_models(spark, cfg, "day-1", TrainingOptions(trees=3))
    return metrics.select("n_rows", "n_unusable")


_DAY = "cast(transaction_number as bigint) % 3"
_AGAIN = "cast(transaction_number as bigint) % 5 = 0"


@query(
    "counts_after_three_days",
    with_views("history")
    + f""", stored as (
  select transaction_number,
         case when {_DAY} < 2 and {_AGAIN} then 'corrected' else category end as category,
         merchant_name,
         case when {_DAY} < 2 and {_AGAIN} then 1 - is_fraud else is_fraud end as is_fraud
  from history)
select 'is_fraud' as column_name, cast(is_fraud as varchar) as value, true as is_usable,
       substr(md5(transaction_number), 1, 4) < 'b333' as trains, count(*) as n, true as as_recounted
from stored group by is_fraud, trains
union all
select 'category', category, true, null, count(*), true from stored group by category
union all
select 'merchant_name', merchant_name, true, null, count(*), true from stored group by merchant_name""",
)
def counts_after_three_days(spark, sf_dir):
    """A third of the payments a day, with corrections of a part of the day before; the counts of each
    day are those of the day before and what was written since. Equal to counting all anew."""
    cfg = scratch_settings(spark)
    rows = history(spark, sf_dir)
    counted = counted_by(rows, TrainingOptions())
    again = rows.filter(_AGAIN).withColumns({
        "category": F.lit("corrected"), CLASS: 1 - F.col(CLASS)
    })
    for day in range(3):
        written = rows.filter(f"{_DAY} = {day}").unionByName(again.filter(f"{_DAY} = {day - 1}"))
        write_by_class(written, cfg, "loaded", f"day-{day}", 0, unique=True)
        payments, counts = counted_payments(spark, cfg, counted)
    anew = count_values(current_scored(spark, cfg), counted).withColumnRenamed("n", "n_anew")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in VALUE]
    both = counts.alias("a").join(anew.alias("b"), same, "full")
    return both.select(
        *[F.col(f"a.{c}").alias(c) for c in VALUE],
        F.col("a.n").alias("n"),
        F.col("a.n").eqNullSafe(F.col("b.n_anew")).alias("as_recounted"),
    )
