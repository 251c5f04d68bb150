"""Columns with too many labels for the driver: encoded by a join with a stored table of labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txscore.operators.labels import numbered_labels
from txscore.session import new_folder

# most labels of one column that pass through the driver, or go whole to every executor
DRIVER_LABELS = 1 << 15
_LABELS = "column_name string, label string, label_index long"
_ENTRIES = "array<struct<slot: int, number: double>>"


@F.udf(VectorUDT())
def sparse_vector(size, slots, numbers):
    """Spark has no built-in function from slots to a vector."""
    return Vectors.sparse(size, slots, numbers)


class LabelSlots(Transformer, MLWritable, MLReadable):
    """What an indexer, a one-hot encoder and an assembler do, with the labels in a table.

    The driver holds one number per column. A label that is not in the table, or null, has the index
    after the last one and sets no slot. The slots of the vector have no names, as their number grows
    with the labels.
    """

    inputs = Param(Params._dummy(), "inputs", "columns of the vector, in order", TypeConverters.toListString)
    widths = Param(Params._dummy(), "widths", "slots of each of them", TypeConverters.toListInt)
    encoded = Param(Params._dummy(), "encoded", "those that have a slot per label", TypeConverters.toListString)
    output = Param(Params._dummy(), "output", "column of the vector", TypeConverters.toString)
    table = Param(Params._dummy(), "table", "folder of the labels", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputs=None, widths=None, encoded=None, output=None, table=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def labels(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_LABELS).parquet(self.getOrDefault(self.table))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        labels = self.labels(dataset.sparkSession)
        encoded = self.getOrDefault(self.encoded)
        entries, start, out = [], 0, dataset
        for name, width in zip(self.getOrDefault(self.inputs), self.getOrDefault(self.widths), strict=True):
            if name in encoded:
                own = labels.filter(F.col("column_name") == name).select(
                    F.col("label").alias("_label"), F.col("label_index").cast("int").alias("_at")
                )
                # sorted, as a hash table of the labels of a task could not spill
                own = F.broadcast(own) if width <= DRIVER_LABELS else own.hint("merge")
                out = out.join(own, F.col(name) == F.col("_label"), "left").withColumn(
                    f"{name}_indexed", F.coalesce("_at", F.lit(width)).cast("double")
                ).drop("_label", "_at")
                entries.append(_label_entry(f"{name}_indexed", start, width))
                alone = _vector(width, [_label_entry(f"{name}_indexed", 0, width)])
                out = out.withColumn(f"{name}_encoded", alone)
                out = out.withMetadata(f"{name}_encoded", _size_only(width))
            elif isinstance(dataset.schema[name].dataType, VectorUDT):
                entries.append(_vector_entries(name, start))
            else:
                entries.append(_number_entry(name, start))
            start += width
        column = self.getOrDefault(self.output)
        return out.withColumn(column, _vector(start, entries)).withMetadata(column, _size_only(start))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, stage: LabelSlots):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        labels = self.stage.labels(self.sparkSession)
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        labels.write.partitionBy("column_name").parquet(f"{path}/labels")


class _Reader(MLReader):
    def load(self, path: str) -> LabelSlots:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = LabelSlots()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        # the model was saved with its labels and may have been moved since
        return stage._set(table=f"{path}/labels")


def label_slots(
    counts: DataFrame, sizes: Mapping[str, int], inputs: Sequence[str], widths: Sequence[int], output: str
) -> LabelSlots:
    """The stage for (column_name, label, n), of which `sizes` tells how many labels each column has."""
    spark = counts.sparkSession
    folder = new_folder(spark, "labels")
    numbered = numbered_labels(counts).select("column_name", "label", "label_index")
    numbered.write.partitionBy("column_name").parquet(folder)
    return LabelSlots(
        inputs=list(inputs), widths=list(widths), encoded=[c for c in inputs if c in sizes], output=output, table=folder
    )


def _size_only(width: int) -> dict:
    return {"ml_attr": {"num_attrs": width}}


def _vector(size: int, entries: Sequence[Column]) -> Column:
    each = F.filter(F.concat(*entries), lambda e: e["number"] != 0)
    return sparse_vector(F.lit(size), F.transform(each, lambda e: e["slot"]), F.transform(each, lambda e: e["number"]))


def _entry(slot: Column, number: Column) -> Column:
    return F.struct(slot.cast("int").alias("slot"), number.cast("double").alias("number"))


def _label_entry(indexed: str, start: int, width: int) -> Column:
    at = F.col(indexed)
    return F.when(at < width, F.array(_entry(at + start, F.lit(1.0)))).otherwise(F.array().cast(_ENTRIES))


def _number_entry(name: str, start: int) -> Column:
    number = F.col(name).cast("double")
    bad = number.isNull() | F.isnan(number)
    missing = F.raise_error(F.lit(f"no number in column {name}, so no vector")).cast("double")
    return F.array(_entry(F.lit(start), F.when(bad, missing).otherwise(number)))


def _vector_entries(name: str, start: int) -> Column:
    vector = F.unwrap_udt(F.col(name))
    full = F.sequence(F.lit(0), F.size(vector["values"]) - 1)
    slots = F.coalesce(vector["indices"], full)
    return F.zip_with(slots, vector["values"], lambda slot, number: _entry(slot + start, number))
