"""Session settings that the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# fixed value: largest table side sent whole to every executor, where its rows were measured
BROADCAST_LIMIT = 52_428_800
# the same where only the planner knows a size. It goes by compressed files and the share of the columns
# read, a tenth of the rows in memory or less, and the driver holds several copies of what it sends.
PLANNED_LIMIT = 1_048_576
# the same for a side that was shuffled first, by the bytes that were counted there
SHUFFLED_LIMIT = 16_777_216

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": str(PLANNED_LIMIT),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(SHUFFLED_LIMIT),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the same inside the micro-batches of the stream, whose join is cached before it is used
    "spark.sql.adaptive.streaming.stateless.enabled": "true",
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    # customers beyond the broadcast limit still fit a hash table per task: no sort of payments
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "67108864",
    # cards beyond the broadcast limit cut a large scan of customers by a Bloom filter of 8 MiB at most
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set what results depend on (time zone) and what skewed joins depend on (AQE).

    Sizes that depend on the cluster (shuffle partitions, split size, memory) stay with
    whoever submits the job, and so does the master.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build(app_name: str) -> SparkSession:
    return tune(SparkSession.builder.appName(app_name).getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint folder.

    Only a local master, as in tests, may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        # `local` and `local[n]` are one process; `local-cluster` is not
        if context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="txscore-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system, so that a missing folder is no failed load in the log."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    place, files = _file_system(spark, folder)
    if not files.exists(place):
        return []
    paths = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(files.listStatus(place))
    return [path.getName() for path in paths]


def read_small_file(spark: SparkSession, path: str) -> str:
    place, files = _file_system(spark, path)
    stream = files.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole or not at all; false if there is one already, which then stays."""
    folder, _, name = path.rpartition("/")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    half, files = _file_system(spark, f"{folder}/.{uuid.uuid4().hex}-{name}")
    stream = files.create(half, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    place = jvm.org.apache.hadoop.fs.Path(path)
    # a rename that never overwrites, which a plain file system's own rename does not promise
    never = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    whole = files.makeQualified(place)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), conf).rename(
            files.makeQualified(half), whole, never
        )
    except Exception:
        files.delete(half, False)
        if files.exists(place):
            return False
        raise
    return True


def remove_path(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.delete(place, True)
