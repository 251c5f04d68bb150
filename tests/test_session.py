import pytest
from pyspark.sql import functions as F

from tests.plans import planned
from txscore.session import RUNTIME_CONF, new_folder, shared_folder, tune


class ClusterSession:
    """Only what the folder lookup asks for."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "spark://elsewhere"

        @staticmethod
        def getCheckpointDir():
            return None


def test_folder_is_the_one_the_cluster_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    assert first != second and first.startswith(shared_folder(spark) + "/x-")


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(ClusterSession)


def test_tune_sets_what_results_depend_on(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    tune(spark)
    assert {k: spark.conf.get(k) for k in RUNTIME_CONF} == RUNTIME_CONF


def test_large_side_in_small_files_is_not_broadcast(spark, tmp_path):
    """Ordered keys compress well, so the planner takes the files of this side for a small table."""
    tune(spark)
    spark.range(1_500_000).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "orders"))
    spark.range(2_000).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "lines"))
    orders, lines = (spark.read.parquet(str(tmp_path / name)) for name in ("orders", "lines"))
    joined = lines.unionAll(orders).join(orders, "k").agg(F.count(F.lit(1)).alias("n"))
    assert joined.collect()[0]["n"] == 1_502_000
    assert "Broadcast" not in planned(joined)
