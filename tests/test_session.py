"""Session helpers: scratch folders, cluster sizing, launcher settings, skew."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tessera.session import cluster_settings, is_local, scratch_dir
from tessera.sources.tables import table
from tests.conftest import ROOT, SF_SMALL


def test_scratch_dirs_are_fresh_and_under_the_checkpoint_folder(spark):
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert root and (a.startswith(root.rstrip("/")) or a.startswith(root.rsplit("/", 1)[0]))


def test_cluster_settings_scale_with_input():
    small = cluster_settings(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"  # two waves of cores
    for size, cores in ((1 << 40, 800), (100 << 40, 8000)):
        assert int(cluster_settings(size, cores)["spark.sql.shuffle.partitions"]) == -(-size // (192 << 20))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_keep_their_splits_unless_asked(spark):
    assert "Exchange" not in _plan(table(spark, SF_SMALL, "lineitem"))
    assert "hashpartitioning(l_orderkey" in _plan(table(spark, SF_SMALL, "lineitem", partitions=4))


def test_launcher_settings_survive():
    """A submitted job keeps the launcher's master and partition count."""
    job = ("from tessera.session import get_session; s = get_session(); "
           "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), "
           "s.conf.get('spark.sql.adaptive.forceOptimizeSkewedJoin'))")
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=777 --conf spark.ui.enabled=false pyspark-shell",
                        "PYTHONPATH": ROOT}
    out = subprocess.run([sys.executable, "-c", job], env=env, capture_output=True, text=True, timeout=180)
    assert "GOT local[2] 777 true" in out.stdout, out.stderr[-2000:]


def test_a_cluster_without_a_shared_folder_raises():
    class Context:
        master = "yarn"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session())
    assert is_local("local") and is_local("local[4]") and not is_local("local-cluster[3,2,1024]")


@pytest.mark.parametrize("fused", [False, True])
def test_a_product_with_a_third_of_all_reviews_is_split(spark, fused):
    """Plain joins: adaptive execution splits the hot key, also where the join
    is fused with an aggregate on its key."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.forceOptimizeSkewedJoin": "true", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        li = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(6)).otherwise(F.col("id") % 500).alias("k"), F.rand(3).alias("v"))
        part = spark.range(500).select(F.col("id").alias("p"), (F.col("id") % 7).alias("g"))
        joined = li.join(part, li.k == part.p)
        out = joined.groupBy("p" if fused else "g").agg(F.count("v").alias("n"), F.sum("v"))
        assert sum(r.n for r in out.collect()) == 60_000
        assert "skew=true" in _plan(out)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_register_views_over_tables(spark):
    from tessera.sources.tables import register_views
    register_views(spark, SF_SMALL, names=("part", "lineitem"))
    n = spark.sql("SELECT count(*) AS n FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey").first().n
    assert n == table(spark, SF_SMALL, "lineitem").count()


def test_scratch_folders_go_when_cleared(spark):
    import os

    from tessera.operators.ordering import with_position
    from tessera.session import clear_scratch, scratch_dir
    clear_scratch(spark)
    out = with_position(spark.range(10), ["id"])
    assert out.count() == 10
    path = scratch_dir(spark, "mine")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path.removeprefix("file:"))
    assert clear_scratch(spark) >= 2 and not os.path.isdir(path.removeprefix("file:"))
    assert clear_scratch(spark) == 0
