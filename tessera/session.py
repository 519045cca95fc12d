"""Session construction and the shared scratch folder.

The launcher (``spark-submit``, its properties file) decides where and how
large a job runs: nothing it has set is overridden here. The scratch folder
is where jobs cut lineage (``checkpoint``) or stage intermediate files: the
shared folder named by ``spark.checkpoint.dir``. Only a local master may go
without one; on a cluster a machine-local folder would lose rows, so that
raises.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# What the library relies on where the launcher says nothing. A join fused
# with an aggregate on the same key is only split by adaptive execution when
# it may add a shuffle, hence the forced skew optimisation.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, cpus: int | None = None,
                app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. ``master`` or ``cpus`` (a local master with
    so many threads) and ``extra`` are the caller's explicit wishes; all else
    is only filled in where the launcher has not set it."""
    SparkContext._ensure_initialized()  # else SparkConf() doesn't see what the launcher set
    launched = SparkConf()
    builder = SparkSession.builder
    if not launched.contains("spark.app.name"):
        builder = builder.appName(app_name)
    conf = {k: v for k, v in _DEFAULTS.items() if not launched.contains(k)}
    if cpus and not master:
        master = f"local[{cpus}]"
    if cpus and not launched.contains("spark.sql.shuffle.partitions"):
        conf["spark.sql.shuffle.partitions"] = str(max(cpus, 8))
    if master or not launched.contains("spark.master"):
        builder = builder.master(master or "local[*]")
    spark = builder.config(map=conf | (extra or {})).getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def cluster_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 192 << 20) -> dict:
    """Settings for a cluster run sized from the input, to pass to the launcher.

    Shuffle partitions start at input / target size (never below two waves of
    the cluster's cores) so that no reduce task holds more than a couple of
    hundred MB before AQE coalesces the small ones; file splits stay at
    128 MB.
    """
    partitions = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }


def ensure_query_settings(spark: SparkSession) -> None:
    """Settings that query results depend on (dates are taken in UTC)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def is_local(master: str) -> bool:
    """One JVM: driver and executors share every folder."""
    return master == "local" or master.startswith("local[")


def _checkpoint_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not is_local(sc.master):
            raise RuntimeError(f"spark.checkpoint.dir is not set: master {sc.master} needs a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``)."""
    return _checkpoint_root(spark).rstrip("/")


_made: dict[str, list[str]] = {}  # scratch folders of each application


def scratch_dir(spark: SparkSession, name: str = "stage") -> str:
    """A fresh, never reused sub folder of the session's checkpoint folder.
    It stays until :func:`clear_scratch`, as results are lazy and read it."""
    path = f"{_checkpoint_root(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this application has made so far and
    return their number. Call it when what was computed from them has been
    written or collected; DataFrames that still read them fail afterwards."""
    from tessera.sinks.store import delete

    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete(spark, path)
    return len(paths)
