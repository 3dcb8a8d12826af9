"""Session construction and session-level settings."""

from __future__ import annotations

import os
import tempfile
import threading

from pyspark.sql import SparkSession

# Settings every tidemark job relies on.  UTC pins DATE()/unix_* to one zone.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.compression.codec": "snappy",
    # checkpoint files of DataFrames that are gone are removed by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Cluster profile (~100 TB inputs): let AQE size shuffle partitions by bytes instead
# of spreading small stages over every core, start from many partitions so the
# largest stages have room, and read files in large splits.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.shuffle.partitions": "16384",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
}


def get_session(master: str | None = None, app: str = "tidemark",
                shuffle_partitions: int | None = None,
                extra: dict | None = None, profile: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the tidemark defaults.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass
    ``local[*]`` and a small shuffle partition count.
    """
    b = SparkSession.builder.appName(app)
    conf = dict(BASE_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the whole cluster
            conf["spark.driver.memory"] = os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_session_conf(spark)
    return spark


_SHIPPED: set[str] = set()
_SHIP_LOCK = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidemark`` importable in the executors' Python workers (the
    ``mapInPandas`` helpers are pickled by reference to their module): zip the
    package once per application and register it with ``addPyFile``."""
    sc = spark.sparkContext
    with _SHIP_LOCK:
        if sc.applicationId in _SHIPPED:
            return
        import shutil
        pkg = os.path.dirname(os.path.abspath(__file__))
        out = tempfile.mkdtemp(prefix="tidemark-pkg-")
        archive = shutil.make_archive(os.path.join(out, "tidemark"), "zip",
                                      root_dir=os.path.dirname(pkg), base_dir="tidemark")
        sc.addPyFile(archive)
        _SHIPPED.add(sc.applicationId)


def apply_session_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of BASE_CONF to an existing session and ship
    the package to the executors."""
    ship_package(spark)
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        try:
            spark.conf.set(k, BASE_CONF[k])
        except Exception:  # static conf on a shared session: keep what is there
            pass


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only when the setting is absent (local tests) a scratch folder is created and
    registered; on a cluster the configured shared folder is always used.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(d)
    return d
