"""SparkSession construction with the settings every job here relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings applied to every session built here. AQE re-plans at runtime: it coalesces
# small shuffle partitions, splits skewed join partitions, and turns a sort-merge join
# into a broadcast join only after measuring the real size of the small side.
# The planner's own broadcast choice from file-size estimates is switched off: an
# estimate is not a bound (compressed files expand), so a side is broadcast only behind
# an explicit row-count probe (operators.joins) or AQE's measured shuffle size.
BASE_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # Shuffle partitions are merged up to here: what one task sorts and aggregates stays at a few
    # hundred MB (two hash maps over rows that hardly repeat took 1.2 GB at the default of 64 MB).
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that needs an exchange after the join: the
    # events join feeds an aggregation on the same key, and without this a key holding a
    # third of all events would stay in one task. The extra exchange runs after partial
    # aggregation, so it is small.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The call site of every Column in error messages costs a third of the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Checkpoint files (the rider score's lineage cut) are removed once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    app: str = "lastmile",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session.

    ``master`` and ``shuffle_partitions`` default to the cluster's own settings; pass them
    for local runs. A checkpoint directory is only created when the cluster has not
    configured ``spark.checkpoint.dir`` (tests, laptops).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("LASTMILE_DRIVER_MEMORY", "8g"))
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate data: ``spark.checkpoint.dir``.

    Only a local master gets a private folder where the setting is missing (tests, laptops);
    on a cluster executors could not read it, so that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: only the setting counts
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="lastmile-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def is_local(master: str) -> bool:
    """True if driver and executors are one process."""
    return master == "local" or master.startswith("local[")
