"""SparkSession factory and session-level helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC timestamps (oracle parity), ANSI on
# (Spark 4 default, stated so it is explicit), AQE for runtime coalescing and
# skew-join splitting, and no web UI.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "marketlens", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session configured for marketlens jobs.

    On a cluster the master and shuffle partitions come from spark-submit;
    locally we default to ``local[*]`` with partitions = cores.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, making sure one is set.

    Uses the cluster's shared ``spark.checkpoint.dir`` (or a directory the
    application already set); only on a local master with nothing
    configured (tests, laptops) does it fall back to a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="marketlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def checkpointed(df):
    """Reliable, eager checkpoint into the session's checkpoint directory:
    cuts the lineage and survives executor loss."""
    try:
        ensure_checkpoint_dir(df.sparkSession)
    except AttributeError:  # Spark Connect: the server owns the checkpoint dir
        pass
    return df.checkpoint(eager=True)


def dealt(df):
    """The rows over as many partitions as shuffles have.  A small or well
    compressed file is read by one task or a few; work on each row that costs
    more than shipping it is shared out first."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
