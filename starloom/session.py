"""Session helpers: a tuned SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of the library relies on. AQE re-plans joins and
# coalesces/splits partitions at run time; the UI stays off (no server).
#
# Broadcast policy: the static planner's broadcast decision rests on a file
# size estimate (compressed Parquet bytes), which is not a bound on the
# in-memory size, so it is off. Sides are broadcast either explicitly after a
# row-count proof (``broadcast_if_small``) or by AQE from the measured size of
# a finished shuffle stage.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "1MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # reliable checkpoints (dense ids) are deleted once their frame is gone,
    # so the shared checkpoint folder does not grow run after run
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "starloom",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's defaults.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` so a
    shuffle partition holds roughly 128-256 MB at the target scale.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if needed.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one is
    used as is. Only a local-mode session without the setting (tests, the
    bench) gets a private folder under the system temp directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not set in the runtime conf either
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder "
                "(HDFS/object store) for reliable checkpoints")
        configured = tempfile.mkdtemp(prefix="starloom-ckpt-",
                                      dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_finished(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and checkpoints of frames that nothing names any more.

    It does so once the driver has collected the frames as garbage, which a large heap may put
    off to the end of a load; the files of all its steps would stay on disk together.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
