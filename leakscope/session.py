"""Session set-up and the shared folder jobs write to."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
# Text and token columns are several times larger in memory than on disk. Without this the planner
# takes a corpus scan for small and broadcasts it; adaptive execution still broadcasts what proves small.
SIZE_FACTOR = ("spark.sql.sources.fileCompressionFactor", "8.0")
# Streamed visits of a user merge inside each task before the shuffle, so a very busy user arrives small.
MERGE_SESSIONS = ("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")

_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "leakscope", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the jobs rely on.

    Cluster-owned settings (memory, executors, shared folder) are left to spark-submit; only
    behaviour that changes results or plans is fixed here.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(*SIZE_FACTOR)
        .config(*MERGE_SESSIONS)
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Where the cluster names none (local tests) a fresh folder is made for this application.
    """
    configured = (spark.conf.get(CHECKPOINT_DIR, None)
                  or spark.sparkContext.getConf().get(CHECKPOINT_DIR, None))
    app = spark.sparkContext.applicationId
    if configured:
        base = f"{configured.rstrip('/')}/leakscope-{app}"
    elif spark.sparkContext.master.startswith("local"):
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="leakscope-")
        base = _local_scratch[app]
    else:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{base}/checkpoints")
    return base


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable, on the shared folder."""
    shared_dir(spark)


def tune(spark: SparkSession) -> None:
    """Apply the settings results and plans rely on to a session made elsewhere.

    Calendar and window results are defined in UTC. Merging of streamed visits yields to the owner's choice;
    settings that steer other jobs' plans are left alone.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    name, value = MERGE_SESSIONS
    if spark.conf.get(name, "false") == "false":
        spark.conf.set(name, value)
