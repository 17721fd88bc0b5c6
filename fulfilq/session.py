"""Session helpers.

The library never builds its own cluster configuration beyond what a job
needs to be correct: UTC session time zone (timestamps are zone-less wall
clock times in the data model) and AQE. Everything else (executor sizing,
shuffle partitions, checkpoint location) belongs to the cluster.
"""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

_REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dynamic overwrite: a batch replaces only the event_date partitions it holds.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(master: str | None = None, app_name: str = "fulfilq", **conf: str) -> SparkSession:
    """Return the active session, or a new one with the library's required settings.

    ``master`` is only used when no session exists (tests and local runs);
    on a cluster the submitting environment supplies it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    # checkpoint files are removed once their data is garbage-collected (startup-only setting)
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for k, v in {**_REQUIRED_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library's semantics depend on to an existing session."""
    for k, v in _REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local master may do without the setting: it gets a temporary folder.
    On a cluster a folder of one machine would be invisible to the others, so an
    unset location raises there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="fulfilq-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def _is_local(spark: SparkSession) -> bool:
    """``local``, ``local[N]``: driver and executors are one process (``local-cluster`` is not)."""
    master = spark.sparkContext.master or ""
    return master == "local" or master.startswith("local[")


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (never a local checkpoint).

    Used where one computed result feeds several branches of a plan: it is
    computed once, and a lost executor re-reads it instead of recomputing it.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/fulfilq-tables/{name}-{uuid.uuid4().hex}"


TARGET_SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (file-system metadata only, no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


@contextlib.contextmanager
def sized_shuffles(spark: SparkSession, nbytes: int, target: int = TARGET_SHUFFLE_PARTITION_BYTES):
    """Within the block, start shuffles with about one partition per ``target`` bytes of input.

    AQE can merge small shuffle partitions but cannot split uniformly large
    ones, so the initial count must scale with the input: at 100 TB the default
    200 would mean ~500 GB per reduce task. This raises
    ``spark.sql.adaptive.coalescePartitions.initialPartitionNum`` (never below
    what the cluster set) and puts the old value back, so one large dataset does
    not size the shuffles of later small ones. Yields the count in effect.
    """
    want = -(-nbytes // target)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    current = spark.conf.get(key, None)
    base = int(current) if current else int(spark.conf.get("spark.sql.shuffle.partitions"))
    if want <= base:
        yield base
        return
    spark.conf.set(key, str(want))
    try:
        yield want
    finally:
        if current is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, current)


_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def released_shuffles(spark: SparkSession):
    """Within the block, the shuffle files of a job go when it ends.

    Else Spark keeps them until the driver happens to collect its garbage, so a run
    of many jobs holds the shuffles of all of them. For jobs that run once (writes,
    counts, small collects): a frame made in the block and run twice would shuffle
    its rows again. Puts the old value back.
    """
    current = spark.conf.get(_FILE_CLEANUP, None)
    spark.conf.set(_FILE_CLEANUP, "true")
    try:
        yield
    finally:
        if current is None:
            spark.conf.unset(_FILE_CLEANUP)
        else:
            spark.conf.set(_FILE_CLEANUP, current)


def releases_shuffles(step):
    """The step (a function of the session and more) runs in ``released_shuffles``."""
    @functools.wraps(step)
    def run(spark: SparkSession, *args, **kwargs):
        with released_shuffles(spark):
            return step(spark, *args, **kwargs)
    return run
