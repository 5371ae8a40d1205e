"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every netsieve job relies on.  Time zone UTC makes epoch <-> timestamp
# conversions identical on every executor; ANSI stays on so bad casts are explicit
# (we use try_cast / try_divide where a null is wanted).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rank-filters (row_number() <= k) get a map-side WindowGroupLimit up to this k
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def get_session(master: str | None = None, app: str = "netsieve",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the netsieve settings applied."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false")
    # checkpoint files go with the frames that read them
    b = b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of CORE_CONF to an existing session."""
    for k, v in CORE_CONF.items():
        if spark.conf.isModifiable(k):     # a static setting of a shared session stays
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set (a folder that driver and executors share); only a local
    master gets one of its own, registered with the context.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="netsieve-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder for written tables."""
    return f"{checkpoint_root(spark)}/netsieve/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables that this application wrote with :func:`scratch_dir`; call when the
    results that read them have been written elsewhere."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/netsieve/{spark.sparkContext.applicationId}")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system that serves it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
