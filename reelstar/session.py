"""Session helpers.

The library never builds its own SparkSession for library calls: every
operator takes DataFrames, and only tests / bench / scripts call
:func:`local_session`.  Scratch output (streaming checkpoints, versioned
tables, materialised key layouts) always goes below the shared folder the
cluster names in ``spark.checkpoint.dir``; a local folder is only chosen when
that setting is absent (tests on a laptop).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every run of the library is designed for.  AQE re-plans joins and
# coalesces small shuffle partitions from runtime statistics, and splits
# skewed sort-merge-join partitions (a hot user holding a third of all events).
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # reliable checkpoints (lineage cuts, key layouts) are deleted once their
    # DataFrame is unreferenced, so a long-running refresh app does not fill
    # the shared checkpoint folder (a startup setting: builder / submit only)
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Sizing for a large cluster (tens of TB per run).  The initial shuffle
# partition count is an upper bound that AQE coalesces down to the advisory
# size from measured map outputs, so it is set for the largest shuffle of a
# run (the partially aggregated fact at (user, day, x) grain); the skew
# threshold splits a join partition that a hot user inflates.  Scan splits
# match the advisory size.  These are applied only where the session has no
# value of its own (see :func:`apply_defaults`).
CLUSTER_CONF = {
    **{k: v for k, v in RECOMMENDED_CONF.items() if k.startswith("spark.sql.")},
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def apply_defaults(spark: SparkSession, conf: dict[str, str] | None = None) -> dict[str, str]:
    """Set each key of ``conf`` (default :data:`CLUSTER_CONF`) that the
    session has not set explicitly; returns what was set.  Values the
    cluster operator configured always win."""
    conf = CLUSTER_CONF if conf is None else conf
    explicit = dict(spark.sparkContext.getConf().getAll())
    applied = {}
    for k, v in conf.items():
        if k in explicit:
            continue
        spark.conf.set(k, v)
        applied[k] = v
    return applied


def local_session(
    app: str = "reelstar",
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Order: the context's checkpoint dir, then ``spark.checkpoint.dir`` from the
    session; only when both are unset (a test) a fresh local folder is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf_dir:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="reelstar-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return checkpoint_root(spark)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/reelstar-work/{purpose}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (used only by tests that write fixture files)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder on whatever file system holds it."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
