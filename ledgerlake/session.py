"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on: ANSI semantics with try_* casts,
# UTC dates, adaptive execution (runtime broadcast/skew/coalesce decisions).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when the operator after the join then needs
    # its own exchange (the facts join is followed by an aggregate on adsh)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # size coalesced shuffle partitions by bytes, not by maximum parallelism
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# For the filing models: their keys and names compress some 25-fold, so 16 MB of
# shuffle are 400 MB in a task's sort or window.
MODEL_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 << 20),
    # a task that lands one archive writes one srcdir: no sort of all its rows by srcdir first
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    # a persisted side has partitions by its size, not 200 of a few rows that each write 200 more
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}

# Only for a local session started by this process (tests, bench): the driver
# JVM is the whole "cluster", so it gets the memory.
LOCAL_CONF = {
    "spark.driver.memory": "8g",
    # one machine: keep every core busy rather than packing shuffle output
    # into few large partitions (the cluster setting above prefers size)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
}


def build_session(master: str | None = None, app: str = "ledgerlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {**BASE_CONF, **MODEL_CONF}
    if master and master.startswith("local"):
        conf.update(LOCAL_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession, models: bool = True) -> SparkSession:
    """Apply the runtime-settable part of BASE_CONF (with ``models`` of MODEL_CONF
    too, and, on a local master, of LOCAL_CONF) to an existing session."""
    conf = {**BASE_CONF, **MODEL_CONF} if models else dict(BASE_CONF)
    try:
        if spark.sparkContext.master.startswith("local"):
            conf.update({k: v for k, v in LOCAL_CONF.items() if k.startswith("spark.sql.")})
    except Exception:  # remote session
        pass
    for k, v in conf.items():
        if k.startswith("spark.sql."):  # the others are fixed once a session runs
            spark.conf.set(k, v)
    return spark


SOURCE_BYTES_PER_PARTITION = 2 << 20  # source tables are packed some four times denser than the rows shuffled from them


def size_shuffles(spark: SparkSession, source_bytes: int) -> None:
    """Begin the shuffles of a large source in so many partitions that one stays below the advisory size: adaptive
    execution joins small ones, but splits none that is merely large, so a fixed number would grow with the input.
    A session keeps the largest number it was given."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    n = source_bytes // SOURCE_BYTES_PER_PARTITION
    if n > int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(key, str(n))


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as given.  Only when it is unset (local tests) a scratch folder is created.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # remote (Connect) session: the server owns the checkpoint folder
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("spark.checkpoint.dir is not set")
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for "
                               "checkpoints and intermediate tables")
        # the setting itself cannot be changed on a running session
        d = sc.getCheckpointDir()
        if d is None:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlake-ckpt-"))
            d = sc.getCheckpointDir()
        return d
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for an intermediate table."""
    return os.path.join(checkpoint_dir(spark), "tables", name)


def cluster_conf(num_bytes: int, cores: int, tag_fraction: float = 0.05,
                 target_partition_bytes: int = 128 << 20) -> dict:
    """Starting sizes for a cluster run over ``num_bytes`` of landed ``num``.

    Only the facts pruned to the model tags (``tag_fraction`` of ``num``) are
    shuffled, after partial aggregation; the initial shuffle partition count
    covers that volume at ``target_partition_bytes`` each (AQE coalesces down
    from there and splits skewed partitions), and never falls below the core
    count.  Scans read 256 MB splits."""
    shuffled = int(num_bytes * tag_fraction)
    parts = max(cores * 2, -(-shuffled // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
