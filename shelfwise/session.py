"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the results depend on. ANSI makes bad casts and overflow raise instead of
# silently producing null; UTC keeps date casts stable across drivers.
REQUIRED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Settings for throughput at scale. AQE coalesces small shuffle partitions, converts
# sort-merge joins to broadcast joins once a side is *measured* to be small, and splits
# skewed join partitions.
PERFORMANCE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "shelfwise",
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    On a cluster, leave ``master`` unset and let ``spark-submit`` decide; the
    shuffle partition count should then be sized to the data (roughly input bytes
    / 128 MB), AQE coalesces from there.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**REQUIRED_CONF, **PERFORMANCE_CONF, "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Runtime SQL settings the operators assume; safe to call on any session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)


SHUFFLE_BYTES = 4 << 20  # of input files for each shuffle partition before AQE coalesces them


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Start shuffles with as many partitions as the input asks for, where that is more than the session has.

    A fixed number of partitions makes each grow with the input until its sorts and aggregations spill. AQE joins
    what turns out small, so the number only bounds the largest; it is never lowered.
    """
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    least = int(spark.conf.get(name, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if input_bytes // SHUFFLE_BYTES > least:
        spark.conf.set(name, str(input_bytes // SHUFFLE_BYTES))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints and intermediate tables.

    Uses the folder the cluster names in ``spark.checkpoint.dir``. Only a local
    session (tests) without that setting gets a fresh folder under the system temp
    dir; a cluster session without it is an error, because executors cannot share a
    machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder every executor can reach"
        )
    folder = tempfile.mkdtemp(prefix="shelfwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder
