"""Session settings and the shared scratch location.

Everything time-related in the warehouse is computed in UTC, so the session
zone is pinned. Intermediate tables that must cut lineage (snapshot history,
incremental targets, stream sinks) go below ``spark.checkpoint.dir``: on a
cluster that setting names a shared folder; we only invent one when it is unset
and the master is local (tests, bench).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Required for correct results: all date parts, date keys and ISO texts are UTC.
CORRECTNESS_CONF = {"spark.sql.session.timeZone": "UTC"}
# Parquet timestamps as 64-bit integers: their footers hold least and greatest values, by which loads find
# their high-water mark and scans skip files. The older 96-bit encoding has none.
STORAGE_CONF = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}
# Half the bytes of a key of hex digits, which the default codec stores as they are.
TABLE_COMPRESSION = "zstd"

# Shuffles of a written warehouse: the input bytes for which one starts with one more partition, the most it starts
# with, and the bytes up to which AQE puts small partitions together. 16 MB are 800,000 packed digests, about 250 MB
# in an aggregation; the default of 64 MB spilled.
INPUT_PER_PARTITION = 8 << 20
MOST_PARTITIONS = 4000
SHUFFLED_PER_TASK = 16 << 20
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

# Performance settings of sessions we create. Shuffle partition count is left to the caller:
# a cluster sizes it to the data (about 128-256 MB per partition after AQE
# coalescing), local runs use the core count.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(master: str | None = None, cores: int | None = None, app: str = "starloom") -> SparkSession:
    """Create (or reuse) a session with the warehouse settings applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if cores:
        builder = builder.config("spark.sql.shuffle.partitions", str(cores))
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STARLOOM_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in {**SESSION_CONF, **CORRECTNESS_CONF, **STORAGE_CONF}.items():
        spark.conf.set(k, v)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply what correctness and file statistics need to a session someone else created.

    Performance settings (AQE, skew join, compression) stay the caller's:
    they are on by default in Spark 4 and the writers pass their own options. ``size_shuffles`` alone sets two of AQE.
    """
    for k, v in {**CORRECTNESS_CONF, **STORAGE_CONF}.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def _bytes(size: str) -> int:
    """A size setting as Spark reads it: digits and a unit (none: bytes)."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Let a task sort or group as much on large input as on small, so that none spills.

    Shuffles start with partitions enough for ``input_bytes``, never fewer than the caller's; AQE puts small ones
    together up to SHUFFLED_PER_TASK, or the caller's size if that is less.
    """
    held = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(-(-input_bytes // INPUT_PER_PARTITION), MOST_PARTITIONS)
    if wanted > held:
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))
    if _bytes(spark.conf.get(ADVISORY_SIZE)) > SHUFFLED_PER_TASK:
        spark.conf.set(ADVISORY_SIZE, f"{SHUFFLED_PER_TASK}b")


def app_key(spark: SparkSession) -> str:
    """Identity of the running application (for per-application caches)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect client: no SparkContext
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def _is_local(spark: SparkSession) -> bool:
    try:
        master = spark.sparkContext.master
    except Exception:
        master = spark.conf.get("spark.master", "")
    return master.startswith("local")


def _checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:
        return None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for materialised intermediates.

    Read from ``spark.checkpoint.dir``; set a private one only when it is unset
    and the session is local.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or _checkpoint_dir(spark)
    if not conf_dir:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="starloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
    except Exception:  # Spark Connect client: DataFrame.checkpoint uses the conf
        pass
    return conf_dir.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path below the scratch root (never reused, never cleared)."""
    return "/".join([scratch_root(spark), *parts, uuid.uuid4().hex])
