"""Session helpers: local sessions for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings the library relies on: AQE for runtime re-planning (partition
# coalescing, skew-join splitting, broadcast conversion from real sizes) and UTC
# so dates derived from timestamps do not depend on the machine's zone.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Opt-in settings for a large cluster (hundreds of TB, ~1000 executors).  Shuffle
# partitions are set high and AQE coalesces them to ~256 MB each from measured
# sizes; scans split files into 256 MB pieces; skewed join partitions (5x the
# median and > 512 MB) are split at runtime.
SCALE_CONF = {
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def apply_scale_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Apply :data:`SCALE_CONF` (plus ``overrides``) to a running session."""
    for key, value in {**SCALE_CONF, **(overrides or {})}.items():
        spark.conf.set(key, value)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """Local session for tests and the benchmark (single JVM)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Turn on AQE and its skew-join splitting, which the plans rely on at scale.

    Nothing else in the caller's session is changed: the observation date comes
    from a zone-less timestamp, so results do not depend on the session zone.
    """
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(key, "true")


def work_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables and checkpoints.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (shared
    storage visible to every executor).  Only when the session names none (tests,
    local runs) a private temporary folder is created and registered.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    if not sc.getCheckpointDir():
        # Named in the session conf after the context started (or a test folder):
        # register it so DataFrame.checkpoint() writes there too.
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")
