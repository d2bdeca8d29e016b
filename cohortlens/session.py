"""Spark session settings for the library.

Settings already present on the session (e.g. given by the cluster) are never overridden; the
defaults below only fill gaps, as in tests and local runs.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (measured) broadcast of small join sides; the size check is AQE's.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
}


def configure(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Fill unset settings with the library defaults."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, local runs) without one gets a scratch folder; on a cluster a
    machine-local folder would be lost with its executor, so an unset value is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder on shared storage")
        d = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:  # no SparkContext on this client; the setting alone names the folder
        pass
    return d


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cohortlens",
                  memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", memory)
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
