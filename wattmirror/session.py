"""Session defaults every operator relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings the operators assume. All can be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str, app: str = "wattmirror", shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """A session for local runs; a cluster hands in its own and calls prepare()."""
    builder = SparkSession.builder.master(master).appName(app).config("spark.ui.enabled", "false") \
        .config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def work_dir(spark: SparkSession) -> str:
    """The shared folder for written tables and streaming checkpoints.

    A cluster names it in spark.checkpoint.dir. Only a local session without the
    setting (tests) gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and spark.sparkContext.getCheckpointDir() is not None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="wattmirror-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")
