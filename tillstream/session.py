"""Session settings the results depend on, and the shared folder for written state."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Results depend on these, but for the last. Sizing (shuffle partitions, memory, split size) belongs to the cluster.
REQUIRED_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # A JSON object may repeat a key; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # HotSpot leaves methods beyond this size uncompiled; wider stages are split instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Open windows may have more keys than a heap holds.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Can only be set when the session is made.
STARTUP_SETTINGS = {
    # Recording the Python call site of every column operation makes large plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to a session someone else made."""
    for key, value in REQUIRED_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "tillstream", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Build a session; `master` stays unset on a cluster, where spark-submit gives it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED_SETTINGS, **STARTUP_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, else one below the warehouse.

    The session's settings stay as they are.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh subfolder path of the shared folder for one run."""
    return f"{shared_dir(spark)}/tillstream/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the job's own, on whatever file system it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
