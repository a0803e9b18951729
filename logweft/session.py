"""Session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
STATE_VARIABLES_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "logweft", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings used by the tests and the bench."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        STATE_STORE: STATE_VARIABLES_STORE,
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_state_variables(spark: SparkSession) -> None:
    """Let streams that start from now on keep state variables, which the default state store can't.

    Streams that have a checkpoint go on with the store they began with.
    """
    if spark.conf.get(STATE_STORE).endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_STORE, STATE_VARIABLES_STORE)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster: ``spark.checkpoint.dir`` if it is set.

    Only where it is unset (tests, one machine) a folder of this process takes its place.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="logweft-"))
    return spark.sparkContext.getCheckpointDir()


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def remove_shared(spark: SparkSession, path: str) -> None:
    """Remove a path below the shared folder that nothing reads any more."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def cut_lineage(df):
    """Write ``df`` to the reliable checkpoint folder and go on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
