"""Session settings, lineage cuts and shared scratch space."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "larkspur", **conf: str) -> SparkSession:
    """A session with this toolkit's defaults; on a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local session may go without; it gets a folder of its own, says so, and
    removes it when the program ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        configured = tempfile.mkdtemp(prefix="larkspur-")
        warnings.warn(f"spark.checkpoint.dir is not set: intermediate tables go to {configured}", stacklevel=2)
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage.

    Used where a plan reads an intermediate table more than once and the
    readings must agree even when an executor is lost in between (row
    positions, sketch brackets, boosting weights).
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for one written table."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a table below the shared folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
