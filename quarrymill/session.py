"""Session settings, the shared checkpoint folder and scratch folders."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the SQL options whose defaults would change results."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, app: str = "quarrymill") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)


def _one_machine(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset, a
    temporary folder stands in, but only while driver and executors are one
    process; on any other master each machine would write to a disk of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not _one_machine(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="quarrymill-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def cut_lineage(df):
    """Reliable checkpoint: survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


_SCRATCH: dict[str, str] = {}


def _clear_scratch() -> None:
    """Delete the scratch tables of this session, while it still runs."""
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    jvm = spark.sparkContext._jvm
    for made in _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(made)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _SCRATCH.clear()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for a table written and read back.

    It lasts as long as the session: all of them are deleted at its end.
    """
    if not _SCRATCH:
        atexit.register(_clear_scratch)
    made = f"{shared_dir(spark).rstrip('/')}/tables/{label}-{uuid.uuid4().hex}"
    _SCRATCH[made] = label
    return made


def written(df, label: str):
    """``df`` as a Parquet table in the shared folder, read back.

    It cuts the lineage like a checkpoint and brings file sizes, by which the
    planner decides on broadcasts.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
