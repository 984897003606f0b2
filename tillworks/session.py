"""Session and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "tillworks", **conf: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, gets a
    temporary folder when the setting is missing; a cluster without it is an
    error, since executors could not read each other's local disks.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tillworks-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return (named or sc.getCheckpointDir()).rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """df written once to the shared folder, lineage cut; survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
