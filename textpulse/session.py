"""Session helpers: a local session for tests and benches, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def local_session(cores: str = "*", app: str = "textpulse", **conf: str) -> SparkSession:
    """A single-machine session for tests and benches. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent a folder is made for a local session only: on a
    cluster a machine-local folder would be lost with its machine, so that is an
    error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="textpulse-")
    return _LOCAL_DIRS[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """The table written to the shared folder as Parquet and read back.

    Lineage ends there, like after a checkpoint, but columns can be pruned, filters reach the
    file and so does a partition column.
    """
    path = new_folder(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ready_workers(spark: SparkSession) -> None:
    """Let Python workers that share the driver's files import this package from where it is.

    A cluster has the package installed or sent along by ``--py-files``.
    """
    root = str(Path(__file__).resolve().parent.parent)
    settings = spark.sparkContext.environment
    known = [p for p in settings.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        settings["PYTHONPATH"] = os.pathsep.join([root, *known])


def ready_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable, keeping a folder the cluster has set."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(spark))
