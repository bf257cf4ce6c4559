"""Session helpers: a local session for tests, shared scratch tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8) -> SparkSession:
    """A single-machine session with the settings that the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("readweave")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Where that is unset: a local one on a local master, else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    """A folder of this process, gone with it."""
    path = tempfile.mkdtemp(prefix="readweave-")
    atexit.register(shutil.rmtree, path, True)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors.

    The folder belongs to the cluster, which clears it; nothing is deleted here because the returned
    frame is lazy.
    """
    path = f"{scratch_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def partitions_for(spark: SparkSession, rows: int, each: int = 1 << 21) -> int:
    """Partitions of a shuffle of so many rows: the session's number, or more so that a task's share does not grow with the input."""
    return max(shuffle_partitions(spark), -(-rows // each))
