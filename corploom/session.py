"""Session helpers shared by tests, the bench and the operators."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application: they may start in any folder of any machine."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="corploom-package-")
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "corploom"), "zip", root, "corploom"))


def local_session(cpus: int = 4, shuffle: int = 8, memory: str = "6g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("corploom")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    ship(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the session names; only where none is set (tests), make a local one."""
    if spark.sparkContext.getCheckpointDir():
        return
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="corploom-checkpoint-")
    spark.sparkContext.setCheckpointDir(where)


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder: survives the loss of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows by the hash of a key over all cores, if the frame has fewer partitions than there are cores; else as they are.

    For costly steps over a file of few row groups. A table of more splits than cores is never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a scale directory."""
    ship(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
