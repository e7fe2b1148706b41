"""Session helpers: building a session, reading test tables, and cutting lineage through shared storage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_folders: list[str] = []


def build(cores: int | str = "*", app: str = "curamill", **conf: str) -> SparkSession:
    """A local session with the settings the engine expects; on a cluster use spark-submit's own settings instead."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8" if cores == "*" else str(cores),
        "spark.driver.memory": "8g",
    } | conf
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if it is read in so few parts that three in four would idle, as a file of a single row
    group is, which can't be split. Any larger input keeps its parts and is not shuffled."""
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    return df.repartition(cores) if parts * 4 <= cores else df


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach. It is what ``spark.checkpoint.dir`` names. Where that is unset, a temporary
    folder of this process is used if the session is a local one; on a cluster the setting is required."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if not _own_folders:
        _own_folders.append(tempfile.mkdtemp(prefix="curamill-"))
        atexit.register(lambda: [shutil.rmtree(f, ignore_errors=True) for f in _own_folders])
    return _own_folders[0]


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/curamill-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, for what has to be written and read again."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back. Cuts the lineage like a checkpoint and survives the loss
    of executors, but is columnar, compressed and keeps column pruning for the readers."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete all that this application has settled; what was made of it can't be read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
