"""Session settings and the few helpers every operator shares."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "foliate", cpus: str | int = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the pins the operators rely on (UTC, AQE, Arrow).

    Under spark-submit, or with ``spark__master`` given, the cluster's own master,
    memory and number of shuffle partitions are kept; else it is a local session
    of ``cpus`` threads and ``partitions`` shuffle partitions.
    """
    b = SparkSession.builder.appName(app)
    if "PYSPARK_GATEWAY_PORT" not in os.environ and "spark__master" not in conf:
        b = b.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(partitions)).config("spark.driver.memory", os.environ.get("FOLIATE_DRIVER_MEMORY", "8g"))
    b = (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df``, its rows dealt to all cores if a scan gives less than half of them work (a small table in one file).

    Large scans have more splits than cores and are returned as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 < cores else df


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir; a temporary one only in a local session without it."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="foliate-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame, name: str, compression: str = "zstd") -> str:
    """The path of ``df`` written once to the shared folder; it is deleted when the session ends.

    Readers of one plan share it, and a lost executor costs no second pass.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    drop_at_end(spark, path)
    return path


def drop_at_end(spark: SparkSession, path: str) -> None:
    """Has a folder deleted when the session's JVM ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the cluster's shared folder.

    The folder is spark.checkpoint.dir of the session; only where that is unset
    (tests, a laptop) a temporary one is made.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
