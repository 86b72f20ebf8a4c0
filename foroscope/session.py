"""Session settings and the shared folder for written stages."""

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def ship_by_value(module: str) -> None:
    """Send a module's functions to the executors by value, which need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def build_session(master: str | None = None, app: str = "foroscope", **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # small shuffles keep one partition per core; large ones are not affected
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``, else its warehouse folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named or spark.conf.get("spark.sql.warehouse.dir")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/foroscope/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage like a checkpoint, survives lost executors, and gives the optimizer the real size of
    the table, so joins against it are broadcast only when it is in fact small.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


def drop_stage(staged: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    spark = staged.sparkSession
    old = spark._jvm.org.apache.hadoop.fs.Path(staged.stage_path)
    old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def restage(df: DataFrame, name: str, previous: DataFrame) -> DataFrame:
    """Stage the next state of a loop and delete the table it replaces, so disk use stays level."""
    out = stage(df, name)
    drop_stage(previous)
    return out
