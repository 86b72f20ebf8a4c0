"""Activity counts over a stream of posts."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def hourly_counts(posts: DataFrame, time: str, keys: list[str], late: str = "2 days") -> DataFrame:
    """Posts per hour and key; works on a stream and on a table. Rows later than ``late`` behind the newest seen row
    are left out of a stream, so its state stays bounded."""
    counted = posts.withWatermark(time, late).groupBy(F.window(time, "1 hour").alias("w"), *keys).agg(
        F.count("*").alias("posts"))
    return counted.select(F.col("w.start").alias("hour"), *keys, "posts")


def start_hourly(posts: DataFrame, time: str, keys: list[str], path: str, checkpoint: str, late: str = "2 days",
                 **trigger) -> StreamingQuery:
    """Run :func:`hourly_counts` from ``checkpoint`` and write what each batch changed below ``path``.

    A batch has a folder of its own that it overwrites, so a batch that runs again after a failure counts once."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (hourly_counts(posts, time, keys, late).writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def read_hourly(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest count of each hour and key among all batches."""
    rows = spark.read.parquet(path)
    newest = Window.partitionBy("hour", *keys).orderBy(F.desc("batch"))
    return rows.withColumn("r", F.row_number().over(newest)).filter("r = 1").select("hour", *keys, "posts")
