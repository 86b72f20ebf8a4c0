"""Reading, combining and extending data sets of several sources."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foroscope.session import scratch_path


def merge_sources(frames: dict[str, DataFrame]) -> DataFrame:
    """Union of the same table of all sources, with a ``source`` column; missing columns become NULL."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def read_sources(spark: SparkSession, root: str, names: list[str] | None = None) -> DataFrame:
    """All (or the named) Parquet files of a folder, ids prefixed by the file stem."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if names:
        reader = reader.option("pathGlobFilter", "{" + ",".join(f"{n}.parquet" for n in names) + "}")
    df = reader.parquet(root)
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)\.[^.]*$", 1)
    df = df.withColumn("forum", stem)
    for key in ("userid", "threadid", "postid"):
        if key in df.columns:
            df = df.withColumn(key, F.concat_ws("_", "forum", key))
    return df


def extend_missing(existing: DataFrame, incoming: DataFrame, source: str) -> DataFrame:
    """Existing rows plus the rows of sources that are not there yet."""
    known = existing.select(source).distinct()
    return existing.unionByName(incoming.join(known, source, "left_anti"))


def pending(items: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Items whose key has no finished result."""
    return items.join(done.select(key), key, "left_anti")


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def materialize_once(spark: SparkSession, path: str, build) -> DataFrame:
    """Read the Parquet table at ``path``, building and writing it first when it is not complete."""
    if not path.endswith(".parquet"):
        raise ValueError("only .parquet tables are cached")
    if not path_exists(spark, f"{path}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_report(df: DataFrame, path: str, fmt: str) -> None:
    """Report sink: ``csv`` with header, ``json`` lines, or ``parquet`` partitioned by forum if present."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    elif fmt == "json":
        writer.json(path)
    elif fmt == "parquet":
        (writer.partitionBy("forum") if "forum" in df.columns else writer).parquet(path)
    else:
        raise ValueError(f"unknown format {fmt}")


def profile_rows(df: DataFrame, key: str, payload: str, value_schema: str) -> DataFrame:
    """JSON object ``{name: struct}`` to one row per name."""
    parsed = F.from_json(payload, f"map<string, struct<{value_schema}>>")
    return df.select(key, F.explode(parsed).alias("name", "profile")).select(key, "name", "profile.*")


__all__ = ["extend_missing", "materialize_once", "merge_sources", "path_exists", "pending",
           "profile_rows", "read_sources", "scratch_path", "write_report"]
