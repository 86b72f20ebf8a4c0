"""Tables that grow by batches, each of which counts exactly once.

A batch is written to a folder of its own; only then a small commit file that names the folder is put in place by a rename.
Readers see the folders of committed batches. A run that dies before its commit leaves a folder that nobody reads; a batch
that is committed already is not written again.
"""

import json
import uuid
from hashlib import md5

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _files(spark: SparkSession, path: str):
    name = spark._jvm.org.apache.hadoop.fs.Path(path)
    return name, name.getFileSystem(spark._jsc.hadoopConfiguration())


def committed(spark: SparkSession, root: str) -> dict[str, str]:
    """Batch to data folder, from the commit files (one a batch)."""
    folder, fs = _files(spark, f"{root}/commits")
    if not fs.exists(folder):
        return {}
    try:
        rows = spark.read.schema("batch string, folder string").json(f"{root}/commits/*.json").collect()
    except AnalysisException:  # no commit yet
        return {}
    return {r["batch"]: r["folder"] for r in rows}


def commit(spark: SparkSession, root: str, batch: str, folder: str) -> None:
    """Put the commit file of a batch in place; of two runs of one batch the first wins."""
    place, fs = _files(spark, f"{root}/commits/{md5(batch.encode()).hexdigest()}.json")
    draft, _ = _files(spark, f"{root}/drafts/{uuid.uuid4().hex}")
    out = fs.create(draft)
    out.write(bytearray(json.dumps({"batch": batch, "folder": folder}).encode()))
    out.close()
    fs.mkdirs(place.getParent())
    if not fs.exists(place):
        fs.rename(draft, place)


def adopt(spark: SparkSession, root: str) -> None:
    """A finished plain Parquet table that stands at ``root`` already becomes its first batch."""
    done, fs = _files(spark, f"{root}/_SUCCESS")
    if fs.exists(done) and not committed(spark, root):
        commit(spark, root, "first", "*.parquet")


def write_batch(df: DataFrame, root: str, batch: str) -> bool:
    """Write and commit one batch unless it is there; whether it was written."""
    spark = df.sparkSession
    if batch in committed(spark, root):
        return False
    folder = f"data/{md5(batch.encode()).hexdigest()}-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{folder}")
    commit(spark, root, batch, folder)
    return True


def read_committed(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame | None:
    """Rows of all committed batches; without any an empty table of ``schema``, or None if that is not given."""
    folders = sorted(committed(spark, root).values())
    if not folders:
        return spark.createDataFrame([], schema) if schema is not None else None
    return spark.read.parquet(*[f"{root}/{f}" for f in folders])


def extend_table(spark: SparkSession, root: str, incoming: DataFrame, source: str) -> DataFrame:
    """The table with the rows of those sources that it does not hold yet, one batch for each new source.

    A run that is killed and repeated neither loses nor doubles a source. Sources are few: files, boards, exports."""
    known = set(committed(spark, root))
    for value in [r[0] for r in incoming.select(source).distinct().dropna().orderBy(source).collect()]:
        if f"{source}={value}" not in known:
            write_batch(incoming.filter(incoming[source] == value), root, f"{source}={value}")
    return read_committed(spark, root, incoming.schema)
