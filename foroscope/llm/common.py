"""Helpers shared by the training-data operators."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foroscope.session import ship_by_value

ship_by_value(__name__)

LAST_ID = 2**63 - 1
#: A-Z to a-z, every other byte unchanged.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class Memo:
    """A function that keeps its results in each Python process and is shipped without them."""

    def __init__(self, fn):
        self.fn, self.known = fn, {}

    def __call__(self, *args):
        if args not in self.known:
            self.known[args] = self.fn(*args)
        return self.known[args]

    def __reduce__(self):
        return Memo, (self.fn,)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def row_key(column: str) -> Column:
    """Id to group and join by: rows without an id count as one, behind all others."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def id_text(column: str) -> Column:
    """The id as it was given."""
    return F.when(F.col(column) != LAST_ID, F.col(column))


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 of a string column, null as empty."""
    return [b"" if x is None else x for x in batch.column(column).cast(pa.binary()).to_pylist()]


def to_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
                                      schema=schema)


def group_starts(columns: list[np.ndarray]) -> np.ndarray:
    """First row of each run of equal keys."""
    change = np.zeros(len(columns[0]), bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def whole_groups(batches, keys: list[str]):
    """From batches sorted by ``keys``: tables that hold complete groups, each with the starts of its groups."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        starts = group_starts([rest.column(k).to_numpy() for k in keys])
        if len(starts) > 1:
            yield rest.slice(0, starts[-1]), starts[:-1]
            rest = rest.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest, np.zeros(1, np.int64)


def block_pairs(df: DataFrame, key: str, salt: str, size: int, inside: bool) -> DataFrame:
    """Split large blocks so that no task has to compare one whole.

    A block of more than ``size`` rows is dealt into parts by a hash of ``salt``, and each row is sent to every
    pair of parts that has its own. Adds ``part`` (the row's own) and the pair ``lo``, ``hi``; rows of one
    (key, lo, hi) belong together and are at most about twice ``size``. With ``inside`` a part is also paired with
    itself; without it, the pairs of different parts contain that comparison already.
    """
    from foroscope.session import stage  # the table of large blocks has at most rows / size entries

    big = stage(df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > size)
                .select(key, F.ceil(F.col("n") / size).cast("int").alias("parts")), "blocks")
    rows = df.join(big, key, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(17), salt), "parts").cast("int"))
    other = F.sequence(F.lit(0), F.col("parts") - 1)
    if not inside:
        other = F.when(F.col("parts") > 1, F.array_remove(other, F.col("part"))).otherwise(other)
    rows = rows.withColumn("other", F.explode(other))
    return rows.withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other")).drop(
        "parts", "other")
