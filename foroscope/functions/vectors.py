"""Vector expressions and pair tables over populations that the caller names."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def unit(a) -> Column:
    """L2-normalised vector; the zero vector stays as it is."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x.cast("double") / n)).otherwise(
        F.transform(a, lambda x: x.cast("double")))


def cosine(a, b) -> Column:
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n).otherwise(F.lit(0.0))


def pairs_of(df: DataFrame, key: str, blocks: int = 16) -> DataFrame:
    """All unordered pairs of a population as structs ``a`` and ``b`` with a.key < b.key.

    Rows are hashed to blocks and joined on the block pair, so the work is an even equi-join over
    blocks * (blocks + 1) / 2 tasks. The pairs grow with the square of the population, which the caller chooses.
    """
    cols = F.struct(*df.columns)
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")
    left = df.select(cols.alias("l"), block.alias("i")).select("l", "i", F.explode(
        F.sequence("i", F.lit(blocks - 1))).alias("j"))
    right = df.select(cols.alias("r"), block.alias("j")).select("r", "j", F.explode(
        F.sequence(F.lit(0), "j")).alias("i"))
    lk, rk = F.col(f"l.{key}"), F.col(f"r.{key}")
    joined = left.join(right, ["i", "j"]).filter((lk != rk) & ((F.col("i") < F.col("j")) | (lk < rk)))
    swap = lk < rk
    return joined.select(F.when(swap, F.col("l")).otherwise(F.col("r")).alias("a"),
                         F.when(swap, F.col("r")).otherwise(F.col("l")).alias("b"))
