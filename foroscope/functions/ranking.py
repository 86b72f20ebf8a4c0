"""Ranking inside groups that may be arbitrarily large."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_key(df: DataFrame, keys: list[str], order: list, n: int, rank: str | None = None) -> DataFrame:
    """First ``n`` rows of each key in the given order.

    ``row_number() <= n`` is planned with a group limit before the shuffle (for n up to 1000), so a hot
    key sends at most ``n`` rows per input partition.
    """
    col = rank or "__rank"
    out = df.withColumn(col, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    out = out.filter(F.col(col) <= n)
    return out if rank else out.drop(col)


def range_bucket(df: DataFrame, col: str, buckets: int = 16384) -> Column:
    """Monotone bucket number of a numeric or time column.

    Equal widths between the 0.1 % and 99.9 % quantiles, so that a few absurd values (epoch-zero dates)
    cannot squeeze all other rows into one bucket; values outside go to the end buckets.
    """
    kind = dict(df.dtypes)[col]
    if kind.startswith("timestamp"):
        value = F.unix_micros(F.col(col).cast("timestamp"))
    elif kind == "date":
        value = F.unix_date(col)
    else:
        value = F.col(col)
    ends = df.select(value.alias("v")).agg(F.percentile_approx("v", [0.001, 0.999], 10000).alias("q"))
    lo, hi = (ends.select(F.col("q")[i]).scalar() for i in (0, 1))
    place = F.floor((value - lo) / (hi - lo + F.lit(1)) * buckets)
    return F.least(F.greatest(place, F.lit(-1)), F.lit(buckets))


def hash_bucket(order_text: Column) -> Column:
    """First two hex digits of a hash text: 256 even, ordered buckets."""
    return F.substring(order_text, 1, 2)


def prefix_totals(df: DataFrame, keys: list[str], order: list, bucket: Column, value: Column,
                  before: str, total: str | None = None) -> DataFrame:
    """Running sum of ``value`` over the rows before each row of its group, in two levels.

    Totals per (group, bucket) are pre-aggregated and summed in bucket order; the sort only ever sees one
    bucket of one group, so a group holding a third of all rows is still spread over many tasks.
    """
    base = df.withColumn("__b", bucket).withColumn("__v", value)
    parts = base.groupBy(*keys, "__b").agg(F.sum("__v").alias("__s"))
    by_group = Window.partitionBy(*keys)
    ahead = by_group.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *keys, "__b",
        F.coalesce(F.sum("__s").over(ahead), F.lit(0)).alias("__off"),
        F.sum("__s").over(by_group).alias("__all"),
    )
    inside = Window.partitionBy(*keys, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = base.withColumn("__in", F.coalesce(F.sum("__v").over(inside), F.lit(0)))
    out = out.join(parts, [*keys, "__b"]).withColumn(before, F.col("__off") + F.col("__in"))
    if total:
        out = out.withColumn(total, F.col("__all"))
    return out.drop("__b", "__v", "__in", "__off", "__all")


def rank_in_groups(df: DataFrame, keys: list[str], order: list, bucket: Column,
                   rank: str = "rank0", size: str = "group_size") -> DataFrame:
    """Zero-based position and size of each row's group, see :func:`prefix_totals`."""
    return prefix_totals(df, keys, order, bucket, F.lit(1), rank, size)
