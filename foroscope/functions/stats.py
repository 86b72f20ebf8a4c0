"""Exact quantiles, z-scores and rank statistics as DataFrame expressions."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foroscope.functions.ranking import prefix_totals, range_bucket


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                    accuracy: int = 10000) -> DataFrame:
    """Linear-interpolated quantiles per group: columns ``keys, prob, quantile``.

    An approximate sketch brackets every wanted rank first; only the distinct values inside a bracket are
    sorted, the rest is counted. The bracket is four times the sketch error wide, and groups of at most
    ``accuracy`` rows are sorted whole. No task holds a large group.
    """
    rows = df.filter(F.col(value).isNotNull())
    counts = rows.groupBy(*keys, F.col(value).cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    eps = 4.0 / accuracy
    lo = [max(p - eps, 0.0) for p in probs]
    hi = [min(p + eps, 1.0) for p in probs]
    v = F.col(value).cast("double")
    marks = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.min(v).alias("__min"), F.max(v).alias("__max"),
        F.percentile_approx(v, lo, accuracy).alias("__lo"),
        F.percentile_approx(v, hi, accuracy).alias("__hi"),
    )
    marks = marks.select(
        *keys, "__n", "__min", "__max",
        F.explode(F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("p"),
                               F.col("__lo").alias("lo"), F.col("__hi").alias("hi"))).alias("__m"),
    ).select(
        *keys, "__n", F.col("__m.p").alias("prob"),
        F.when((F.col("__m.p") <= eps) | (F.col("__n") <= accuracy), F.col("__min"))
        .otherwise(F.col("__m.lo")).alias("__lo"),
        F.when((F.col("__m.p") >= 1 - eps) | (F.col("__n") <= accuracy), F.col("__max"))
        .otherwise(F.col("__m.hi")).alias("__hi"),
    )
    if keys:
        joined = counts.join(marks, keys)
    else:
        every = marks.agg(F.collect_list(F.struct("__n", "prob", "__lo", "__hi"))).scalar()
        joined = counts.select("*", F.explode(every).alias("__m")).select("__v", "__c", "__m.*")
    near = joined.filter(F.col("__v") <= F.col("__hi")).withColumn(
        "__x", F.when(F.col("__v") >= F.col("__lo"), F.col("__v")))
    # values below the bracket collapse into one NULL row per group by partial aggregation
    near = near.groupBy(*keys, "prob", "__n", "__x").agg(F.sum("__c").alias("__c"))
    run = Window.partitionBy(*keys, "prob").orderBy(F.col("__x").asc_nulls_first())
    near = near.withColumn("__cum", F.sum("__c").over(run.rowsBetween(Window.unboundedPreceding, 0)))
    pos = F.col("prob") * (F.col("__n") - 1)
    picked = near.groupBy(*keys, "prob", "__n").agg(
        F.min(F.when(F.col("__cum") > F.floor(pos), F.col("__x"))).alias("__a"),
        F.min(F.when(F.col("__cum") > F.ceil(pos), F.col("__x"))).alias("__b"),
    )
    frac = pos - F.floor(pos)
    return picked.select(
        *keys, "prob", (F.col("__a") + (F.col("__b") - F.col("__a")) * frac).alias("quantile"))


def quantile_columns(quantiles: DataFrame, keys: list[str], names: dict[float, str]) -> DataFrame:
    """One column per probability."""
    return quantiles.groupBy(*keys).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in names.items()])


def series_z(col: str, sample: bool = False) -> Column:
    """z-score of a short aggregated series (one row per period), NULL when it is constant."""
    w = Window.partitionBy()
    sd = F.stddev_samp(col) if sample else F.stddev_pop(col)
    return (F.col(col) - F.avg(col).over(w)) / F.nullif(sd.over(w), F.lit(0.0))


def average_rank(df: DataFrame, value: str, rank: str) -> DataFrame:
    """Rank where ties share their mean; ranks are built on value counts, summed over ordered buckets of values."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("__c"))
    run = prefix_totals(counts, [], [value], range_bucket(counts, value), F.col("__c"), "__ahead")
    ranks = run.select(value, (F.col("__ahead") + (F.col("__c") + 1) / 2).alias(rank))
    return df.join(ranks, value)


def min_max(df: DataFrame, col: str) -> Column:
    """Scale to 0..1 over the table; 0 when constant."""
    lo = df.agg(F.min(col).alias("v")).scalar()
    hi = df.agg(F.max(col).alias("v")).scalar()
    return F.when(hi == lo, F.lit(0.0)).otherwise((F.col(col) - lo) / (hi - lo))
