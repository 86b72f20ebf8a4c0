"""Joins between posts, threads, sections and people."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def posts_by_section(posts: DataFrame, threads: DataFrame, sections: DataFrame) -> DataFrame:
    """Posts per section name along post -> thread -> section; unmapped posts keep a NULL name.

    Posts are counted per thread before the joins, so a hot thread travels as one row.
    """
    per_thread = posts.groupBy("forum", "threadid").agg(F.count("*").alias("posts"))
    return (per_thread.join(threads, ["forum", "threadid"], "left").join(sections, "sectionid", "left")
            .groupBy("section").agg(F.sum("posts").alias("posts"), F.count("*").alias("threads")))


def at_least(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Keys with k rows or more."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") >= k)


def active_rows(df: DataFrame, key: str, k: int) -> DataFrame:
    """Rows whose key has at least k rows (pre-aggregated counts and a semi join, no window)."""
    return df.join(at_least(df, [key], k), key, "left_semi")


def orphans(posts: DataFrame, threads: DataFrame, key: str) -> DataFrame:
    """Posts whose thread does not exist."""
    return posts.join(threads.select(key), key, "left_anti")


def name_both(edges: DataFrame, people: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """Giver and receiver names from one dimension joined twice; unknown ids keep NULL."""
    giver = people.select(F.col(id_col).alias("giver"), F.col(name_col).alias("giver_name"))
    receiver = people.select(F.col(id_col).alias("receiver"), F.col(name_col).alias("receiver_name"))
    return edges.join(giver, "giver", "left").join(receiver, "receiver", "left")


def with_counts(base: DataFrame, key: str, counts: dict[str, DataFrame]) -> DataFrame:
    """Base table with the row count of each other table per key; missing counts are 0."""
    out = base
    for name, df in counts.items():
        out = out.join(df.groupBy(key).agg(F.count("*").alias(name)), key, "left")
    return out.fillna(0, list(counts))


def pair_contact(pairs: DataFrame, messages: DataFrame) -> DataFrame:
    """Candidate pairs with a flag for any direct message in either direction."""
    def undirected(a, b):
        return F.least(a, b), F.greatest(a, b)

    lo, hi = undirected("user_a", "user_b")
    mlo, mhi = undirected("src", "dst")
    known = messages.select(mlo.alias("lo"), mhi.alias("hi")).distinct().withColumn("hit", F.lit(True))
    return (pairs.withColumns({"lo": lo, "hi": hi}).join(known, ["lo", "hi"], "left")
            .withColumn("contact", F.coalesce("hit", F.lit(False))).drop("lo", "hi", "hit"))
