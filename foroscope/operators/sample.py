"""Sampling and top-n selection. Random order is the md5 of id and seed: repeatable on any cluster."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foroscope.functions.ranking import hash_bucket, range_bucket, rank_in_groups, top_n_per_key


def hash_order(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))


def longest_per_actor(posts: DataFrame, n: int) -> DataFrame:
    """The n longest texts of each actor, ties to the lower id."""
    sized = posts.withColumn("chars", F.length("pagetext"))
    return top_n_per_key(sized, ["userid"], [F.desc("chars"), "postid"], n)


def top_actors_per_source(posts: DataFrame, n: int) -> DataFrame:
    counts = posts.groupBy("forum", "userid").agg(F.count("*").alias("posts"))
    return top_n_per_key(counts, ["forum"], [F.desc("posts"), "userid"], n, rank="rank")


def first_of_top_actors(posts: DataFrame, actors: int, rows: int) -> DataFrame:
    """First rows, in id order, of the most active actors."""
    best = posts.groupBy("userid").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "userid").limit(actors)
    return top_n_per_key(posts.join(best, "userid", "left_semi"), ["userid"], ["postid"], rows, rank="rank")


def even_time_sample(posts: DataFrame, n: int) -> DataFrame:
    """Rows at positions floor(i * size / n) of each actor's time order; all rows when size <= n."""
    ranked = rank_in_groups(posts, ["userid"], ["dateline", "postid"], range_bucket(posts, "dateline"))
    r, size = F.col("rank0"), F.col("group_size")
    i = F.floor((r * n + size - 1) / size)
    hit = (i < n) & (F.floor(i * size / n) == r)
    return ranked.filter((size <= n) | hit)


def quota_sample(df: DataFrame, section: str, key: str, quota: int, seed: int = 42) -> DataFrame:
    """At most ``quota`` random rows per section."""
    return top_n_per_key(df.withColumn("__h", hash_order(key, seed)), [section], ["__h", key], quota).drop("__h")


def stratified_sample(df: DataFrame, section: str, key: str, size: int, seed: int = 42) -> DataFrame:
    """max(1, floor(size * share)) random rows per section, largest sections first, ``size`` rows in all."""
    hashed = df.withColumn("__h", hash_order(key, seed))
    ranked = rank_in_groups(hashed, [section], ["__h", key], hash_bucket(F.col("__h")))
    total = df.agg(F.count("*")).scalar()
    k = F.greatest(F.floor(size * F.col("group_size") / total), F.lit(1))
    return (ranked.filter(F.col("rank0") < k).orderBy(F.desc("group_size"), section, "__h", key).limit(size)
            .drop("__h", "rank0", "group_size"))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    return df.orderBy(hash_order(key, seed), key).limit(n)


def thread_sample(participation: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """At most n random threads with two or more distinct members."""
    members = participation.select("threadid", "userid").distinct().groupBy("threadid").agg(
        F.count("*").alias("members"))
    return hash_sample(members.filter("members >= 2"), "threadid", n, seed)
