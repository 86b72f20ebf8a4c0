"""Canonical tables expressed over the test tables (stand-ins for real exports)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


FEW_SPLITS = 16


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash a table read from too few splits over the cores before CPU-heavy text work.

    Only tables of fewer than ``FEW_SPLITS`` splits move, whatever the number of cores, so large inputs never shuffle.
    """
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, FEW_SPLITS)
    return df.repartition(wanted, key) if df.rdd.getNumPartitions() < wanted else df


def participation(spark, sf_dir) -> DataFrame:
    """Dense participation: actor = supplier, thread = order, forum = return flag."""
    return (table(spark, sf_dir, "lineitem", "l_returnflag", "l_suppkey", "l_orderkey")
            .selectExpr("l_returnflag as forum", "cast(l_suppkey as string) as userid",
                        "cast(l_orderkey as string) as threadid"))


def messages(spark, sf_dir) -> DataFrame:
    """Directed messages: sender = customer, receiver = supplier; duration and time from the line."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity",
                  "l_shipdate", "l_returnflag")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(
        "concat('C', o_custkey) as src", "concat('S', l_suppkey) as dst", "l_quantity as duration_s",
        "l_shipdate as dateline", "l_returnflag = 'A' as positive")


def posts(spark, sf_dir) -> DataFrame:
    """Timestamped posts without text."""
    return table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "ts", "props").selectExpr(
        "event_id as postid", "user_id as userid", "event_type as forum", "ts as dateline",
        "cast(get_json_object(props, '$.k') as int) as section")


def text_posts(spark, sf_dir) -> DataFrame:
    """Posts with text: actor = source, forum = language."""
    return spread(table(spark, sf_dir, "documents", "doc_id", "source", "lang", "text").selectExpr(
        "doc_id as postid", "source as userid", "lang as forum", "text as pagetext"), "postid")


def chat(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id as channel", "turn", "role as username", "text as message")


def handles(spark, sf_dir) -> DataFrame:
    a = table(spark, sf_dir, "customer", "c_custkey", "c_name").selectExpr(
        "'A' as forum", "c_custkey as userid", "split_part(c_name, '#', 2) as username")
    b = table(spark, sf_dir, "supplier", "s_suppkey", "s_name").selectExpr(
        "'B' as forum", "s_suppkey as userid", "split_part(s_name, '#', 2) as username")
    return a.unionByName(b)


def vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").cast("string").alias("actor"),
        (F.col("label") % 4).cast("string").alias("grp"), F.col("embedding").alias("vec"))


# The same stand-ins for the reference SQL.
SQL = {
    "participation": "select l_returnflag as forum, cast(l_suppkey as varchar) as userid, "
                     "cast(l_orderkey as varchar) as threadid from lineitem",
    "messages": "select concat('C', o_custkey) as src, concat('S', l_suppkey) as dst, l_quantity as duration_s, "
                "l_shipdate as dateline, l_returnflag = 'A' as positive from lineitem join orders "
                "on l_orderkey = o_orderkey",
    "posts": "select event_id as postid, user_id as userid, event_type as forum, ts as dateline, "
             "cast(json_extract_string(props, '$.k') as int) as section from events",
    "text_posts": "select doc_id as postid, source as userid, lang as forum, text as pagetext from documents",
    "chat": "select conv_id as channel, turn, role as username, text as message from conversations",
    "handles": "select 'A' as forum, c_custkey as userid, split_part(c_name, '#', 2) as username from customer "
               "union all select 'B', s_suppkey, split_part(s_name, '#', 2) from supplier",
    "vectors": "select vec_id, cast(label as varchar) as actor, cast(label % 4 as varchar) as grp, "
               "embedding as vec from embeddings",
}


def cte(*names: str) -> str:
    return "with " + ", ".join(f"{n} as ({SQL[n]})" for n in names)
