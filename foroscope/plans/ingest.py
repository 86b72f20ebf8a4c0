"""Ingest and source queries. Raw text is rendered from the test tables by Spark, then read back."""

from pyspark.sql import functions as F

from foroscope import model
from foroscope.model import table
from foroscope.plans.registry import query
from foroscope.session import scratch_path
from foroscope.sources import canonical as can
from foroscope.sources import combine, rawtext


def _sql_text(col):
    """Escape a text column as a quoted SQL literal; line breaks stay raw in half of the rows."""
    out = F.replace(F.replace(F.col(col), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    out = F.when(F.col("doc_id") % 2 == 0, F.replace(out, F.lit("\n"), F.lit("\\n"))).otherwise(out)
    return F.concat(F.lit("'"), out, F.lit("'"))


@query("ingest_sql_rows", """
select cast(doc_id as varchar) as postid, source as username,
       case when doc_id % 5 = 0 then text || ';' || chr(10) || 'it''s (a), b' else text end as pagetext,
       case when doc_id % 3 = 0 then null else cast(n_chars as varchar) end as visible
from documents""")
def ingest_sql_rows(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "source", "text", "n_chars").withColumn(
        "body", F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(";\nit's (a), b")))
        .otherwise(F.col("text")))
    chars = F.when(F.col("doc_id") % 3 == 0, F.lit("NULL")).otherwise(F.col("n_chars").cast("string"))
    listed = F.concat(F.lit("INSERT INTO `vb_post` (`visible`, `postid`, `pagetext`, `username`) VALUES\n("), chars,
                      F.lit(","), F.col("doc_id"), F.lit(",\t"), _sql_text("body"), F.lit(",'"), F.col("source"),
                      F.lit("');"))
    plain = F.concat(F.lit("INSERT INTO `vb_post` VALUES ("), F.col("doc_id"), F.lit(",'"), F.col("source"),
                     F.lit("',"), _sql_text("body"), F.lit(","), chars, F.lit(",'surplus');"))
    lines = docs.select(F.when(F.col("doc_id") % 4 == 0, listed).otherwise(plain).alias("value"))
    head = docs.limit(1).select(F.lit(
        "-- Dump\nCREATE TABLE `vb_post` (\n  `postid` int NOT NULL,\n  `username` text,\n  `pagetext` text,\n"
        "  `visible` int,\n  PRIMARY KEY (`postid`)\n);").alias("value"))
    path = scratch_path(spark, "sqldump")
    head.unionAll(lines).write.text(path)
    rows = rawtext.read_sql_dump(spark, path)
    return rawtext.dump_table(rows, "post", ["postid", "username", "pagetext", "visible"])


@query("ingest_delimited", """
select cast(c_custkey as varchar) as userid, c_name || ':"' || c_mktsegment || '"' as username,
       cast(c_nationkey as varchar) as posts from customer""")
def ingest_delimited(spark, sf):
    users = table(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey").select(
        F.col("c_custkey").alias("ID"), F.concat("c_name", F.lit(':"'), "c_mktsegment", F.lit('"')).alias("User"),
        F.col("c_nationkey").alias("PostNum"))
    path = scratch_path(spark, "delimited")
    odd = F.col("ID") % 2 == 1  # two files of one folder, with other columns and another delimiter
    users.filter(odd).write.option("sep", ":").option("header", "true").option("escape", '"').csv(path)
    users.filter(~odd).select("PostNum", F.lit("x").alias("Extra"), "User", "ID").write.mode("append").option(
        "sep", ";").option("header", "true").option("escape", '"').csv(path)
    raw = rawtext.read_delimited(spark, path)
    return raw.selectExpr("id as userid", "user as username", "postnum as posts")


def _chat_rows(spark, sf):
    return model.chat(spark, sf).withColumn(
        "ts", F.date_format(F.timestamp_seconds(F.lit(1600000000) + F.col("channel") * 3600 + F.col("turn")),
                            "yyyy-MM-dd'T'HH:mm:ss"))


CHAT_SQL = """
select make_timestamp(cast((1600000000 + conv_id * 3600 + turn) as bigint) * 1000000) as timestamp, role as username,
"""


@query("ingest_concat_json", CHAT_SQL + """
  case when turn % 3 = 0 then '' else 'bot' end as to_user,
  text || case when turn % 2 = 0 then ' } {"x' || chr(10) else '' end as message, 'chat' as source
from conversations""")
def ingest_concat_json(spark, sf):
    rows = _chat_rows(spark, sf).select(
        "channel", F.to_json(F.struct(
            "ts", F.concat("username", F.lit("@host.example")).alias("from"),
            F.when(F.col("turn") % 3 != 0, F.lit("bot@host.example")).alias("to"),
            F.when(F.col("turn") % 4 == 1, F.struct(F.struct(F.lit("}").alias("k")).alias("a"), F.lit(1).alias("b")))
            .alias("meta"),
            F.concat("message", F.when(F.col("turn") % 2 == 0, F.lit(' } {"x\n')).otherwise(F.lit("")))
            .alias("body"))).alias("value"))
    path = scratch_path(spark, "concatjson")
    rows.select("value").write.option("lineSep", " ").text(path)
    return rawtext.read_concatenated_json(spark, path, "chat").drop("channel")


@query("ingest_room_json", CHAT_SQL + """
  cast(conv_id as varchar) as to_user, text as message, 'rooms' as source from conversations where turn <> 3""")
def ingest_room_json(spark, sf):
    rows = _chat_rows(spark, sf)
    message = F.struct("ts", F.col("channel").cast("string").alias("rid"), F.col("message").alias("msg"),
                       F.when(F.col("turn") == 3, F.lit("uj")).alias("t"),
                       F.struct("username").alias("u"))
    files = rows.groupBy("channel", F.floor(F.col("turn") / 1000).alias("day")).agg(
        F.collect_list(message).alias("messages"))
    path = scratch_path(spark, "rooms")
    (files.select(F.to_json(F.struct("messages")).alias("value"))
     .write.option("maxRecordsPerFile", 1).text(path))
    return rawtext.read_room_json(spark, path, "rooms").drop("channel")


@query("ingest_kv_blocks", CHAT_SQL + """
  'room' || conv_id as channel,
  regexp_replace(replace(replace(text, '{', '('), '}', ')'), '^\\s+|\\s+$', '', 'g') as message, 'blocks' as source
from conversations where turn % 7 <> 6""")
def ingest_kv_blocks(spark, sf):
    rows = _chat_rows(spark, sf).select(F.concat(
        F.lit("{\n  timestamp: "), "ts", F.lit(",\n  chat_id: !room"), "channel", F.lit(":host.example,\n"),
        F.when(F.col("turn") % 7 != 6, F.concat(F.lit("  sender_alias: @"), "username", F.lit(":host.example,\n")))
        .otherwise(F.lit("")),
        F.lit("  message: "), F.translate("message", "{}", "()"), F.lit("\n}")).alias("value"))
    path = scratch_path(spark, "kv")
    rows.write.text(path)
    return rawtext.read_kv_blocks(spark, path, "blocks")


@query("canonical_user", """
select 'board' as forum, cast(c_custkey as varchar) as userid,
  case when c_custkey % 7 = 0 then c_name else upper(c_name) end as username,
  case when c_custkey % 5 = 0 then null
       else make_timestamp(cast(946684800 + c_custkey * 3600 as bigint) * 1000000) end as joindate,
  cast(c_nationkey as bigint) as posts from customer where c_nationkey <> 3""")
def canonical_user(spark, sf):
    raw = table(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey").selectExpr(
        "cast(c_custkey as string) member_id", "c_name as name",
        "case when c_custkey % 7 = 0 then null else upper(c_name) end as members_display_name",
        """case when c_custkey % 15 = 0 then '0' when c_custkey % 5 = 0 then 'abc'
           else cast(946684800 + c_custkey * 3600 as string) end as joined""",
        "cast(c_nationkey as string) as posts", "case when c_nationkey = 3 then '1' else '0' end as queued")
    named = raw.filter("cast(member_id as int) % 7 = 1").drop("name")  # an export with the display name only
    raw = raw.filter("cast(member_id as int) % 7 <> 1")
    return can.canonical(raw, "ips", "user", "board").unionByName(can.canonical(named, "ips", "user", "board")).select(
        "forum", "userid", "username", "joindate", "posts")


@query("canonical_section", """
select 'board' as forum, cast(n_nationkey as varchar) as forumid, n_name as name, count(distinct c_mktsegment) as topic_count,
  count(*) as post_count from nation join customer on c_nationkey = n_nationkey group by all""")
def canonical_section(spark, sf):
    members = table(spark, sf, "customer", "c_nationkey", "c_mktsegment")
    raw = table(spark, sf, "nation", "n_nationkey", "n_name").join(members, F.col("n_nationkey") == F.col("c_nationkey"))
    raw = raw.groupBy(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")).agg(
        F.count_distinct("c_mktsegment").cast("string").alias("topics"), F.count("*").cast("string").alias("posts"))
    return can.canonical(raw, "ips", "section", "board")


@query("post_sections", """
select n_name as section, count(*) as posts, count(distinct c_custkey) as authors
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1""")
def post_sections(spark, sf):
    """Posts with their own section id, named by the table of sections."""
    people = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    raw = orders.join(people, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "o_orderkey as pid", "o_custkey as uid", "c_nationkey as fid")
    sections = can.canonical(table(spark, sf, "nation").selectExpr("n_nationkey as id", "n_name as name"), "ips", "section",
                             "board")
    posts = can.canonical(raw, "mybb", "post", "board").join(sections.select("forumid", "name"), "forumid")
    return posts.groupBy(F.col("name").alias("section")).agg(F.count("*").alias("posts"),
                                                             F.count_distinct("userid").alias("authors"))


@query("pm_with_receiver", """
select 'board' as forum, cast(l_orderkey as varchar) as topic_id, cast(l_suppkey as varchar) as sender_id,
  cast(o_custkey as varchar) as receiver_id,
  case when l_shipdate >= timestamp '2000-01-01' then l_shipdate end as dateline, l_returnflag as text
from lineitem left join (select * from orders where o_orderstatus <> 'P') on l_orderkey = o_orderkey""")
def pm_with_receiver(spark, sf):
    posts = table(spark, sf, "lineitem", "l_orderkey", "l_suppkey", "l_shipdate", "l_returnflag").selectExpr(
        "l_orderkey as msg_topic_id", "l_suppkey as msg_author_id",
        "cast(unix_timestamp(l_shipdate) as string) as msg_date", "l_returnflag as msg_post")
    topics = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus").filter(
        "o_orderstatus <> 'P'").selectExpr("o_orderkey as mt_id", "o_custkey as mt_to_member_id")
    return can.with_receiver(can.canonical(posts, "ips", "private_message", "board"),
                             can.canonical(topics, "ips", "message_topic", "board"))


@query("merge_sources", """
select 'customer' as source, c_custkey as userid, c_name as username, c_mktsegment as segment from customer
union all select 'supplier', s_suppkey, s_name, null from supplier""")
def merge_sources(spark, sf):
    a = table(spark, sf, "customer").selectExpr("c_custkey userid", "c_name username", "c_mktsegment segment")
    b = table(spark, sf, "supplier").selectExpr("s_suppkey userid", "s_name username")
    return combine.merge_sources({"customer": a, "supplier": b})


@query("materialize_once", """
select user_id as userid, count(*) as posts from events group by 1""")
def materialize_once(spark, sf):
    path = scratch_path(spark, "once") + ".parquet"

    def build():
        return model.posts(spark, sf).groupBy("userid").agg(F.count("*").alias("posts"))

    combine.materialize_once(spark, path, build)
    return combine.materialize_once(spark, path, build)


@query("extend_missing", """
select lang as forum, doc_id as postid, n_chars from documents""")
def extend_missing(spark, sf):
    docs = table(spark, sf, "documents", "lang", "doc_id", "n_chars").selectExpr("lang forum", "doc_id postid", "n_chars")
    return combine.extend_missing(docs.filter("forum in ('en', 'fr')"), docs, "forum")


@query("resume_pending", """
select doc_id, source from documents where doc_id not in (select doc_id from labels)""")
def resume_pending(spark, sf):
    return combine.pending(table(spark, sf, "documents", "doc_id", "source"),
                           table(spark, sf, "labels", "doc_id"), "doc_id")


@query("profile_rows", """
select channel, username as name, count(*) as messages, cast(max(length(message)) as bigint) as longest
from (select conv_id as channel, role as username, text as message from conversations) group by 1, 2""")
def profile_rows(spark, sf):
    stats = model.chat(spark, sf).groupBy("channel", "username").agg(
        F.count("*").alias("messages"), F.max(F.length("message")).cast("bigint").alias("longest"))
    payload = stats.groupBy("channel").agg(F.to_json(F.map_from_entries(F.collect_list(
        F.struct("username", F.struct("messages", "longest"))))).alias("payload"))
    return combine.profile_rows(payload, "channel", "payload", "messages: bigint, longest: bigint")
