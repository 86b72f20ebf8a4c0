"""Joins, reports, aggregations and set operations."""

from pyspark.sql import functions as F

from foroscope import model
from foroscope.functions.stats import exact_quantiles
from foroscope.model import cte, table
from foroscope.operators import joins as jn
from foroscope.operators import report as rp
from foroscope.plans.clean import RAW_POSTS, raw_posts
from foroscope.plans.registry import query
from foroscope.session import stage
from foroscope.operators.clean import clean_posts
from foroscope.operators.identity import exact_handles

# ---- joins


@query("posts_by_section", """
select n_name as section, count(*) as posts, count(distinct (l_returnflag, l_orderkey)) as threads
from lineitem left join (select o_orderkey, o_custkey % 30 as sectionid from orders where o_orderstatus <> 'P')
  on l_orderkey = o_orderkey left join nation on sectionid = n_nationkey group by 1""")
def posts_by_section(spark, sf):
    threads = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus").filter("o_orderstatus <> 'P'")
    flags = F.explode(F.array(*[F.lit(x) for x in "ANR"]))
    threads = threads.select(F.col("o_orderkey").cast("string").alias("threadid"),
                             (F.col("o_custkey") % 30).alias("sectionid"), flags.alias("forum"))
    sections = table(spark, sf, "nation").selectExpr("n_nationkey as sectionid", "n_name as section")
    return jn.posts_by_section(model.participation(spark, sf), threads, sections)


@query("active_users", f"""
{cte('posts')} select postid, userid, forum from posts
where userid in (select userid from posts group by 1 having count(*) >= 66)""")
def active_users(spark, sf):
    return jn.active_rows(model.posts(spark, sf).select("postid", "userid", "forum"), "userid", 66)


@query("orphan_posts", """
select l_orderkey as threadid, l_linenumber as seq, l_partkey as postid from lineitem
where l_orderkey not in (select o_orderkey from orders where o_orderstatus <> 'P')""")
def orphan_posts(spark, sf):
    posts = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey").selectExpr(
        "l_orderkey as threadid", "l_linenumber as seq", "l_partkey as postid")
    threads = table(spark, sf, "orders", "o_orderkey", "o_orderstatus").filter("o_orderstatus <> 'P'")
    return jn.orphans(posts, threads.selectExpr("o_orderkey as threadid"), "threadid")


@query("reputation_named", """
select a.c_name as giver_name, b.c_name as receiver_name, l_returnflag as code, count(*) as votes
from lineitem join orders on l_orderkey = o_orderkey left join customer a on a.c_custkey = o_custkey
left join customer b on b.c_custkey = l_suppkey group by 1, 2, 3""")
def reputation_named(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_suppkey", "l_returnflag")
    votes = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        F.col("o_custkey").alias("giver"), F.col("l_suppkey").alias("receiver"), F.col("l_returnflag").alias("code")
    ).agg(F.count("*").alias("votes"))
    named = jn.name_both(votes, table(spark, sf, "customer", "c_custkey", "c_name"), "c_custkey", "c_name")
    return named.select("giver_name", "receiver_name", "code", "votes")


@query("case_enriched", """
select o_orderkey as id, c_mktsegment as variant, n_name as operator from orders
left join (select * from customer where c_mktsegment <> 'MACHINERY') on o_custkey = c_custkey
left join nation on c_nationkey = n_nationkey""")
def case_enriched(spark, sf):
    cases = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    builds = table(spark, sf, "customer", "c_custkey", "c_mktsegment", "c_nationkey").filter("c_mktsegment <> 'MACHINERY'")
    operators = table(spark, sf, "nation", "n_nationkey", "n_name")
    return (cases.join(builds, F.col("o_custkey") == F.col("c_custkey"), "left")
            .join(operators, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .selectExpr("o_orderkey as id", "c_mktsegment as variant", "n_name as operator"))


@query("operator_stats", """
select c_custkey as userid, coalesce(b, 0) as n_builds, coalesce(v, 0) as n_cases, coalesce(m, 0) as n_messages
from customer left join (select o_custkey, count(*) b from orders group by 1) x on x.o_custkey = c_custkey
left join (select o_custkey, count(*) v from orders where o_orderstatus = 'F' group by 1) y on y.o_custkey = c_custkey
left join (select user_id, count(*) m from events group by 1) z on z.user_id = c_custkey""")
def operator_stats(spark, sf):
    base = table(spark, sf, "customer", "c_custkey").withColumnRenamed("c_custkey", "userid")
    orders = table(spark, sf, "orders", "o_custkey", "o_orderstatus").withColumnRenamed("o_custkey", "userid")
    return jn.with_counts(base, "userid", {
        "n_builds": orders, "n_cases": orders.filter("o_orderstatus = 'F'"),
        "n_messages": model.posts(spark, sf).select("userid")})


@query("pair_contact", f"""
{cte('messages')}, links as (select distinct least(src, dst) as a, greatest(src, dst) as b from messages)
select 'C' || s_suppkey as user_a, 'S' || s_suppkey as user_b, links.a is not null as contact from supplier
left join links on links.a = 'C' || s_suppkey and links.b = 'S' || s_suppkey""")
def pair_contact(spark, sf):
    pairs = table(spark, sf, "supplier", "s_suppkey").selectExpr(
        "concat('C', s_suppkey) as user_a", "concat('S', s_suppkey) as user_b")
    return jn.pair_contact(pairs, model.messages(spark, sf))


# ---- reports


@query("source_summary", """
with u as (select c_nationkey as forum, count(*) as users from customer group by 1),
p as (select c_nationkey as forum, count(*) as posts, min(o_orderdate) as first_post, max(o_orderdate) as last_post
      from orders join customer on o_custkey = c_custkey group by 1)
select forum, coalesce(users, 0) as users, coalesce(posts, 0) as posts, first_post, last_post,
  round(coalesce(posts, 0) / greatest(coalesce(users, 0), 1)::double, 1) as posts_per_user from u full join p using (forum)""")
def source_summary(spark, sf):
    users = table(spark, sf, "customer", "c_custkey", "c_nationkey").selectExpr("c_custkey", "c_nationkey as forum")
    posts = table(spark, sf, "orders", "o_custkey", "o_orderdate").selectExpr(
        "o_custkey as c_custkey", "o_orderdate as dateline").join(users, "c_custkey")
    return rp.source_summary(users, posts)


FILL = ["text", "lang", "source", "n_chars"]


@query("fill_rate", "with d as (select text, case when doc_id % 7 = 0 then null else lang end as lang, "
       "case when doc_id % 5 = 0 then '  ' else source end as source, n_chars from documents) " + " union all ".join(
           f"select '{c}' as column_name, round(100 * avg(case when length(regexp_replace(cast({c} as varchar), "
           f"'^\\s+|\\s+$', '', 'g')) > 0 then 1.0::double else 0 end), 2) as fill_pct from d" for c in FILL))
def fill_rate(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text", "lang", "source", "n_chars").selectExpr(
        "text", "case when doc_id % 7 = 0 then null else lang end as lang",
        "case when doc_id % 5 = 0 then '  ' else source end as source", "n_chars")
    return rp.fill_rate(docs, FILL)


@query("quality_report", f"""
with {RAW_POSTS}, t as (select *, regexp_replace(pagetext, '^\\s+|\\s+$', '', 'g') as s from raw_posts)
select forum, count(*) as posts, count(*) filter (where year(dateline) < 2000) as epoch_zero,
  count(*) filter (where dateline is null) as null_date, count(*) filter (where s = '') as blank,
  count(*) filter (where s <> '' and length(s) < 5) as very_short,
  count(*) filter (where seq not in (select doc_id from labels)) as orphans from t group by 1""")
def quality_report(spark, sf):
    labels = table(spark, sf, "labels", "doc_id").withColumnRenamed("doc_id", "seq")
    return rp.quality_report(raw_posts(spark, sf), labels, "seq")


@query("retention_report", f"""
with {RAW_POSTS}, filled as (
  select * from raw_posts where length(regexp_replace(pagetext, '^\\s+|\\s+$', '', 'g')) > 0),
firsts as (select * from filled qualify row_number() over (partition by postid, forum order by seq) = 1),
r as (select forum, count(*) as raw_rows from raw_posts group by 1),
c as (select forum, count(*) as n from firsts where year(dateline) >= 2000 and length(pagetext) >= 10 group by 1)
select forum, raw_rows, coalesce(n, 0) as clean_rows, raw_rows - coalesce(n, 0) as removed,
  round(100 * coalesce(n, 0) / raw_rows::double, 2) as retained_pct from r left join c using (forum)""")
def retention_report(spark, sf):
    raw = raw_posts(spark, sf)
    return rp.retention_report(raw, clean_posts(raw, ["postid", "forum"], ["seq"]))


@query("count_check", """
with a as (select event_type, count(*) as n from events group by 1),
e as (select event_type, cast(floor(count(distinct user_id) * 13.2) as bigint) as expected from events group by 1)
select event_type, n as rows, expected, round(100 * n / expected::double, 2) as pct,
  n / expected::double between 0.85 and 1.15 as ok from a join e using (event_type)""")
def count_check(spark, sf):
    events = table(spark, sf, "events", "event_type", "user_id")
    actual = events.groupBy("event_type").agg(F.count("*").alias("rows"))
    expected = events.groupBy("event_type").agg(
        F.floor(F.count_distinct("user_id") * F.lit(13.2)).alias("expected"))
    return rp.count_check(actual, expected, "event_type")


@query("concentration", """
with a as (select o_custkey, count(*) as c from orders group by 1),
r as (select *, row_number() over (order by c desc, o_custkey) as rk, count(*) over () as n from a),
s as (select o_orderpriority, o_orderstatus, count(*) as c from orders group by 1, 2 order by c desc limit 5)
select count(*) as actors, cast(sum(c) as bigint) as posts,
  round(100 * sum(c) filter (where rk <= greatest(floor(n * 0.1), 1)) / sum(c)::double, 4) as top10_pct,
  count(*) filter (where c >= 5) as actors_5plus,
  round(100 * (select sum(c) from s)::double / sum(c)::double, 4) as top5_sections_pct from r""")
def concentration(spark, sf):
    posts = table(spark, sf, "orders", "o_custkey", "o_orderpriority", "o_orderstatus").select(
        "o_custkey", F.concat("o_orderpriority", "o_orderstatus").alias("section"))
    return rp.concentration(posts, "o_custkey", "section")


@query("rank_size", """
with a as (select o_custkey, count(*) as c from orders group by 1),
r as (select c, row_number() over (order by c desc, o_custkey) as rk, count(*) over () as n from a),
g as (select c as posts, count(*) as actors, min(rk) as first_rank, max(rk) as last_rank, max(n) as n from r group by 1)
select posts, actors, first_rank, last_rank, round(log10(first_rank::double), 6) as log_rank,
  round(log10(posts::double), 6) as log_posts, first_rank <= greatest(floor(n * 0.01), 1) as top_1pct from g""")
def rank_size(spark, sf):
    return rp.rank_size(table(spark, sf, "orders", "o_custkey"), "o_custkey")


@query("dominant_label", f"""
{cte('text_posts')}, c as (select userid, forum, count(*) as n from text_posts group by 1, 2)
select userid, forum, n, cast(total as bigint) as total, round(n / total::double, 6) as share from (
  select *, sum(n) over (partition by userid) as total,
    row_number() over (partition by userid order by n desc, forum) as rk from c) where rk = 1""")
def dominant_label(spark, sf):
    return rp.dominant_label(model.text_posts(spark, sf).select("userid", "forum"), "userid", "forum")


@query("label_share", f"""
{cte('posts')}, c as (select userid, forum, count(*) as n from posts group by 1, 2)
select userid, forum, n, round(n / sum(n) over (partition by userid)::double, 6) as share,
  row_number() over (partition by userid order by n desc, forum) = 1 as dominant from c""")
def label_share(spark, sf):
    return rp.label_share(model.posts(spark, sf).select("userid", "forum"), "userid", "forum")


@query("label_leaders", f"""
{cte('posts')} select userid, count(*) as n from posts where forum = 'purchase' group by 1
order by n desc, userid limit 10""")
def label_leaders(spark, sf):
    return rp.label_leaders(model.posts(spark, sf).select("userid", "forum"), "userid", "forum", "purchase", 10)


@query("crosstab", """
select o_orderpriority, count(*) filter (where o_orderstatus = 'F') as "F",
  count(*) filter (where o_orderstatus = 'O') as "O", count(*) filter (where o_orderstatus = 'P') as "P"
from orders group by 1""")
def crosstab(spark, sf):
    return rp.crosstab(table(spark, sf, "orders", "o_orderpriority", "o_orderstatus"), "o_orderpriority",
                       "o_orderstatus", ["F", "O", "P"])


@query("section_stats", """
select cast(json_extract_string(props, '$.k') as int) as section, count(*) as posts, count(distinct user_id) as actors,
  round(sum(value), 2) as total, round(round(sum(value), 2) / count(*), 4) as mean from events group by 1""")
def section_stats(spark, sf):
    events = table(spark, sf, "events", "user_id", "value", "props").selectExpr(
        "cast(get_json_object(props, '$.k') as int) as section", "user_id", "value")
    return rp.section_stats(events, "section", "user_id", "value")


@query("funnel", """
with c as (select count(*) as total, count(*) filter (where o_orderkey in (select l_orderkey from lineitem)) as act,
  count(*) filter (where o_orderstatus = 'F') as paid, count(*) filter (where o_orderpriority = '1-URGENT') as done
  from orders)
select 0 as step, 'total' as stage, total as cases, 100.0::double as pct from c
union all select 1, 'with_activity', act, round(100 * act / total::double, 1) from c
union all select 2, 'paid', paid, round(100 * paid / total::double, 1) from c
union all select 3, 'done', done, round(100 * done / total::double, 1) from c""")
def funnel(spark, sf):
    cases = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority").selectExpr(
        "o_orderkey as id", "o_orderstatus = 'F' as paid", "o_orderpriority = '1-URGENT' as done")
    activity = table(spark, sf, "lineitem", "l_orderkey").withColumnRenamed("l_orderkey", "id")
    return rp.funnel(cases, activity, "id")


@query("lifetime_days", """
select o_orderkey as id, round((epoch(max(l_shipdate)) - epoch(max(o_orderdate))) / 86400.0::double, 6) as days
from orders join lineitem on l_orderkey = o_orderkey group by 1""")
def lifetime_days(spark, sf):
    last = table(spark, sf, "lineitem", "l_orderkey", "l_shipdate").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.max("l_shipdate").alias("last_ts"))
    cases = table(spark, sf, "orders", "o_orderkey", "o_orderdate").selectExpr(
        "o_orderkey as id", "o_orderdate as first_ts").join(last, "id", "left")
    return rp.lifetime_days(cases, "first_ts", "last_ts").select("id", "days")


CONVERSATIONS = """conv as (
  select l_orderkey as channel, count(*) as messages, min(l_shipdate) as first, max(l_shipdate) as last,
    count(distinct l_returnflag) as phases,
    round((epoch(max(l_shipdate)) - epoch(min(l_shipdate))) / 3600.0::double, 6) as hours
  from lineitem group by 1)"""


def conversations(spark, sf):
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_shipdate", "l_returnflag").withColumnRenamed(
        "l_orderkey", "channel")
    return rp.conversation_stats(lines, "channel", "l_shipdate", "l_returnflag")


@query("conversation_stats", f"with {CONVERSATIONS} select * from conv")
def conversation_stats(spark, sf):
    return conversations(spark, sf)


@query("conversation_medians", f"""with {CONVERSATIONS}
select o_orderstatus = 'F' as paid, quantile_cont(hours, 0.5) as median_hours from conv
join orders on channel = o_orderkey group by 1""")
def conversation_medians(spark, sf):
    paid = table(spark, sf, "orders", "o_orderkey", "o_orderstatus").selectExpr(
        "o_orderkey as channel", "o_orderstatus = 'F' as paid")
    hours = stage(conversations(spark, sf).select("channel", "hours").join(paid, "channel"), "hours")
    return exact_quantiles(hours, ["paid"], "hours", [0.5]).select("paid", F.col("quantile").alias("median_hours"))


DESCRIBE = """count({v}) as count, round(avg({v}), 4) as mean, round(stddev_samp({v}), 4) as std,
  min({v})::double as min, max({v})::double as max, round(quantile_cont({v}, 0.25), 4) as q25,
  round(quantile_cont({v}, 0.5), 4) as q50, round(quantile_cont({v}, 0.75), 4) as q75"""


@query("describe_group", f"""select o_orderstatus, {DESCRIBE.format(v='o_totalprice')} from orders group by 1""")
def describe_group(spark, sf):
    return rp.describe_group(table(spark, sf, "orders", "o_orderstatus", "o_totalprice"), ["o_orderstatus"],
                             "o_totalprice")


@query("length_profile", f"""
with t as (select length(text)::double as n from documents) select {DESCRIBE.format(v='n')},
  round(avg((n < 5)::int), 6) as share_short, round(avg((n > 500)::int), 6) as share_long from t""")
def length_profile(spark, sf):
    return rp.length_profile(table(spark, sf, "documents", "text"), "text")


VOTES = """select {who}, count(*) filter (where positive) as pos, count(*) filter (where not positive) as neg,
  count(*) as total, count(*) filter (where positive) - count(*) filter (where not positive) as net
from messages group by 1"""


@query("net_reputation", cte("messages") + VOTES.format(who="dst"))
def net_reputation(spark, sf):
    return rp.net_votes(model.messages(spark, sf).select("dst", "positive"), "dst")


@query("giver_totals", cte("messages") + VOTES.format(who="src"))
def giver_totals(spark, sf):
    return rp.net_votes(model.messages(spark, sf).select("src", "positive"), "src")


@query("participation", f"""
{cte('participation')} select forum, forum || '_' || userid as userid, forum || '_' || threadid as threadid,
  count(*) as post_count from participation group by 1, 2, 3""")
def participation(spark, sf):
    return rp.participation(model.participation(spark, sf))


@query("actor_corpus", f"""
{cte('text_posts')}, kept as (
  select * from text_posts where length(regexp_replace(pagetext, '^\\s+|\\s+$', '', 'g')) > 0),
ok as (select userid from kept group by 1 having count(*) >= 5 and sum(length(pagetext)) >= 500),
r as (select *, row_number() over (partition by userid order by postid) - 1 as rk from kept
      where userid in (select userid from ok))
select userid, cast(rk // 50 as bigint) as part, count(*) as n_posts, string_agg(pagetext, ' ' order by postid) as corpus
from r group by 1, 2""")
def actor_corpus(spark, sf):
    return rp.actor_corpus(model.text_posts(spark, sf))


@query("activity_hist", """
with a as (select o_custkey, count(*) as c from orders group by 1)
select cast(least(floor(least(c, 500) * 50 / 500), 49) as bigint) as bin, count(*) as actors from a group by 1""")
def activity_hist(spark, sf):
    return rp.activity_hist(table(spark, sf, "orders", "o_custkey"), "o_custkey")


@query("sampling_cost", """
with a as (select l_suppkey, count(*) as c from lineitem group by 1)
select 'all' as strategy, cast(sum(c) as bigint) as rows from a union all
select 'top_50', cast(sum(least(c, 50)) as bigint) from a union all
select 'top_100', cast(sum(least(c, 100)) as bigint) from a union all
select 'top_150', cast(sum(least(c, 150)) as bigint) from a""")
def sampling_cost(spark, sf):
    return rp.sampling_cost(table(spark, sf, "lineitem", "l_suppkey"), "l_suppkey", [50, 100, 150])


@query("threads_per_actor", f"""
{cte('participation')}, a as (select userid, count(distinct threadid) as n from participation group by 1)
select count(*) as actors, max(n) as max_threads, quantile_cont(n, 0.5) as median_threads from a""")
def threads_per_actor(spark, sf):
    return rp.threads_per_actor(model.participation(spark, sf))


@query("top_actors", """
select o_custkey as userid, count(*) as posts, max(c_name) as username, max(c_mktsegment) as segment
from orders left join customer on o_custkey = c_custkey group by 1 order by posts desc, userid limit 20""")
def top_actors(spark, sf):
    people = table(spark, sf, "customer").selectExpr("c_custkey as userid", "c_name as username",
                                                     "c_mktsegment as segment")
    posts = table(spark, sf, "orders", "o_custkey").withColumnRenamed("o_custkey", "userid")
    return rp.top_actors(posts, "userid", people, 20)


@query("handle_exact", f"""
{cte('handles')} select username, array_to_string(list_sort(list(distinct forum)), ',') as forums,
  cast(count(distinct forum) as int) as n_forums from handles
where length(username) >= 4 group by 1 having count(distinct forum) >= 2""")
def handle_exact(spark, sf):
    return exact_handles(model.handles(spark, sf)).withColumn("forums", F.array_join("forums", ","))


@query("snapshot_transitions", """
with s as (select distinct year(o_orderdate) as yr, o_custkey as handle from orders),
y as (select distinct yr from s),
t as (select yr as a, lead(yr) over (order by yr) as b, 'consecutive' as kind from y
      union all select min(yr), max(yr), 'first_last' from y),
h as (select distinct handle from s)
select kind, cast(a as int) as from_year, cast(b as int) as to_year,
  count(*) filter (where x.handle is not null and z.handle is not null) as persist,
  count(*) filter (where x.handle is not null and z.handle is null) as vanish,
  count(*) filter (where x.handle is null and z.handle is not null) as appear
from t cross join h left join s x on x.yr = a and x.handle = h.handle
left join s z on z.yr = b and z.handle = h.handle where b is not null group by 1, 2, 3""")
def snapshot_transitions(spark, sf):
    snaps = table(spark, sf, "orders", "o_custkey", "o_orderdate").selectExpr("year(o_orderdate) as yr",
                                                                             "o_custkey as handle")
    return rp.snapshot_transitions(snaps, "yr", "handle")


@query("seed_actors", """
(select o_custkey as userid from orders group by 1 order by count(*) desc, 1 limit 10) union
(select o_custkey from orders group by 1 order by round(sum(o_totalprice), 2) desc, 1 limit 10) union
(select user_id from events group by 1 order by count(*) desc, 1 limit 10)""")
def seed_actors(spark, sf):
    orders = table(spark, sf, "orders", "o_custkey", "o_totalprice")
    per = orders.groupBy(F.col("o_custkey").alias("userid")).agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("v"))
    events = model.posts(spark, sf).groupBy("userid").agg(F.count("*").alias("n"))
    tops = [per.orderBy(F.desc("n"), "userid").limit(10), per.orderBy(F.desc("v"), "userid").limit(10),
            events.orderBy(F.desc("n"), "userid").limit(10)]
    return tops[0].select("userid").union(tops[1].select("userid")).union(tops[2].select("userid")).distinct()
