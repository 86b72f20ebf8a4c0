"""Samples and time series."""

from pyspark.sql import functions as F

from foroscope import model
from foroscope.model import cte, table
from foroscope.operators import activity as ac
from foroscope.operators import sample as sp
from foroscope.operators import edges as ed
from foroscope.plans.registry import query
from foroscope.session import scratch_path
from foroscope.streaming import activity as st

# ---- samples


@query("topn_longest", f"""
{cte('text_posts')} select userid, postid, cast(length(pagetext) as int) as chars from text_posts
qualify row_number() over (partition by userid order by length(pagetext) desc, postid) <= 50""")
def topn_longest(spark, sf):
    return sp.longest_per_actor(model.text_posts(spark, sf), 50).select("userid", "postid", "chars")


@query("topn_actors", f"""
{cte('posts')}, c as (select forum, userid, count(*) as posts from posts group by 1, 2)
select forum, userid, posts, cast(row_number() over (partition by forum order by posts desc, userid) as int) as rank
from c qualify rank <= 25""")
def topn_actors(spark, sf):
    return sp.top_actors_per_source(model.posts(spark, sf).select("forum", "userid"), 25)


@query("first_of_top_actors", f"""
{cte('posts')}, best as (select userid from posts group by 1 order by count(*) desc, userid limit 25)
select userid, postid, cast(row_number() over (partition by userid order by postid) as int) as rank from posts
where userid in (select userid from best) qualify rank <= 20""")
def first_of_top_actors(spark, sf):
    return sp.first_of_top_actors(model.posts(spark, sf).select("userid", "postid"), 25, 20)


@query("even_time_sample", f"""
{cte('posts')}, r as (select userid, postid, row_number() over (partition by userid order by dateline, postid) - 1 as rk,
  count(*) over (partition by userid) as size from posts),
wanted as (select distinct u.userid, cast(floor(i * size / 20.0) as bigint) as rk
  from (select distinct userid, size from r) u, range(20) t(i))
select userid, postid from r where size <= 20 or (userid, rk) in (select userid, rk from wanted)""")
def even_time_sample(spark, sf):
    return sp.even_time_sample(model.posts(spark, sf).select("userid", "postid", "dateline"), 20).select(
        "userid", "postid")


@query("quota_sample", f"""
{cte('posts')} select section, postid from posts
qualify row_number() over (partition by section order by md5(postid || '-42'), postid) <= 15""")
def quota_sample(spark, sf):
    return sp.quota_sample(model.posts(spark, sf).select("section", "postid"), "section", "postid", 15)


@query("stratified_sample", f"""
{cte('posts')}, r as (select forum, postid, md5(postid || '-42') as h,
    row_number() over (partition by forum order by md5(postid || '-42'), postid) - 1 as rk,
    count(*) over (partition by forum) as size, count(*) over () as total from posts)
select forum, postid from r where rk < greatest(floor(500 * size / total::double), 1)
order by size desc, forum, h, postid limit 500""")
def stratified_sample(spark, sf):
    return sp.stratified_sample(model.posts(spark, sf).select("forum", "postid"), "forum", "postid", 500)


@query("hash_sample", f"""
{cte('posts')} select postid, userid from posts order by md5(postid || '-42'), postid limit 200""")
def hash_sample(spark, sf):
    return sp.hash_sample(model.posts(spark, sf).select("postid", "userid"), "postid", 200)


@query("thread_sample", f"""
{cte('participation')}, m as (select threadid, count(distinct userid) as members from participation group by 1
  having count(distinct userid) >= 2)
select threadid, members from m order by md5(threadid || '-42'), threadid limit 5000""")
def thread_sample(spark, sf):
    return sp.thread_sample(model.participation(spark, sf), 5000)


# ---- series


@query("monthly_activity", """
select o_orderpriority as forum, cast(date_trunc('month', o_orderdate) as date) as period, count(*) as posts
from orders group by 1, 2""", days=("period",))
def monthly_activity(spark, sf):
    posts = table(spark, sf, "orders", "o_orderpriority", "o_orderdate").withColumnRenamed("o_orderpriority", "forum")
    return ac.period_counts(posts, "o_orderdate", "month", ("forum",))


@query("quarterly_peak", """
with q as (select o_orderpriority as forum, cast(date_trunc('quarter', o_orderdate) as date) as period, count(*) as posts
  from orders group by 1, 2)
select forum, period as peak_period, posts as peak_posts from q
qualify row_number() over (partition by forum order by posts desc, period) = 1""", days=("peak_period",))
def quarterly_peak(spark, sf):
    posts = table(spark, sf, "orders", "o_orderpriority", "o_orderdate").withColumnRenamed("o_orderpriority", "forum")
    quarters = ac.period_counts(posts, "o_orderdate", "quarter", ("forum",))
    best = F.max(F.struct("posts", (-F.unix_date("period")).alias("d")))
    return quarters.groupBy("forum").agg(best.alias("m")).select(
        "forum", F.date_from_unix_date(-F.col("m.d")).alias("peak_period"), F.col("m.posts").alias("peak_posts"))


FILLED = """
with c as (select cast(date_trunc('{unit}', ts) as date) as period, count(*) as posts from ({src}) group by 1),
e as (select cast(unnest(generate_series(min(period)::timestamp, max(period)::timestamp, interval 1 {unit})) as date)
  as period from c)
select period, coalesce(posts, 0) as posts from e left join c using (period)"""
SPARSE = "select ts from events where event_type = 'error' union all select l_shipdate from lineitem"


@query("daily_filled", FILLED.format(unit="day", src=SPARSE), days=("period",))
def daily_filled(spark, sf):
    return ac.filled_counts(sparse_times(spark, sf), "ts", "day")


@query("weekly_filled", FILLED.format(unit="week", src=SPARSE), days=("period",))
def weekly_filled(spark, sf):
    return ac.filled_counts(sparse_times(spark, sf), "ts", "week")


def sparse_times(spark, sf):
    """Two sources years apart, so that many periods between them are empty."""
    errors = table(spark, sf, "events", "ts", "event_type").filter("event_type = 'error'").select("ts")
    return errors.unionAll(table(spark, sf, "lineitem", "l_shipdate").withColumnRenamed("l_shipdate", "ts"))


SPIKES = """
with c as (select cast(date_trunc('week', o_orderdate) as date) as period, count(*) as posts from orders group by 1),
z as (select *, round((posts - avg(posts) over ()) / nullif({sd}(posts) over (), 0), 6) as z from c)
select period, posts, z, coalesce(z > 2, false) as spike from z"""


@query("activity_spikes", SPIKES.format(sd="stddev_pop"), days=("period",))
def activity_spikes(spark, sf):
    return ac.spikes(table(spark, sf, "orders", "o_orderdate"), "o_orderdate")


@query("activity_spikes_sample", SPIKES.format(sd="stddev_samp"), days=("period",))
def activity_spikes_sample(spark, sf):
    return ac.spikes(table(spark, sf, "orders", "o_orderdate"), "o_orderdate", sample=True)


DATED = """dated as (select doc_id, text as pagetext,
  make_timestamp(cast(1325376000 + doc_id * 43200 as bigint) * 1000000) as dateline from documents)"""


def dated_texts(spark, sf):
    return model.spread(table(spark, sf, "documents", "doc_id", "text"), "doc_id").selectExpr(
        "doc_id", "text as pagetext", "timestamp_seconds(1325376000 + doc_id * 43200) as dateline")


@query("activation_weekly", f"""
with {DATED}, w as (select cast(date_trunc('week', dateline) as date) as week, count(*) as posts,
  avg(length(pagetext)) as mean_len,
  avg(length(regexp_replace(pagetext, '[^\\p{{Lu}}]', '', 'g')) / greatest(length(pagetext), 1)::double) as caps,
  avg((length(pagetext) - length(replace(pagetext, '!', ''))) / greatest(length(pagetext), 1)::double) as excl
  from dated group by 1)
select week, posts, round(mean_len, 4) as mean_len, round(caps, 6) as caps, round(excl, 6) as excl,
  round(""" + " + ".join(f"coalesce(({c} - avg({c}) over ()) / nullif(stddev_samp({c}) over (), 0), 0)"
                          for c in ("posts", "mean_len", "caps", "excl")) + ", 4) as activation from w", days=("week",))
def activation_weekly(spark, sf):
    return ac.activation(dated_texts(spark, sf))


EVENT_ROWS = [("first", "1996-05-06"), ("second", "1997-11-10"), ("third", "1999-08-02")]


@query("event_overlay", """
with c as (select cast(date_trunc('week', o_orderdate) as date) as period, count(*) as posts from orders group by 1),
e as (select * from (values """ + ", ".join(f"('{a}', date '{d}')" for a, d in EVENT_ROWS) + """) t(label, period))
select period, posts, label from c left join e using (period)""", days=("period",))
def event_overlay(spark, sf):
    weeks = ac.period_counts(table(spark, sf, "orders", "o_orderdate"), "o_orderdate", "week")
    events = spark.createDataFrame(EVENT_ROWS, "label string, day string").select(
        "label", F.col("day").cast("date").alias("period"))
    return ac.event_overlay(weeks, events)


WORDS = [("launch", "2012-01-16", "the"), ("launch", "2012-01-16", "le"), ("outage", "2012-02-20", "and"),
         ("outage", "2012-02-20", "zzz")]


@query("word_rate_event", f"""
with {DATED}, p as (select cast(date_trunc('week', dateline) as date) as pw,
    regexp_extract_all(lower(pagetext), '[\\p{{L}}\\p{{N}}_]+') as tokens from dated),
e as (select * from (values """ + ", ".join(f"('{a}', date '{d}', '{w}')" for a, d, w in WORDS) + """)
  t(label, week, word)),
h as (select label, word, pw = week as inside, len(list_filter(tokens, lambda x: x = word)) as hits from p, e),
r as (select label, word, coalesce(sum(hits) filter (where inside) / nullif(count(*) filter (where inside), 0)::double, 0) as s,
  coalesce(sum(hits) filter (where not inside) / nullif(count(*) filter (where not inside), 0)::double, 0) as b from h group by 1, 2)
select label, word, round(b, 6) as base_rate, round(s, 6) as event_rate,
  case when b > 0 then round(s / b, 6) else 'inf'::double end as ratio from r""")
def word_rate_event(spark, sf):
    events = spark.createDataFrame(WORDS, "label string, week string, word string").withColumn(
        "week", F.col("week").cast("date"))
    return ac.word_rate_event(dated_texts(spark, sf), events)


@query("hourly_activity", f"""
{cte('posts')} select forum, cast(hour(dateline) as int) as hour, count(*) as posts from posts group by 1, 2""")
def hourly_activity(spark, sf):
    return model.posts(spark, sf).groupBy("forum", F.hour("dateline").alias("hour")).agg(F.count("*").alias("posts"))


TZ_POSTS = """tzp as (select user_id as userid, hour(ts) as hr from events),
n as (select userid, count(*) as post_count from tzp group by 1),
sc as (select userid, o, count(*) filter (where (hr + o + 24) % 24 between 8 and 23) as score
  from tzp, (select unnest(range(-12, 13)) as o) group by 1, 2),
best as (select userid, o from sc qualify row_number() over (partition by userid order by score desc, o) = 1),
prof as (select userid, post_count, case when post_count >= 5 then cast(o as int) end as utc_offset
  from n join best using (userid))"""


@query("utc_offset", f"with {TZ_POSTS} select * from prof")
def utc_offset(spark, sf):
    return ac.hour_counts(model.posts(spark, sf)).select(
        "userid", "post_count", ac.utc_offset("hours", "post_count").alias("utc_offset"))


REGION_SQL = "case utc_offset " + " ".join(f"when {k} then '{v}'" for k, v in ac.REGIONS.items()) + " end"


@query("tz_profile", f"""
with {TZ_POSTS}, hrs as (select userid, string_agg(cast(coalesce(c, 0) as varchar), ',' order by h) as activity_hours
  from (select userid, h from n, range(24) t(h)) left join (select userid, hr as h, count(*) as c from tzp group by 1, 2)
    using (userid, h) group by 1)
select userid, post_count, utc_offset, {REGION_SQL} as region, activity_hours,
  cast(userid % 25 - 12 as int) as declared_offset, userid % 25 - 12 <> utc_offset as mismatch
from prof join hrs using (userid)""")
def tz_profile(spark, sf):
    posts = model.posts(spark, sf)
    declared = table(spark, sf, "customer", "c_custkey").selectExpr(
        "c_custkey as userid", "cast(c_custkey % 25 - 12 as int) as declared_offset")
    return ac.tz_profile(posts, declared)


@query("peak_hours", f"""
with {TZ_POSTS}, cc as (select n.userid, t.h, count(hr) as k from n cross join range(24) t(h)
  left join tzp on tzp.userid = n.userid and tzp.hr = t.h group by 1, 2),
r as (select userid, h, row_number() over (partition by userid order by k desc, h) as rk from cc)
select userid, string_agg(cast(h as varchar), ',' order by rk) as peak_hours from r where rk <= 3 group by 1""")
def peak_hours(spark, sf):
    return ac.peak_hours(model.posts(spark, sf)).withColumn(
        "peak_hours", F.array_join(F.col("peak_hours").cast("array<string>"), ","))


@query("hour_similarity", f"""
with {TZ_POSTS}, m as (select distinct event_type, json_extract_string(props, '$.k') as section, cast(user_id as varchar) as u
  from events where json_extract_string(props, '$.k') is not null),
q as (select a.u as user_a, b.u as user_b from m a join m b on a.event_type = b.event_type and a.section = b.section
  and a.u < b.u group by 1, 2 having count(*) >= 2),
c as (select cast(userid as varchar) as u, hr, count(*) as k from tzp group by 1, 2),
nn as (select u, sqrt(sum(k * k)) as norm from c group by 1),
d as (select user_a, user_b, sum(a.k * b.k) as dot from q join c a on a.u = user_a join c b on b.u = user_b and a.hr = b.hr
  group by 1, 2)
select q.user_a, q.user_b, round(coalesce(dot, 0) / (x.norm * y.norm), 6) as similarity,
  round(coalesce(dot, 0) / (x.norm * y.norm), 6) >= 0.9 as match
from q left join d using (user_a, user_b) join nn x on x.u = q.user_a join nn y on y.u = q.user_b""")
def hour_similarity(spark, sf):
    """Candidate pairs: users who met in two sections or more."""
    posts = model.posts(spark, sf).withColumn("userid", F.col("userid").cast("string"))
    # a section of a forum is one thread of a single forum, so that a pair is one row
    met = ed.copart_edges(posts.withColumns({"threadid": F.concat("forum", F.lit(":"), F.col("section").cast("string")),
                                             "forum": F.lit("all")}))
    pairs = ed.strong_edges(ed.across_forums(met))
    return ac.hour_similarity(posts, pairs)


@query("hourly_stream", """
select date_trunc('hour', ts) as hour, event_type as forum, count(*) as posts from events group by 1, 2""", days=("hour",))
def hourly_stream(spark, sf):
    """Posts per hour and section as a stream over the files of events, read back when it has caught up.

    A stream reads folders or patterns; the pattern names the one table."""
    schema = table(spark, sf, "events").schema
    posts = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(f"{sf}/event[s].parquet").selectExpr(
        "cast(ts as timestamp) as ts", "event_type as forum")
    path = scratch_path(spark, "hourly")
    st.start_hourly(posts, "ts", ["forum"], f"{path}/counts", f"{path}/checkpoint",
                    late="400 days").awaitTermination()
    return st.read_hourly(spark, f"{path}/counts", ["forum"])
