"""Cleaning queries."""

from pyspark.sql import functions as F

from foroscope import model
from foroscope.functions import text as tx
from foroscope.model import table
from foroscope.operators import clean as op
from foroscope.plans.registry import query

RAW_POSTS = """raw_posts as (
  select doc_id % 900 as postid, doc_id as seq, lang as forum, text as pagetext,
    make_timestamp(cast(case when doc_id % 11 = 0 then doc_id else 946684800 + doc_id * 86400 * 10 end as bigint)
      * 1000000) as dateline from documents)"""


def raw_posts(spark, sf):
    """Documents with repeated post ids and some dates at the epoch."""
    return table(spark, sf, "documents", "doc_id", "lang", "text").selectExpr(
        "doc_id % 900 as postid", "doc_id as seq", "lang as forum", "text as pagetext",
        """timestamp_seconds(case when doc_id % 11 = 0 then doc_id else 946684800 + doc_id * 86400 * 10 end)
           as dateline""")


@query("clean_users", """
select 'A' as forum, c_custkey as userid, ' ' || c_name || ' ' as username_raw, lower(c_name) as username,
  case when c_custkey % 9 = 0 then null else make_timestamp((946684800 + c_custkey) * 1000000) end as joindate,
  case when c_nationkey % 3 = 0 then null else lower(c_mktsegment) end as contact from customer""")
def clean_users(spark, sf):
    users = table(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey").selectExpr(
        "'A' as forum", "c_custkey as userid", "concat(' ', c_name, ' ') as username",
        "timestamp_seconds(case when c_custkey % 9 = 0 then c_custkey else 946684800 + c_custkey end) as joindate",
        "case when c_nationkey % 3 = 0 then '  ' else concat(' ', c_mktsegment, '\\n') end as contact")
    return op.clean_users(users)


@query("flag_posts", f"""
with {RAW_POSTS}
select seq, cast(dateline as date) between date '2000-01-01' and date '2025-12-31' as dateline_valid,
  length(regexp_replace(pagetext, '^\\s+|\\s+$', '', 'g')) >= 5 as text_valid from raw_posts""")
def flag_posts(spark, sf):
    return op.flag_posts(raw_posts(spark, sf)).select("seq", "dateline_valid", "text_valid")


@query("clean_posts", f"""
with {RAW_POSTS}, filled as (
  select * from raw_posts where length(regexp_replace(pagetext, '^\\s+|\\s+$', '', 'g')) > 0),
firsts as (select * from filled qualify row_number() over (partition by postid, forum order by seq) = 1)
select postid, forum, seq, dateline, cast(length(pagetext) as bigint) as n_chars from firsts
where year(dateline) >= 2000 and length(pagetext) >= 10""")
def clean_posts(spark, sf):
    return op.clean_posts(raw_posts(spark, sf), ["postid", "forum"], ["seq"]).select(
        "postid", "forum", "seq", "dateline", F.length("pagetext").cast("bigint").alias("n_chars"))


@query("dedup_posts", """
select l_orderkey as threadid, l_suppkey as userid, l_linenumber as seq, l_partkey as postid from lineitem
qualify row_number() over (partition by l_orderkey, l_suppkey order by l_linenumber, l_partkey) = 1""")
def dedup_posts(spark, sf):
    rows = table(spark, sf, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber", "l_partkey").selectExpr(
        "l_orderkey as threadid", "l_suppkey as userid", "l_linenumber as seq", "l_partkey as postid")
    return op.dedup(rows, ["threadid", "userid"], ["seq", "postid"])


@query("clean_messages", """
select distinct date_trunc('minute', ts) as timestamp, cast(user_id as varchar) as username, event_type as message
from events""")
def clean_messages(spark, sf):
    rows = table(spark, sf, "events", "ts", "user_id", "event_type").selectExpr(
        "date_trunc('minute', ts) as timestamp", "cast(user_id as string) as username", "event_type as message")
    return op.clean_messages(rows)


NAMED = "h"
for _name, _char in tx.ENTITIES.items():
    NAMED = f"replace({NAMED}, '&{_name};', chr({ord(_char)}))"
#: Pages and the same pages with board codes and entities put in front.
MARKED = ("""[quote name="x" date="y"]q[/quote] [h1]t[/h1] &#8217; &#x2014; &eacute;&nbsp;&lt;b&gt; &amp;amp; &bogus; """
          """[url=http://a.b/c]l[/url] """)


@query("strip_markup", rf"""
with p as (select page_id, html from pages union all select -page_id - 1, '{MARKED}' || html from pages),
a as (select page_id, regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g') as h from p),
b as (select page_id, regexp_replace(regexp_replace(h, '(?s)<[^>]+>', ' ', 'g'),
        '\[/?[A-Za-z][^\]]*\]', ' ', 'g') as h from a),
n as (select page_id, list_reduce(list_prepend(h, list_distinct(regexp_extract_all(h, '&#([0-9]{{1,7}});', 1))),
        lambda t, d: replace(t, '&#' || d || ';', chr(cast(d as int)))) as h from b),
x as (select page_id, replace(h, '&#x2014;', chr(8212)) as h from n),
c as (select page_id, replace(replace({NAMED}, '&amp;', '&'), chr(160), ' ') as h from x)
select page_id, regexp_replace(regexp_replace(regexp_replace(h, 'https?://\S+', ' ', 'g'), '\s+', ' ', 'g'),
  '^\s+|\s+$', '', 'g') as plain from c""")
def strip_markup(spark, sf):
    pages = table(spark, sf, "pages", "page_id", "html")
    marked = pages.select((-F.col("page_id") - 1).alias("page_id"), F.concat(F.lit(MARKED), "html").alias("html"))
    return pages.unionByName(marked).select("page_id", tx.strip_markup("html").alias("plain"))


@query("local_part", """
select c_custkey as userid, lower(split_part(c_name, '#', 1)) || c_custkey as username,
  'room' || c_nationkey as channel, c_name as plain from customer""")
def local_part(spark, sf):
    ids = table(spark, sf, "customer", "c_custkey", "c_name", "c_nationkey").selectExpr(
        "c_custkey as userid", "concat(lower(split_part(c_name, '#', 1)), c_custkey, '@host.example') as address",
        "concat('!room', c_nationkey, ':host.example') as room", "c_name as plain")
    return ids.select("userid", tx.local_part("address").alias("username"), tx.local_part("room").alias("channel"),
                      tx.local_part("plain").alias("plain"))


@query("code_map", """
select o_orderkey as id,
  case o_orderpriority when '1-URGENT' then 'Admin' when '2-HIGH' then 'Manager' when '3-MEDIUM' then 'Senior'
    when '5-LOW' then 'Affiliate' else 'Unknown' end as role,
  case when o_orderstatus = 'F' then 'BTC' when o_totalprice > 200000 then 'XMR' else 'N/A' end as currency
from orders""")
def code_map(spark, sf):
    rows = table(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice").selectExpr(
        "o_orderkey as id", "o_orderpriority as level", "case when o_orderstatus = 'F' then 'w1' end as wallet_a",
        "case when o_totalprice > 200000 then 'w2' end as wallet_b")
    levels = {"1-URGENT": "Admin", "2-HIGH": "Manager", "3-MEDIUM": "Senior", "5-LOW": "Affiliate"}
    return rows.select("id", op.code_label("level", levels, "Unknown").alias("role"),
                       op.first_present({"wallet_a": "BTC", "wallet_b": "XMR"}).alias("currency"))


@query("json_array_size", """
select event_id, case when event_id % 10 = 0 then 0 else cast(json_extract_string(props, '$.k') as int) % 4 end as n_perms
from events""")
def json_array_size(spark, sf):
    rows = model.posts(spark, sf).select("postid", F.when(F.col("postid") % 20 == 0, F.lit("[broken")).when(
        F.col("postid") % 10 != 0, F.to_json(F.slice(F.array(*[F.lit(x) for x in "abc"]), F.lit(1),
                                                   F.col("section") % 4))).alias("perms"))
    return rows.select(F.col("postid").alias("event_id"), op.json_array_size("perms").alias("n_perms"))


ENTITY_CTE = """entities as (
  select doc_id, ' ' || regexp_extract(text, '([\\p{L}]+)', 1) || ' ' as entity,
    case doc_id % 6 when 0 then 'per' when 1 then 'ORG|company' when 2 then 'Location' when 3 then 'event'
      when 4 then 'gpe | city' else 'thing' end as type, (doc_id % 100) / 100.0::double as confidence
  from documents)"""

ENTITY_NORMAL = ENTITY_CTE + """, normal as (
  select lower(trim(entity)) as entity, case trim(upper(split_part(type, '|', 1))) when 'PER' then 'PERSON'
      when 'ORG' then 'ORGANIZATION' when 'GPE' then 'LOCATION' when 'LOCATION' then 'LOCATION'
      when 'EVENT' then 'EVENT' else 'OTHER' end as type, confidence from entities),
grouped as (select entity, type, count(*) as mentions, round(avg(confidence), 6) as confidence from normal
  where entity <> '' group by 1, 2)"""


def entities(spark, sf):
    """First word of each document as an entity mention with a raw type tag."""
    return table(spark, sf, "documents", "doc_id", "text").selectExpr(
        "doc_id", r"concat(' ', regexp_extract(text, '([\\p{L}]+)', 1), ' ') as entity",
        """case doc_id % 6 when 0 then 'per' when 1 then 'ORG|company' when 2 then 'Location' when 3 then 'event'
           when 4 then 'gpe | city' else 'thing' end as type""", "(doc_id % 100) / 100D as confidence")


@query("normalize_entities", f"with {ENTITY_NORMAL} select * from grouped")
def normalize_entities(spark, sf):
    return op.normalize_entities(entities(spark, sf))


@query("deny_list", f"""with {ENTITY_NORMAL}
select * from grouped where not (type = 'PERSON' and entity in ('the', 'le', 'der', 'la', 'el'))""")
def deny_list(spark, sf):
    return op.deny(op.normalize_entities(entities(spark, sf)), ["the", "le", "der", "la", "el"], "PERSON")


CLASSES = {"english": ["the", "and", "with"], "french": ["eau", "que "], "contact": ["@", "http"],
           "numbers": ["[0-9]{4}"]}


@query("keyword_classes", " union all ".join(
    f"select '{name}' as category, count(*) filter (where regexp_matches(lower(text), '{'|'.join(words)}')) as posts "
    "from documents" for name, words in CLASSES.items()))
def keyword_classes(spark, sf):
    return op.keyword_classes(table(spark, sf, "documents", "text"), "text", CLASSES)


@query("canonical_label", r"""
with tok as (select conv_id, turn, list_transform(regexp_split_to_array(
    lower(regexp_replace(text, '^\s+|\s+$', '', 'g')), '\s+'),
    lambda t: regexp_replace(t, '^[^a-z_]+|[^a-z_]+$', '', 'g')) as toks from conversations)
select conv_id, turn, case when toks[1] in ('the', 'is', 'le', 'la', 'un', 'et', 'der', 'el')
    then toks[1] else 'unknown' end as first_label,
  coalesce(list_filter(toks, lambda t: t in ('the', 'is', 'le', 'la', 'un', 'et', 'der', 'el'))[1], 'unknown')
    as any_label from tok""")
def canonical_label(spark, sf):
    allowed = ["the", "is", "le", "la", "un", "et", "der", "el"]
    return table(spark, sf, "conversations", "conv_id", "turn", "text").select(
        "conv_id", "turn", op.canonical_label("text", allowed).alias("first_label"),
        op.canonical_label("text", allowed, anywhere=True).alias("any_label"))
