"""Graph queries. Public graph: customers who bought the same part in the same year (pairs met at least twice), so that
threads do not grow with the tables; message graph: customers and suppliers."""

from pyspark.sql import functions as F

from foroscope import model
from foroscope.model import cte, table
from foroscope.operators import edges as ed
from foroscope.operators import graph as gr
from foroscope.operators import report as rp
from foroscope.plans.registry import query
from foroscope.session import stage

PAIRS = """members as (select distinct forum, threadid, userid from {rel}),
copart as (select a.userid as user_a, b.userid as user_b, a.forum as forum, count(*) as weight
  from members a join members b on a.forum = b.forum and a.threadid = b.threadid and a.userid < b.userid group by 1, 2, 3)"""
DENSE = cte("participation") + ", " + PAIRS.format(rel="participation")

SPARSE_POSTS = """with sparse as (select 'parts' as forum, cast(o_custkey as varchar) as userid,
  concat(l_partkey, '-', year(l_shipdate)) as threadid from lineitem join orders on l_orderkey = o_orderkey)"""
SPARSE = SPARSE_POSTS + ", " + PAIRS.format(rel="sparse") + """,
strong as (select user_a, user_b, weight from copart where weight >= 2),
arcs as (select user_a as src, user_b as dst, weight from strong union all select user_b, user_a, weight from strong)"""


def sparse_posts(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_shipdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).selectExpr(
        "'parts' as forum", "cast(o_custkey as string) as userid", "concat(l_partkey, '-', year(l_shipdate)) as threadid")


def public_graph(spark, sf):
    return ed.strong_edges(ed.across_forums(ed.copart_edges(sparse_posts(spark, sf))))


def staged_public(spark, sf):
    return stage(public_graph(spark, sf), "public")


@query("copart_edges", DENSE + " select * from copart")
def copart_edges(spark, sf):
    return ed.copart_edges(model.participation(spark, sf))


@query("copart_strong", DENSE + """ select user_a, user_b, cast(sum(weight) as bigint) as weight from copart
group by 1, 2 having sum(weight) >= 2""")
def copart_strong(spark, sf):
    return ed.strong_edges(ed.across_forums(ed.copart_edges(model.participation(spark, sf))))


@query("copart_edges_banded", SPARSE_POSTS + """,
members as (select distinct forum, threadid, userid from sparse),
r as (select *, row_number() over (partition by forum, threadid order by userid) as rk from members)
select a.userid as user_a, b.userid as user_b, a.forum as forum, count(*) as weight
from r a join r b on a.forum = b.forum and a.threadid = b.threadid and b.rk between a.rk + 1 and a.rk + 9 group by 1, 2, 3""")
def copart_edges_banded(spark, sf):
    return ed.copart_edges(sparse_posts(spark, sf), band=ed.BAND)


@query("pm_edges", cte("messages") + """ select src, dst, count(*) as weight from messages
where src <> dst and src <> 'C0' and dst <> 'C0' group by 1, 2""")
def pm_edges(spark, sf):
    return ed.message_edges(model.messages(spark, sf).select("src", "dst"), placeholder="C0")


CONTACT = cte("messages") + """, contact as (select least(src, dst) as user_a, greatest(src, dst) as user_b,
  count(*) as weight, avg(duration_s) as mean_duration from messages where src <> dst group by 1, 2)"""


def contacts(spark, sf):
    return ed.contact_edges(model.messages(spark, sf).select("src", "dst", "duration_s"))


@query("contact_edges", CONTACT + """ select user_a, user_b, weight, round(mean_duration, 6) as mean_duration,
  round(1.0::double / weight, 6) as distance from contact""")
def contact_edges(spark, sf):
    return contacts(spark, sf).withColumns({"mean_duration": F.round("mean_duration", 6),
                                            "distance": F.round("distance", 6)})


DEGREE = """deg as (select src as userid, count(*) as degree, cast(sum(weight) as bigint) as strength from arcs group by 1)"""


@query("degree_centrality", SPARSE + ", " + DEGREE + """ select userid, degree, strength,
  round(degree / greatest((select count(*) from deg) - 1, 1)::double, 6) as centrality from deg""")
def degree_centrality(spark, sf):
    return ed.degree_centrality(public_graph(spark, sf))


@query("in_degree", cte("messages") + """, e as (select src, dst, count(*) as weight from messages group by 1, 2)
select dst as userid, count(*) as in_degree, cast(sum(weight) as bigint) as received from e group by 1""")
def in_degree(spark, sf):
    return ed.in_degree(ed.message_edges(model.messages(spark, sf).select("src", "dst")))


@query("components", SPARSE.replace("with sparse", "with recursive sparse") + """,
reach(node, root) as (select distinct src, src from arcs
  union select a.dst, r.root from reach r join arcs a on a.src = r.node)
select node, min(root) as component from reach group by 1""")
def components(spark, sf):
    return gr.components(staged_public(spark, sf))


@query("giant_component", SPARSE.replace("with sparse", "with recursive sparse") + """,
reach(node, root) as (select distinct src, src from arcs
  union select a.dst, r.root from reach r join arcs a on a.src = r.node),
c as (select node, min(root) as component from reach group by 1)
select component, node from c where component =
  (select component from c group by 1 order by count(*) desc, component limit 1)""")
def giant_component(spark, sf):
    return gr.giant_component(stage(gr.components(staged_public(spark, sf)), "components"))


@query("clustering_coeff", SPARSE + """,
deg as (select src as userid, count(*) as degree from arcs group by 1),
tri as (select x.src as userid, count(*) as triangles from arcs x join arcs y on x.src = y.src and x.dst < y.dst
  join arcs z on z.src = x.dst and z.dst = y.dst group by 1)
select userid, degree, coalesce(triangles, 0) as triangles,
  round(case when degree > 1 then 2 * coalesce(triangles, 0) / (degree * (degree - 1))::double else 0 end, 6) as clustering
from deg left join tri using (userid)""")
def clustering_coeff(spark, sf):
    return ed.clustering(staged_public(spark, sf))


@query("betweenness_pivots")
def betweenness_pivots(spark, sf):
    return gr.betweenness(staged_public(spark, sf), k=64)


@query("closeness_pivots")
def closeness_pivots(spark, sf):
    return gr.closeness(staged_public(spark, sf), k=64)


@query("betweenness_inverse")
def betweenness_inverse(spark, sf):
    return gr.betweenness(staged_public(spark, sf), k=8, distance="inverse", normalised=False)


@query("communities")
def communities(spark, sf):
    return gr.communities(staged_public(spark, sf))


def nation_labels(spark, sf):
    return table(spark, sf, "customer", "c_custkey", "c_nationkey").selectExpr(
        "cast(c_custkey as string) as node", "c_nationkey as community")


@query("modularity", SPARSE + """,
l as (select cast(c_custkey as varchar) as node, c_nationkey as c from customer),
e as (select weight, a.c as ca, b.c as cb from arcs join l a on a.node = src join l b on b.node = dst),
p as (select ca, sum(weight)::double as d, coalesce(sum(weight) filter (where ca = cb), 0)::double as i from e group by 1)
select count(*) as communities, round(sum(i) / sum(d) - sum(d * d) / (sum(d) * sum(d)), 6) as modularity from p""")
def modularity(spark, sf):
    return ed.modularity(staged_public(spark, sf), nation_labels(spark, sf))


@query("community_composition")
def community_composition(spark, sf):
    labels = gr.communities(staged_public(spark, sf))
    sources = table(spark, sf, "customer", "c_custkey", "c_mktsegment").selectExpr(
        "cast(c_custkey as string) as node", "c_mktsegment as source")
    return gr.composition(stage(labels, "labels"), sources)


@query("community_topic")
def community_topic(spark, sf):
    labels = gr.communities(staged_public(spark, sf))
    orders = table(spark, sf, "orders", "o_custkey", "o_orderpriority").selectExpr(
        "cast(o_custkey as string) as node", "o_orderpriority as topic")
    topic = rp.dominant_label(orders, "node", "topic").select("node", "topic")
    return gr.group_topic(labels, topic)


@query("group_composition", """
select c_nationkey as community, c_mktsegment as source, count(*) as members,
  cast(sum(count(*)) over (partition by c_nationkey) as bigint) as size from customer group by 1, 2""")
def group_composition(spark, sf):
    """The composition of given groups, here nations."""
    sources = table(spark, sf, "customer", "c_custkey", "c_mktsegment").selectExpr(
        "cast(c_custkey as string) as node", "c_mktsegment as source")
    return gr.composition(nation_labels(spark, sf), sources).drop("size_rank")


@query("group_topic", """
with n as (select cast(o_custkey as varchar) as node, o_orderpriority as topic, count(*) as n from orders group by 1, 2),
t as (select * from n qualify row_number() over (partition by node order by n desc, topic) = 1),
c as (select c_nationkey as community, topic, count(*) as n from customer join t on node = cast(c_custkey as varchar)
  group by 1, 2),
m as (select community, sum(n) as members from c group by 1)
select community, cast(members as bigint) as members, topic, round(n / members::double, 6) as purity
from c join m using (community) qualify row_number() over (partition by community order by n desc, topic) = 1""")
def group_topic(spark, sf):
    """The dominant topic of given groups, here nations."""
    orders = table(spark, sf, "orders", "o_custkey", "o_orderpriority").selectExpr(
        "cast(o_custkey as string) as node", "o_orderpriority as topic")
    topic = rp.dominant_label(orders, "node", "topic").select("node", "topic")
    return gr.group_topic(nation_labels(spark, sf), topic)


@query("direct_contacts", CONTACT + """ select case when user_a = 'C1' then user_b else user_a end as contact, weight
from contact where user_a = 'C1' or user_b = 'C1' order by weight desc, contact limit 20""")
def direct_contacts(spark, sf):
    return ed.direct_contacts(contacts(spark, sf), "C1")


@query("common_contacts", CONTACT + """,
a as (select case when user_a = 'S1' then user_b else user_a end as contact, weight from contact
      where user_a = 'S1' or user_b = 'S1'),
b as (select case when user_a = 'S2' then user_b else user_a end as contact, weight from contact
      where user_a = 'S2' or user_b = 'S2')
select contact, a.weight as weight_a, b.weight as weight_b from a join b using (contact)""")
def common_contacts(spark, sf):
    return ed.common_contacts(contacts(spark, sf), "S1", "S2")


@query("bridge_nodes", CONTACT + """,
l as (select concat('C', c_custkey) as node, c_nationkey as c from customer),
arcs as (select user_a as src, user_b as dst from contact union all select user_b, user_a from contact)
select src as userid, count(*) as degree, count(*) filter (where c = 1) as in_one, count(*) filter (where c = 2) as in_two
from arcs left join l on node = dst group by 1
having count(*) filter (where c = 1) > 0 and count(*) filter (where c = 2) > 0""")
def bridge_nodes(spark, sf):
    labels = nation_labels(spark, sf).withColumn("node", F.concat(F.lit("C"), "node"))
    return ed.bridge_nodes(contacts(spark, sf), labels, 1, 2)


@query("contact_profile", """
with m as (select concat('u', user_id) as src, concat('u', (user_id + event_id) % 7) as dst, value as duration_s, ts from events),
r as (select * from m where src = 'u3' or dst = 'u3')
select count(*) as calls, round(sum(duration_s), 2) as total_s, round(avg(duration_s), 4) as mean_s,
  count(*) filter (where src = 'u3') as calls_out, count(*) filter (where dst = 'u3') as calls_in,
  (select cast(hour(ts) as int) from r group by 1 order by count(*) desc, 1 limit 1) as peak_hour from r""")
def contact_profile(spark, sf):
    calls = table(spark, sf, "events", "event_id", "user_id", "ts", "value").selectExpr(
        "concat('u', user_id) as src", "concat('u', (user_id + event_id) % 7) as dst", "value as duration_s",
        "ts as timestamp")
    return ed.contact_profile(calls, "u3")


@query("top_subgraph", SPARSE + ", " + DEGREE + """, top as (select userid from deg order by degree desc, userid limit 150)
select user_a, user_b, weight from strong where user_a in (select userid from top) and user_b in (select userid from top)""")
def top_subgraph(spark, sf):
    edges = staged_public(spark, sf)
    return ed.top_subgraph(edges, ed.degree_centrality(edges), "degree", 150)
