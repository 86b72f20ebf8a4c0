"""Identity candidates, signal tables and enrichment."""

from pyspark.sql import functions as F

from foroscope import model
from foroscope.model import cte, table
from foroscope.operators import activity as ac
from foroscope.operators import clean as cl
from foroscope.operators import edges as ed
from foroscope.operators import enrich as en
from foroscope.operators import graph as gr
from foroscope.operators import identity as idn
from foroscope.operators import report as rp
from foroscope.operators import signals as sg
from foroscope.operators import texts as tx
from foroscope.operators import vectors as vx
from foroscope.plans.graphs import DEGREE, SPARSE, contacts, public_graph, staged_public
from foroscope.plans.registry import query
from foroscope.plans.texts import DELTA, VEC, style_sql
from foroscope.plans.vectors import actor_vectors
from foroscope.session import scratch_path, stage
from foroscope.sources.commits import write_batch


@query("handle_fuzzy")
def handle_fuzzy(spark, sf):
    return idn.fuzzy_handles(model.handles(spark, sf))


@query("identity_candidates")
def identity_candidates(spark, sf):
    users = model.handles(spark, sf)
    return idn.candidates(users, idn.fuzzy_handles(users))


def user_vectors(spark, sf):
    """Every user owns the vector of the same number, in source B with its halves swapped."""
    v = table(spark, sf, "embeddings", "vec_id", "embedding")
    a = v.select(F.lit("A").alias("forum"), F.col("vec_id").alias("userid"), F.col("embedding").alias("vec"))
    halves = F.concat(F.slice("embedding", 33, 32), F.slice("embedding", 1, 32))
    b = v.select(F.lit("B").alias("forum"), F.col("vec_id").alias("userid"), halves.alias("vec"))
    return a.unionByName(b)


@query("exact_enriched", cte("handles") + """,
v as (select 'A' as forum, vec_id as userid, embedding as vec from embeddings
  union all select 'B', vec_id, list_concat(embedding[33:64], embedding[1:32]) from embeddings),
k as (select forum, username, vec from handles join v using (forum, userid))
select a.username as handle_a, 'A' as forum_a, b.username as handle_b, 'B' as forum_b, 1.0::double as handle_sim,
  'exact' as match_type, round(list_cosine_similarity(a.vec::double[], b.vec::double[]), 6) as embedding_sim
from k a join k b on a.username = b.username and a.forum = 'A' and b.forum = 'B'""")
def exact_enriched(spark, sf):
    users = model.handles(spark, sf)
    return idn.enrich(idn.exact_pairs(users), users, user_vectors(spark, sf))


@query("identity_enriched")
def identity_enriched(spark, sf):
    users = model.handles(spark, sf)
    return idn.enrich(idn.candidates(users, idn.fuzzy_handles(users)), users, user_vectors(spark, sf))


CONVERGE = DELTA + """, joined as (select userid, string_agg(pagetext, ' ' order by postid) as pagetext from text_posts
    where pagetext <> '' group by 1),""" + style_sql("joined", "userid") + f""",
sv as (select userid, {VEC} as vec from feat),
cand as (select user_a, user_b, delta,
  round(1 - levenshtein(user_a, user_b) / greatest(length(user_a), length(user_b))::double, 6) as handle_sim,
  round(list_cosine_similarity(x.vec, y.vec), 6) as embedding_sim
  from pairs join sv x on x.userid = user_a join sv y on y.userid = user_b)"""


def convergence_pairs(spark, sf):
    posts = model.text_posts(spark, sf)
    delta = tx.delta_pairs(posts).select("user_a", "user_b", "delta")
    delta = stage(delta, "delta")
    actors = delta.select(F.explode(F.array("user_a", "user_b")).alias("userid")).distinct()
    style = tx.style_similarity(posts, actors).withColumnRenamed("similarity", "embedding_sim")
    longest = F.greatest(F.length("user_a"), F.length("user_b"))
    return stage(delta.join(style, ["user_a", "user_b"]).withColumn(
        "handle_sim", F.round(1 - F.levenshtein("user_a", "user_b") / longest, 6)), "convergence")


@query("signal_convergence", CONVERGE + """
select user_a, user_b, delta, handle_sim, embedding_sim,
  (handle_sim >= 0.85)::int + (embedding_sim >= 0.70)::int as n_signals,
  round((handle_sim + 1 - (delta - min(delta) over ()) / (max(delta) over () - min(delta) over ()) + embedding_sim) / 3, 6)
    as combined from cand""")
def signal_convergence(spark, sf):
    return idn.convergence(convergence_pairs(spark, sf))


@query("pair_crosscheck")
def pair_crosscheck(spark, sf):
    posts = model.text_posts(spark, sf)
    suspects = tx.delta_suspects(tx.delta_pairs(posts), share=0.1)
    owner = table(spark, sf, "documents", "doc_id", "source").selectExpr("doc_id as vec_id", "source as userid")
    found = stage(vx.vector_clusters(actor_vectors(spark, sf), "vec_id", k=4).join(owner, "vec_id"), "clusters")
    clusters = rp.dominant_label(found, "userid", "cluster").select("userid", "cluster")
    events = model.posts(spark, sf).withColumn("userid", F.concat(F.lit("src"), F.col("userid") % 20))
    messages = events.select(F.col("userid").alias("src"),
                             F.concat(F.lit("src"), F.col("section") % 20).alias("dst"))
    return idn.crosscheck(suspects, clusters, ac.hour_counts(events).select("userid", "hours"), messages)


SCORE_SQL = SPARSE + ", " + DEGREE + """,
vol as (select cast(o_custkey as varchar) as userid, count(*) as volume from orders group by 1),
pm as (select cast(o_custkey as varchar) as userid, count(distinct l_suppkey) as private from orders
  join lineitem on l_orderkey = o_orderkey group by 1),
t as (select cast(c_custkey as varchar) as userid, coalesce(volume, 0) as volume, coalesce(degree, 0) as public,
  coalesce(private, 0) as private from customer left join vol on vol.userid = cast(c_custkey as varchar)
  left join deg on deg.userid = cast(c_custkey as varchar) left join pm on pm.userid = cast(c_custkey as varchar)),
s as (select userid, """ + ", ".join(
    f"case when max({c}) over () = min({c}) over () then 0 else ({c} - min({c}) over ()) / "
    f"(max({c}) over () - min({c}) over ())::double end as score_{c}" for c in ("volume", "public", "private")) + """ from t)
select userid, round(score_volume, 6) as score_volume, round(score_public, 6) as score_public,
  round(score_private, 6) as score_private, round((score_volume + score_public + score_private) / 3, 6) as combined_score
from s order by combined_score desc, userid limit 20"""


def signal_counts(spark, sf, graph=None):
    """Volume, public and private contacts of each customer; ``graph`` is the public graph where it is already written."""
    base = table(spark, sf, "customer", "c_custkey").selectExpr("cast(c_custkey as string) as userid")
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    userid = F.col("o_custkey").cast("string").alias("userid")  # numbers are grouped, a name is made for each group
    volume = orders.groupBy("o_custkey").agg(F.count("*").alias("volume")).select(userid, "volume")
    edges = public_graph(spark, sf) if graph is None else graph
    public = ed.degree_centrality(edges).select("userid", F.col("degree").alias("public"))
    lines = table(spark, sf, "lineitem", "l_orderkey", "l_suppkey")
    private = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", "l_suppkey").distinct(
    ).groupBy("o_custkey").agg(F.count("*").alias("private")).select(userid, "private")
    return sg.actor_table(base, "userid", {"volume": volume, "public": public, "private": private})


@query("combined_score", SCORE_SQL)
def combined_score(spark, sf):
    return sg.combined_score(stage(signal_counts(spark, sf), "signals"), "userid", ["volume", "public", "private"])


def customer_node(df, col="userid"):
    """Graph node ids of the message graph back to customer ids."""
    return df.filter(F.col(col).startswith("C")).withColumn(col, F.expr(f"substring({col}, 2)"))


@query("structural_signals")
def structural_signals(spark, sf):
    public = staged_public(spark, sf)
    private = stage(contacts(spark, sf), "private")
    sent = ed.message_edges(model.messages(spark, sf).select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    base = table(spark, sf, "customer", "c_custkey").selectExpr("cast(c_custkey as string) as userid")
    return sg.actor_table(base, "userid", {
        "public": gr.betweenness(public, k=None).withColumnRenamed("betweenness", "betweenness_public"),
        "private": customer_node(gr.betweenness(private, k=None)).withColumnRenamed("betweenness", "betweenness_private"),
        "received": customer_node(ed.in_degree(sent)).select("userid", "in_degree"),
        "community": gr.communities(public).withColumnRenamed("node", "userid")}, drop=["0"])


@query("broker_overlap")
def broker_overlap(spark, sf):
    public = gr.betweenness(staged_public(spark, sf), k=8)
    met = contacts(spark, sf).select("user_a", "user_b", "weight")  # written by the ranking, without the durations
    private = customer_node(gr.betweenness(met, k=8))
    return sg.ranking_overlap(stage(public, "a"), stage(private, "b"), "userid", "betweenness", "betweenness")


@query("actor_table")
def actor_table(spark, sf):
    public = staged_public(spark, sf)
    zones = ac.hour_counts(model.posts(spark, sf)).select(
        F.col("userid").cast("string"), ac.utc_offset("hours", "post_count").alias("utc_offset"))
    shapes = user_vectors(spark, sf).filter("forum = 'A'").select(
        F.col("userid").cast("string"), F.lit(True).alias("has_vector"))
    return sg.actor_table(signal_counts(spark, sf, public), "userid", {
        "zone": zones, "vector": shapes, "clustering": ed.clustering(public).select("userid", "clustering"),
        "component": gr.components(public).withColumnRenamed("node", "userid")}, drop=["0"])


@query("scored_labels", """
select conv_id * 1000 + turn as item, case when contains(text, '!') then 'exclamation'
  when contains(text, '?') then 'question' else 'statement' end as label from conversations""")
def scored_labels(spark, sf):
    rows = model.chat(spark, sf).select((F.col("channel") * 1000 + F.col("turn")).alias("item"), "message")
    path = scratch_path(spark, "scores")
    write_batch(en.score_rows(rows.filter("item % 3 = 0"), "item", "message", en.rule_scorer), path, "first")
    scored = en.score_with_resume(spark, rows, "item", "message", en.rule_scorer, path, batches=2)
    allowed = ["question", "exclamation", "statement"]
    return scored.select("item", cl.canonical_label("label", allowed).alias("label"))
