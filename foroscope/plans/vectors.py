"""Vector queries."""

from pyspark.sql import functions as F

from foroscope import model
from foroscope.model import cte, table
from foroscope.operators import neighbours as nb
from foroscope.operators import vectors as vx
from foroscope.plans.registry import query


def actor_vectors(spark, sf):
    return model.spread(model.vectors(spark, sf), "vec_id")


def actors(spark, sf):
    return vx.centroids(actor_vectors(spark, sf), "actor", carry=("grp",))


# mean vector per actor over relation ``{rel}``, one row per dimension, then normalised
CENTROID = """
dims{n} as (select actor, grp, i, avg(vec[i]::double) as x from {rel}, (select unnest(range(1, 65)) as i) group by 1, 2, 3),
cnt{n} as (select actor, count(*) as members from {rel} group by 1 having count(*) >= 5),
cen{n} as (select actor, grp, members, list(x / norm order by i) as vec from (
    select actor, grp, i, x, members, sqrt(sum(x * x) over (partition by actor)) as norm from dims{n} join cnt{n} using (actor))
  group by 1, 2, 3)"""
ACTORS = cte("vectors") + "," + CENTROID.format(n="", rel="vectors") + """,
pairs as (select a.actor as user_a, b.actor as user_b, a.grp as grp_a, b.grp as grp_b,
  round(list_cosine_similarity(a.vec, b.vec), 6) as similarity from cen a join cen b on a.actor < b.actor),
both_ways as (select user_a as actor, user_b as other, grp_a as grp, grp_b as other_grp, similarity from pairs
  union all select user_b, user_a, grp_b, grp_a, similarity from pairs)"""
LONG_VEC = " select actor, members, cast(i as int) as dim, round(x / norm, 6) as x from (select actor, i, x, members, " \
           "sqrt(sum(x * x) over (partition by actor)) as norm from dims join cnt using (actor))"


def by_dimension(df):
    """Vectors as rows (actor, members, dim, x)."""
    return df.select("actor", "members", F.posexplode("vec").alias("dim", "x")).withColumns(
        {"dim": F.col("dim") + 1, "x": F.round("x", 6)})


@query("actor_centroids", ACTORS + LONG_VEC)
def actor_centroids(spark, sf):
    return by_dimension(actors(spark, sf))


@query("actor_means", cte("vectors") + "," + CENTROID.format(n="", rel="vectors") + """
 select actor, members, cast(i as int) as dim, round(x, 6) as x from dims join cnt using (actor)""")
def actor_means(spark, sf):
    return by_dimension(vx.centroids(actor_vectors(spark, sf), "actor", normalise=False))


SAMPLED = """ranked as (select v.*, row_number() over (partition by actor order by length(text) desc, vec_id) as rk
  from vectors v join documents on vec_id = doc_id), longest as (select * from ranked where rk <= 20)"""


def sampled(spark, sf):
    texts = table(spark, sf, "documents", "doc_id", "text").select(
        F.col("doc_id").alias("vec_id"), F.length("text").alias("chars"))
    rows = actor_vectors(spark, sf).join(texts, "vec_id")
    return vx.sampled_centroids(rows, "actor", "chars", "vec_id", 20, carry=("grp",))


@query("sampled_centroids", cte("vectors") + "," + SAMPLED + "," + CENTROID.format(n="", rel="longest") + LONG_VEC)
def sampled_centroids(spark, sf):
    return by_dimension(sampled(spark, sf))


@query("cosine_pairs", ACTORS + " select * from pairs")
def cosine_pairs(spark, sf):
    return vx.cosine_pairs(actors(spark, sf))


@query("top_neighbours", ACTORS + """
select actor, other, similarity, cast(row_number() over (partition by actor order by similarity desc, other) as int) as rank
from both_ways qualify rank <= 3""")
def top_neighbours(spark, sf):
    return vx.top_neighbours(vx.cosine_pairs(actors(spark, sf)))


@query("best_match_by_group", ACTORS + """,
r as (select * from both_ways where grp <> other_grp
  qualify row_number() over (partition by actor, other_grp order by similarity desc, other) = 1)
select actor, grp, other_grp, other as best, similarity, max(similarity) over (partition by actor) as max_similarity from r""")
def best_match_by_group(spark, sf):
    own = actors(spark, sf)
    return vx.best_match_by_group(vx.cosine_pairs(own), own)


@query("cohesion_matrix", ACTORS + """
select grp_a, grp_b, round(avg(list_cosine_similarity(va, vb)), 6) as cohesion from (
  select a.grp as grp_a, b.grp as grp_b, a.vec as va, b.vec as vb from cen a join cen b
    on (a.grp = b.grp and a.actor < b.actor) or a.grp < b.grp) group by 1, 2
union all select grp, grp, 1.0 from cen group by grp having count(*) = 1""")
def cohesion_matrix(spark, sf):
    return vx.cohesion_matrix(actors(spark, sf))


@query("item_cohesion", cte("vectors") + """
select a.grp as grp_a, b.grp as grp_b, round(avg(list_cosine_similarity(a.vec::double[], b.vec::double[])), 6) as cohesion
from vectors a join vectors b on (a.grp = b.grp and a.vec_id < b.vec_id) or a.grp < b.grp group by 1, 2""")
def item_cohesion(spark, sf):
    return vx.cohesion_matrix(actor_vectors(spark, sf))


@query("similarity_hist", ACTORS + """,
r as (select case when grp_a = grp_b then 'intra' else 'inter' end as scope, similarity,
  cast(floor(similarity / 0.05::double) as bigint) as bin from pairs)
select scope, bin, count(*) as pairs, round(sum(sum(similarity)) over (partition by scope)
  / sum(count(*)) over (partition by scope)::double, 6) as mean_similarity from r group by 1, 2""")
def similarity_hist(spark, sf):
    return vx.similarity_hist(vx.cosine_pairs(actors(spark, sf)))


@query("spearman", ACTORS + "," + SAMPLED + "," + CENTROID.format(n="2", rel="longest") + """,
pairs2 as (select a.actor as user_a, b.actor as user_b, round(list_cosine_similarity(a.vec, b.vec), 6) as similarity
  from cen2 a join cen2 b on a.actor < b.actor),
j as (select p.similarity as x, q.similarity as y, user_a, user_b from pairs p join pairs2 q using (user_a, user_b)),
r as (select *, rank() over (order by x) + (count(*) over (partition by x) - 1) / 2.0::double as rx,
  rank() over (order by y) + (count(*) over (partition by y) - 1) / 2.0::double as ry from j)
select 'longest_20' as strategy, (select count(distinct u) from (select user_a as u from j union all select user_b from j))
  as n_users, round(corr(rx, ry), 4) as spearman_rho from r""")
def spearman(spark, sf):
    return vx.spearman(vx.cosine_pairs(actors(spark, sf)), vx.cosine_pairs(sampled(spark, sf)), "longest_20")


@query("adjusted_rand", """
with c as (select l_suppkey % 10 as a, l_partkey % 20 as b, count(*) as n from lineitem group by 1, 2),
x as (select sum(n * (n - 1) / 2.0::double) as idx, sum(n) as total from c),
sa as (select sum(n * (n - 1) / 2.0::double) as s from (select sum(n)::double as n from c group by a)),
sb as (select sum(n * (n - 1) / 2.0::double) as s from (select sum(n)::double as n from c group by b))
select cast(total as bigint) as rows, round((idx - sa.s * sb.s / (total::double * (total - 1) / 2))
  / ((sa.s + sb.s) / 2 - sa.s * sb.s / (total::double * (total - 1) / 2)), 6) as ari from x, sa, sb""")
def adjusted_rand(spark, sf):
    labels = table(spark, sf, "lineitem", "l_suppkey", "l_partkey").selectExpr("l_suppkey % 10 as a", "l_partkey % 20 as b")
    return vx.adjusted_rand(labels, "a", "b")


@query("vector_topk", cte("vectors") + """
select v.vec_id, round(list_cosine_similarity(v.vec::double[], q.vec::double[]), 6) as similarity
from vectors v, (select vec from vectors where vec_id = 0) q order by similarity desc, vec_id limit 10""")
def vector_topk(spark, sf):
    rows = actor_vectors(spark, sf)
    return vx.vector_topk(rows, "vec_id", rows.filter("vec_id = 0"), 10)


@query("vector_clusters")
def vector_clusters(spark, sf):
    return vx.vector_clusters(actor_vectors(spark, sf), "vec_id")


@query("mixed_clusters")
def mixed_clusters(spark, sf):
    return vx.mixed_clusters(vx.vector_clusters(actor_vectors(spark, sf), "vec_id"), "grp")


@query("mixed_groups", """
with c as (select label % 7 - 1 as cluster, vec_id % 3 as source, count(*) as n from embeddings group by 1, 2)
select cluster, cast(sum(n) as bigint) as members, count(*) as sources, max(n) as largest from c where cluster <> -1
group by 1 having count(*) > 1""")
def mixed_groups(spark, sf):
    """Given clusters with members of several sources; -1 is noise."""
    rows = table(spark, sf, "embeddings", "vec_id", "label").selectExpr("label % 7 - 1 as cluster", "vec_id % 3 as source")
    return vx.mixed_clusters(rows, "source")


@query("cluster_leaders", """
with m as (select c_mktsegment as cluster, cast(o_custkey as varchar) as actor, count(*) as posts
  from orders join customer on o_custkey = c_custkey group by 1, 2)
select cluster, actor, posts, cast(row_number() over (partition by cluster order by posts desc, actor) as int) as rank
from m qualify rank <= 5""")
def cluster_leaders(spark, sf):
    posts = table(spark, sf, "orders", "o_custkey").groupBy("o_custkey").agg(F.count("*").alias("posts"))
    people = table(spark, sf, "customer", "c_custkey", "c_mktsegment")
    members = posts.join(people, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "c_mktsegment as cluster", "cast(o_custkey as string) as actor", "posts")
    return vx.cluster_leaders(members, "cluster", "posts")


UNITS = cte("vectors") + """,
u as (select vec_id, list_transform(vec, lambda x: x::double) as vec from vectors),
near as (select a.vec_id as a, b.vec_id as b, list_cosine_similarity(a.vec, b.vec) as s from u a join u b on a.vec_id <> b.vec_id)"""


@query("similar_items", UNITS + """
select a as user_a, b as user_b, round(s, 6) as similarity from near where a < b and s >= 0.4""")
def similar_items(spark, sf):
    """All pairs of items with a cosine of 0.4 or more, by cells."""
    return nb.similar_pairs(actor_vectors(spark, sf), "vec_id", 0.4)


@query("similar_actors", ACTORS + """
select user_a, user_b, similarity from pairs where similarity >= 0.1""")
def similar_actors(spark, sf):
    """Actors whose centroids are alike, without a table of all pairs."""
    return nb.similar_pairs(actors(spark, sf), "actor", 0.1).filter("similarity >= 0.1")


@query("density_clusters", UNITS.replace("with vectors", "with recursive vectors") + """,
cnt as (select u.vec_id, 1 + count(b) as neighbours from u left join near on a = vec_id and s >= 0.35 group by 1),
core as (select vec_id from cnt where neighbours >= 4),
link as (select a, b from near where s >= 0.35 and a in (select vec_id from core) and b in (select vec_id from core)),
reach(node, root) as (select vec_id, vec_id from core union select b, root from reach join link on a = node),
comp as (select node, min(root) as cluster from reach group by 1),
edge as (select a, b from near where s >= 0.35 and a not in (select vec_id from core) and b in (select vec_id from core)
  qualify row_number() over (partition by a order by round(s, 6) desc, b) = 1)
select vec_id, neighbours, case when comp.node is not null then 'core' when edge.b is not null then 'border' else 'noise' end
  as role, coalesce(comp.cluster, c2.cluster, -1) as cluster
from cnt left join comp on comp.node = vec_id left join edge on edge.a = vec_id left join comp c2 on c2.node = edge.b""")
def density_clusters(spark, sf):
    return nb.density_clusters(actor_vectors(spark, sf), "vec_id", 0.35, 4)


@query("mixed_density_clusters", UNITS.replace("with vectors", "with recursive vectors") + """,
cnt as (select u.vec_id, 1 + count(b) as neighbours from u left join near on a = vec_id and s >= 0.35 group by 1),
core as (select vec_id from cnt where neighbours >= 4),
link as (select a, b from near where s >= 0.35 and a in (select vec_id from core) and b in (select vec_id from core)),
reach(node, root) as (select vec_id, vec_id from core union select b, root from reach join link on a = node),
comp as (select node, min(root) as cluster from reach group by 1),
edge as (select a, b from near where s >= 0.35 and a not in (select vec_id from core) and b in (select vec_id from core)
  qualify row_number() over (partition by a order by round(s, 6) desc, b) = 1),
placed as (select node as vec_id, cluster from comp union all select a, cluster from edge join comp on node = b),
c as (select cluster, grp, count(*) as n from placed join vectors using (vec_id) group by 1, 2)
select cluster, cast(sum(n) as bigint) as members, count(*) as sources, max(n) as largest from c group by 1 having count(*) > 1""")
def mixed_density_clusters(spark, sf):
    """Density clusters with members of several groups."""
    rows = actor_vectors(spark, sf)
    found = nb.density_clusters(rows, "vec_id", 0.35, 4).join(rows.select("vec_id", "grp"), "vec_id")
    return vx.mixed_clusters(found, "grp")


@query("vector_topk_batch", cte("vectors") + """,
u as (select vec_id, list_transform(vec, lambda x: x::double) as vec from vectors)
select q.vec_id as query, v.vec_id as key, round(list_cosine_similarity(q.vec, v.vec), 6) as similarity,
  cast(row_number() over (partition by q.vec_id order by round(list_cosine_similarity(q.vec, v.vec), 6) desc, v.vec_id) as int)
    as rank from u q join u v on q.vec_id % 50 = 0 qualify rank <= 10""")
def vector_topk_batch(spark, sf):
    """The ten nearest of all rows for every row whose id is divisible by 50."""
    rows = actor_vectors(spark, sf)
    return nb.nearest_rows(rows, "vec_id", rows.filter("vec_id % 50 = 0"), 10)
