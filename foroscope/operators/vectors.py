"""Centroids, similarity tables, cohesion, clusters and nearest neighbours."""

from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foroscope.functions.ranking import top_n_per_key
from foroscope.functions.stats import average_rank, exact_quantiles
from foroscope.functions.vectors import cosine, dot, pairs_of, unit
from foroscope.session import stage


def centroids(df: DataFrame, key: str, min_members: int = 5, normalise: bool = True,
              carry: tuple = ()) -> DataFrame:
    """Mean vector per key with at least ``min_members`` rows, L2-normalised unless told otherwise.

    The vector mean is aggregated per input partition first, so a hot key costs one vector per partition.
    """
    mean = vector_to_array(Summarizer.mean(array_to_vector("vec")))
    out = df.filter(F.col(key).isNotNull() & F.col("vec").isNotNull()).groupBy(key, *carry).agg(
        F.count("*").alias("members"), mean.alias("vec")).filter(F.col("members") >= min_members)
    return out.withColumn("vec", unit("vec")) if normalise else out


def sampled_centroids(df: DataFrame, key: str, weight: str, order: str, n: int, **options) -> DataFrame:
    """Centroids over the n rows of largest weight per key."""
    return centroids(top_n_per_key(df, [key], [F.desc(weight), order], n), key, **options)


def largest(vectors: DataFrame, n: int) -> DataFrame:
    """The n actors with most members: a population for the pair tables."""
    return vectors.orderBy(F.desc("members"), "actor").limit(n)


def cosine_pairs(population: DataFrame) -> DataFrame:
    """Cosine of all actor pairs of the given population, rounded to 6 digits."""
    extra = [c for c in ("grp",) if c in population.columns]
    return pairs_of(population, "actor").select(
        F.col("a.actor").alias("user_a"), F.col("b.actor").alias("user_b"),
        *[F.col(f"{s}.{c}").alias(f"{c}_{s}") for c in extra for s in "ab"],
        F.round(cosine("a.vec", "b.vec"), 6).alias("similarity"))


def both_ways(pairs: DataFrame) -> DataFrame:
    """Each unordered pair seen from either side."""
    sides = F.explode(F.array(
        F.struct(F.col("user_a").alias("actor"), F.col("user_b").alias("other"), F.col("grp_b").alias("other_grp")),
        F.struct(F.col("user_b").alias("actor"), F.col("user_a").alias("other"), F.col("grp_a").alias("other_grp"))))
    return pairs.select(sides.alias("s"), "similarity").select("s.*", "similarity")


def top_neighbours(pairs: DataFrame, k: int = 3) -> DataFrame:
    """The k most similar other actors."""
    return top_n_per_key(both_ways(pairs), ["actor"], [F.desc("similarity"), "other"], k, rank="rank").select(
        "actor", "other", "similarity", "rank")


def best_match_by_group(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """Best match of each actor in every other group, and the best one across groups."""
    rows = both_ways(pairs).join(own.select("actor", "grp"), "actor").filter("other_grp <> grp")
    best = top_n_per_key(rows, ["actor", "other_grp"], [F.desc("similarity"), "other"], 1)
    return best.select("actor", "grp", "other_grp", F.col("other").alias("best"), "similarity",
                       F.max("similarity").over(Window.partitionBy("actor")).alias("max_similarity"))


def cohesion_matrix(vectors: DataFrame, group: str = "grp") -> DataFrame:
    """Mean cosine inside and between groups, in closed form from the sum of unit vectors per group.

    Inside: (|S|^2 - sum |v|^2) / (n (n-1)), 1.0 for one member; between: Sa.Sb / (na nb). No actor pair
    is formed, so groups may be of any size.
    """
    units = vectors.select(group, unit("vec").alias("u"))
    sums = units.groupBy(F.col(group).alias("grp")).agg(
        F.count("*").cast("double").alias("n"), F.sum(dot("u", "u")).alias("own"),
        vector_to_array(Summarizer.sum(array_to_vector("u"))).alias("s"))
    n = F.col("n")
    inside = sums.select(F.col("grp").alias("grp_a"), F.col("grp").alias("grp_b"), F.round(
        F.when(n > 1, (dot("s", "s") - F.col("own")) / (n * (n - 1))).otherwise(1.0), 6).alias("cohesion"))
    between = pairs_of(sums, "grp").select(
        F.col("a.grp").alias("grp_a"), F.col("b.grp").alias("grp_b"),
        F.round(dot("a.s", "b.s") / (F.col("a.n") * F.col("b.n")), 6).alias("cohesion"))
    return inside.unionByName(between)


def similarity_hist(pairs: DataFrame, width: float = 0.05) -> DataFrame:
    """Pairs per similarity bin inside and between groups, with the mean of each side."""
    scope = F.when(F.col("grp_a") == F.col("grp_b"), "intra").otherwise("inter")
    rows = pairs.select(scope.alias("scope"), "similarity", F.floor(F.col("similarity") / width).alias("bin"))
    bins = rows.groupBy("scope", "bin").agg(F.count("*").alias("pairs"), F.sum("similarity").alias("s"))
    w = Window.partitionBy("scope")
    return bins.select("scope", "bin", "pairs",
                       F.round(F.sum("s").over(w) / F.sum("pairs").over(w), 6).alias("mean_similarity"))


def spearman(a: DataFrame, b: DataFrame, strategy: str, min_shared: int = 10) -> DataFrame:
    """Rank correlation of the pair similarities of two strategies over their shared actors."""
    joined = stage(a.select("user_a", "user_b", F.col("similarity").alias("x")).join(
        b.select("user_a", "user_b", F.col("similarity").alias("y")), ["user_a", "user_b"]), "spearman")
    ranked = average_rank(average_rank(joined, "x", "rx"), "y", "ry")
    actors = joined.select(F.explode(F.array("user_a", "user_b")).alias("u")).agg(F.count_distinct("u")).scalar()
    return ranked.agg(F.round(F.corr("rx", "ry"), 4).alias("spearman_rho")).select(
        F.lit(strategy).alias("strategy"), actors.alias("n_users"), "spearman_rho").filter(
        F.col("n_users") >= min_shared)


def vector_clusters(df: DataFrame, key: str, k: int = 8, dims: int = 10, noise: float = 0.95) -> DataFrame:
    """PCA to ``dims`` dimensions and bisecting k-means; members beyond the given quantile of the distance
    to their own centre become noise (-1)."""
    rows = stage(df.select("*", array_to_vector(unit("vec")).alias("features")), "cluster-input")
    reduced = PCA(k=dims, inputCol="features", outputCol="reduced").fit(rows).transform(rows)
    reduced = stage(reduced.drop("features"), "cluster-reduced")
    model = BisectingKMeans(k=k, seed=42, featuresCol="reduced", predictionCol="cluster").fit(reduced)
    found = model.transform(reduced).withColumn("r", vector_to_array("reduced"))
    centres = found.groupBy("cluster").agg(vector_to_array(Summarizer.mean(F.col("reduced"))).alias("centre"))
    gap = F.sqrt(F.aggregate(F.zip_with("r", "centre", lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                             lambda s, x: s + x))
    placed = stage(found.join(centres, "cluster").withColumn("distance", gap)
                   .drop("r", "centre", "reduced", "vec"), "cluster-distance")
    cut = exact_quantiles(placed, ["cluster"], "distance", [noise]).select("cluster", "quantile")
    return placed.join(cut, "cluster").withColumn(
        "cluster", F.when(F.col("distance") <= F.col("quantile"), F.col("cluster")).otherwise(-1)).select(
        key, *[c for c in ("actor", "grp") if c in df.columns], "cluster", F.round("distance", 6).alias("distance"))


def mixed_clusters(clusters: DataFrame, source: str) -> DataFrame:
    """Clusters, noise aside, with members of more than one source."""
    counts = clusters.filter("cluster <> -1").groupBy("cluster", source).agg(F.count("*").alias("n"))
    return counts.groupBy("cluster").agg(
        F.sum("n").alias("members"), F.count("*").alias("sources"), F.max("n").alias("largest")
    ).filter("sources > 1")


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labelings from their contingency counts."""
    cells = stage(df.dropna(subset=[a, b]).groupBy(a, b).agg(F.count("*").alias("n")), "contingency")

    def comb(c):
        return F.col(c).cast("double") * (F.col(c) - 1) / 2

    def side(c):
        return cells.groupBy(c).agg(F.sum("n").alias("n")).agg(F.sum(comb("n"))).scalar()

    total = cells.agg(F.sum("n").alias("total"), F.sum(comb("n")).alias("index")).withColumns(
        {"sa": side(a), "sb": side(b)})
    expected = F.col("sa") * F.col("sb") / comb("total")
    top = (F.col("sa") + F.col("sb")) / 2
    return total.select(F.col("total").alias("rows"), F.round(F.when(top == expected, 1.0).otherwise(
        (F.col("index") - expected) / (top - expected)), 6).alias("ari"))


def vector_topk(df: DataFrame, key: str, query: DataFrame, k: int = 10) -> DataFrame:
    """Items nearest to one query vector: a single scan with a top-k, the query travels as a scalar."""
    rows = df.withColumn("q", query.select("vec").limit(1).scalar())
    return rows.select(key, F.round(cosine("vec", "q"), 6).alias("similarity")).orderBy(
        F.desc("similarity"), key).limit(k)


def cluster_leaders(members: DataFrame, cluster: str, weight: str, n: int = 5) -> DataFrame:
    """The n most active members of each cluster."""
    return top_n_per_key(members, [cluster], [F.desc(weight), "actor"], n, rank="rank")
