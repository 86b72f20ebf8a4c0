"""Betweenness from sampled pairs of nodes, with a stated error.

For a sampled pair all shortest paths are found from both ends at once: the two fronts grow level by level, in turns, until
they meet. The share of the pair's shortest paths that runs through a node is exact, from path counts pushed back along
the levels, and lies between 0 and 1; betweenness is its mean over all pairs. Batches of pairs are added until an
empirical Bernstein bound on the deviation of every node is below the wanted error.
"""

from functools import reduce
from math import log

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foroscope.operators.graph import with_cost
from foroscope.operators.sample import hash_order
from foroscope.session import drop_stage, restage, stage


def sampled_pairs(nodes: DataFrame, n: int, seed: str) -> DataFrame:
    """``n`` pairs (pair, s, t) of different nodes: two hash orders of the nodes side by side, up to all nodes."""
    def order(side, name):
        first = nodes.orderBy(hash_order("node", f"{seed}{side}"), "node").limit(n)  # the sample, not the graph
        place = F.row_number().over(Window.orderBy(hash_order("node", f"{seed}{side}"), "node"))
        return first.select(F.col("node").alias(name), place.alias("pair"))

    return order("s", "s").join(order("t", "t"), "pair").filter("s <> t")


def _grow(levels: list[DataFrame], arcs: DataFrame, open_: DataFrame) -> DataFrame:
    """Next level of the pairs that are still open: path counts of the nodes that the last two levels do not hold."""
    seen = reduce(DataFrame.unionByName, levels[-2:]).select("pair", "node")
    out = levels[-1].join(open_, "pair", "left_semi").join(arcs, F.col("node") == F.col("src")).groupBy(
        "pair", F.col("dst").alias("node")).agg(F.sum("sigma").alias("sigma"))
    return stage(out.join(seen, ["pair", "node"], "left_anti"), "front")


def _push_back(levels: list[DataFrame], met: list[DataFrame | None], arcs: DataFrame) -> list[DataFrame]:
    """Shares of the nodes of all levels but the first, from the shares where the fronts met."""
    out, now = [], None
    for i in range(len(levels) - 1, 0, -1):
        parts = [p for p in (now, met[i]) if p is not None]
        if not parts:
            continue
        here = stage(reduce(DataFrame.unionByName, parts).groupBy("pair", "node").agg(F.sum("share").alias("share")), "shares")
        out.append(here)
        ahead = here.join(levels[i], ["pair", "node"]).select(
            "pair", F.col("node").alias("dst"), (F.col("share") / F.col("sigma")).alias("x"))
        behind = levels[i - 1].select("pair", F.col("node").alias("src"), "sigma")
        now = ahead.join(arcs, "dst").join(behind, ["pair", "src"]).select(
            "pair", F.col("src").alias("node"), (F.col("x") * F.col("sigma")).alias("share"))
    return out


def pair_shares(arcs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(pair, node, share): which part of a pair's shortest paths runs through each inner node."""
    open_ = stage(pairs.select("pair"), "open-pairs")
    sides = [[stage(pairs.select("pair", F.col(c).alias("node"), F.lit(1.0).alias("sigma")), "front")] for c in ("s", "t")]
    met: list[list] = [[None], [None]]
    turn = 0
    while not open_.isEmpty():
        sides[turn].append(_grow(sides[turn], arcs, open_))
        met[turn].append(None)
        a, b = (side[-1] for side in sides)
        meet = a.join(b.withColumnRenamed("sigma", "other"), ["pair", "node"]).join(open_, "pair", "left_semi").select(
            "pair", "node", (F.col("sigma") * F.col("other")).alias("paths"))
        meet = stage(meet.withColumn("share", F.col("paths") / F.sum("paths").over(Window.partitionBy("pair"))).drop("paths"),
                     "met")
        # pushed back on either side from the level that it has reached
        met[0][-1] = meet if met[0][-1] is None else met[0][-1].unionByName(meet)
        met[1][-1] = meet if met[1][-1] is None else met[1][-1].unionByName(meet)
        alive = sides[turn][-1].select("pair").distinct()
        open_ = restage(open_.join(meet.select("pair").distinct(), "pair", "left_anti").join(alive, "pair", "left_semi"),
                        "open-pairs", open_)
        turn = 1 - turn
    drop_stage(open_)
    shares = [s for side, where in zip(sides, met, strict=True) for s in _push_back(side, where, arcs)]
    empty = pairs.select("pair", F.col("s").alias("node"), F.lit(0.0).alias("share")).limit(0)
    every = reduce(DataFrame.unionByName, shares, empty)
    inner = every.join(pairs, "pair").filter("node <> s and node <> t")
    # the meeting nodes were counted from both sides, with the same share
    out = stage(inner.groupBy("pair", "node").agg(F.max("share").alias("share")), "pair-shares")
    for table in (*sides[0], *sides[1]):
        drop_stage(table)
    return out


def betweenness_within(edges: DataFrame, error: float = 0.02, confidence: float = 0.9, batch: int = 512,
                       seed: int = 42) -> DataFrame:
    """Normalised betweenness (both directions, as a share of all pairs of other nodes) with its error: userid,
    betweenness, error, pairs.

    With probability ``confidence`` no node deviates by more than its ``error``, which is at most the wanted one. Graphs
    with at most as many ordered pairs as the sample would need are not taken whole; the bound holds for them too. Pairs
    without a path count as none through any node."""
    arcs = stage(with_cost(edges).select("src", "dst").filter("src <> dst").distinct(), "arcs")
    nodes = stage(arcs.select(F.col("src").alias("node")).distinct(), "nodes")
    n = nodes.count()
    if n < 3:
        return nodes.select(F.col("node").alias("userid"), F.lit(0.0).alias("betweenness"), F.lit(0.0).alias("error"),
                            F.lit(0).cast("long").alias("pairs"))
    scale, used, step, sums = n / (n - 2), 0, 0, None
    while True:
        pairs = stage(sampled_pairs(nodes, min(batch, n), f"{seed}-{step}-"), "pairs")
        used, step, batch = used + pairs.count(), step + 1, 2 * batch
        fresh = pair_shares(arcs, pairs).groupBy("node").agg(
            F.sum("share").alias("s"), F.sum(F.col("share") * F.col("share")).alias("q"))
        every = fresh if sums is None else sums.unionByName(fresh).groupBy("node").agg(F.sum("s").alias("s"),
                                                                                     F.sum("q").alias("q"))
        sums = stage(every, "betweenness") if sums is None else restage(every, "betweenness", sums)
        # each look at the data spends half of the remaining chance to be wrong
        spread = log(3 * n * 2 ** step / (1 - confidence))
        s, q = (F.coalesce(c, F.lit(0.0)) for c in ("s", "q"))
        variance = F.greatest(F.lit(0.0), (q - s * s / used) / max(used - 1, 1))
        bound = F.sqrt(2 * spread / used * variance) + 3 * spread / used
        out = nodes.join(sums, "node", "left").select(
            F.col("node").alias("userid"), F.round(s / used * scale, 8).alias("betweenness"),
            F.round(bound * scale, 8).alias("error"), F.lit(used).cast("long").alias("pairs"))
        if out.agg(F.max("error")).first()[0] <= error:
            return out
