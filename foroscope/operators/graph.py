"""Iterative graph analytics as rounds of DataFrame joins.

Every round is written to the shared checkpoint folder, so plans stay short and lost executors only cost
a re-read. Loops read back counts, never rows. Betweenness over all nodes sends a graph of bounded size to its tasks.
"""

from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from foroscope.functions.ranking import top_n_per_key
from foroscope.operators import brandes
from foroscope.operators.edges import both_directions
from foroscope.operators.sample import hash_order
from foroscope.session import drop_stage, restage, stage

# Pairs of a source and a node at once, where betweenness over all nodes goes through tables.
SOURCE_NODES = 1 << 25


def components(edges: DataFrame, nodes: DataFrame | None = None, max_rounds: int = 50) -> DataFrame:
    """Connected components by alternating large-star and small-star rounds; label = smallest node id.

    Each star step needs the smallest neighbour per node (a pre-aggregated minimum) joined back to the
    edges, so hubs are never gathered. Converges in about log(n) rounds whatever the diameter.
    """
    now = stage(edges.select(F.greatest("user_a", "user_b").alias("u"), F.least("user_a", "user_b").alias("v"))
                .filter("u <> v").distinct(), "cc")
    mark = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m")))).alias("e"))
        now = restage(small.select("e.u", F.col("e.m").alias("v")).filter("u <> v").distinct(), "cc", now)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    found = members.unionByName(roots)
    if nodes is None:
        return found
    return nodes.select("node").distinct().join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def giant_component(found: DataFrame) -> DataFrame:
    """Members of the largest component (lowest label on ties)."""
    best = found.groupBy("component").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "component").limit(1)
    return found.join(best.select("component"), "component", "left_semi")


def with_cost(edges: DataFrame, distance: str = "unit") -> DataFrame:
    """Both directions with a path cost: one per edge, the weight, or its inverse."""
    cost = {"unit": F.lit(1.0), "weight": F.col("weight").cast("double"), "inverse": 1.0 / F.col("weight")}[distance]
    return both_directions(edges).select("src", "dst", cost.alias("cost"))


def choose_pivots(arcs: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """k nodes in hash order."""
    return arcs.select(F.col("src").alias("pivot")).distinct().orderBy(hash_order("pivot", seed), "pivot").limit(k)


def distances(arcs: DataFrame, pivots: DataFrame) -> DataFrame:
    """Shortest distance from each pivot to every reached node, by relaxation of the changed nodes only.

    Costs are positive, so the rounds end: there are at most as many as the longest shortest path has edges."""
    known = stage(pivots.select("pivot", F.col("pivot").alias("node"), F.lit(0.0).alias("dist"),
                                F.lit(0).alias("round")), "dist")
    for step in count(1):
        front = known.filter(F.col("round") == step - 1)
        reached = front.join(arcs, front.node == arcs.src).groupBy("pivot", F.col("dst").alias("node")).agg(
            F.min(F.col("dist") + F.col("cost")).alias("cand"))
        merged = known.join(reached, ["pivot", "node"], "full")
        better = F.col("dist").isNull() | (F.col("cand") < F.col("dist") - 1e-9)
        known = restage(merged.select(
            "pivot", "node", F.when(better, F.col("cand")).otherwise(F.col("dist")).alias("dist"),
            F.when(better, F.lit(step)).otherwise(F.col("round")).alias("round")), "dist", known)
        if known.filter(F.col("round") == step).limit(1).count() == 0:
            out = known.select("pivot", "node", "dist")
            out.stage_path = known.stage_path
            return out


def _noted(written: list[DataFrame], staged: DataFrame) -> DataFrame:
    written.append(staged)
    return staged


def _spread_sums(start: DataFrame, steps: DataFrame, name: str, written: list[DataFrame]) -> list[DataFrame]:
    """Push values along acyclic steps (pivot, from, to) round by round until nothing moves."""
    layers, front = [start], start
    while True:
        front = _noted(written, stage(front.join(steps.withColumnRenamed("from", "node"), ["pivot", "node"]).groupBy(
            "pivot", F.col("to").alias("node")).agg(F.sum("x").alias("x")), name))
        if front.limit(1).count() == 0:
            return layers
        layers.append(front)


def _total(layers: list[DataFrame], name: str) -> DataFrame:
    every = reduce(DataFrame.unionByName, layers)
    return every.groupBy("pivot", "node").agg(F.sum("x").alias(name))


def _unit_loads(arcs: DataFrame, pivots: DataFrame, written: list[DataFrame]) -> DataFrame | None:
    """Dependency of every (pivot, node) with one cost per edge, level by level. The tables that it writes go to ``written``.

    Neighbours of level L lie in levels L-1 to L+1, so a new level is checked against the last two only.
    """
    levels = [_noted(written, stage(pivots.select(
        "pivot", F.col("pivot").alias("node"), F.lit(1.0).alias("sigma")), "level"))]
    while True:
        last = levels[-2:]
        seen = reduce(DataFrame.unionByName, last).select("pivot", "node")
        new = levels[-1].join(arcs, F.col("node") == F.col("src")).groupBy(
            "pivot", F.col("dst").alias("node")).agg(F.sum("sigma").alias("sigma"))
        new = _noted(written, stage(new.join(seen, ["pivot", "node"], "left_anti"), "level"))
        if new.isEmpty():
            break
        levels.append(new)
    if len(levels) < 3:
        return None
    loads, g = [], levels[-1].withColumn("g", F.lit(0.0))
    for level in reversed(levels[1:-1]):
        pushed = g.select("pivot", F.col("node").alias("dst"), (1.0 / F.col("sigma") + F.col("g")).alias("x")).join(
            arcs, "dst").groupBy("pivot", F.col("src").alias("node")).agg(F.sum("x").alias("g"))
        g = _noted(written, stage(level.join(pushed, ["pivot", "node"], "left").fillna(0.0, ["g"]), "dependency"))
        loads.append(g)
    return reduce(DataFrame.unionByName, loads)


def _weighted_loads(arcs: DataFrame, pivots: DataFrame, written: list[DataFrame]) -> DataFrame | None:
    """The same for positive costs: distances give the acyclic graph of shortest paths per pivot, path
    counts are pushed forward along it and dependencies backward."""
    dist = _noted(written, distances(arcs, pivots))
    ahead = dist.select("pivot", F.col("node").alias("src"), F.col("dist").alias("d0"))
    behind = dist.select("pivot", F.col("node").alias("dst"), F.col("dist").alias("d1"))
    steps = _noted(written, stage(ahead.join(arcs, "src").join(behind, ["pivot", "dst"]).filter(
        F.abs(F.col("d0") + F.col("cost") - F.col("d1")) < 1e-9).select(
        "pivot", F.col("src").alias("from"), F.col("dst").alias("to")), "steps"))
    start = pivots.select("pivot", F.col("pivot").alias("node"), F.lit(1.0).alias("x"))
    paths = _noted(written, stage(_total(_spread_sums(start, steps, "paths", written), "sigma"), "sigma"))
    back = steps.select("pivot", F.col("to").alias("from"), F.col("from").alias("to"))
    seeds = paths.filter("pivot <> node").select("pivot", "node", (1.0 / F.col("sigma")).alias("x"))
    layers = _spread_sums(seeds, back, "dependency", written)[1:]
    if not layers:
        return None
    return _total(layers, "g").filter("pivot <> node").join(paths, ["pivot", "node"])


def _all_loads(arcs: DataFrame, distance: str) -> DataFrame | None:
    """Load of every node with each node as a pivot. A graph of unit costs and up to ``brandes.ARCS`` arcs goes to the tasks;
    other graphs are walked in tables for some pivots at a time, whose tables are deleted before the next ones."""
    if distance == "unit" and arcs.count() <= brandes.ARCS:
        return brandes.unit_loads(arcs)
    nodes = arcs.select(F.col("src").alias("pivot")).distinct()
    blocks = max(1, -(-nodes.count() ** 2 // SOURCE_NODES))
    nodes = stage(nodes.withColumn("block", F.pmod(F.xxhash64("pivot"), F.lit(blocks))), "pivots")
    find, total = _unit_loads if distance == "unit" else _weighted_loads, None
    for block in range(blocks):
        written = []
        loads = find(arcs, nodes.filter(F.col("block") == block).select("pivot"), written)
        if loads is not None:
            load = loads.groupBy("node").agg(F.sum(F.col("g") * F.col("sigma")).alias("load"))
            total = stage(load, "load") if total is None else restage(
                total.unionByName(load).groupBy("node").agg(F.sum("load").alias("load")), "load", total)
        for table in written:
            drop_stage(table)
    return total


def betweenness(edges: DataFrame, k: int | None = 32, distance: str = "unit", normalised: bool = True,
                seed: int = 42) -> DataFrame:
    """Betweenness estimated from k pivots; exact when k covers all nodes or is None. Sums per (pivot, node) with one
    shuffle per round."""
    arcs = stage(with_cost(edges, distance), "arcs")
    nodes = arcs.select(F.col("src").alias("userid")).distinct()
    if k is None:
        load, share = _all_loads(arcs, distance), F.lit(1.0)
    else:
        pivots = stage(choose_pivots(arcs, k, seed), "pivots")
        load = (_unit_loads if distance == "unit" else _weighted_loads)(arcs, pivots, [])
        if load is not None:
            load = load.groupBy("node").agg(F.sum(F.col("g") * F.col("sigma")).alias("load"))
            share = nodes.agg(F.count("*")).scalar() / pivots.agg(F.count("*")).scalar()
    if load is None:
        return nodes.withColumn("betweenness", F.lit(0.0))
    n = nodes.agg(F.count("*")).scalar()
    scale = (F.when(n > 2, 1.0 / ((n - 1) * (n - 2))).otherwise(1.0) if normalised else F.lit(0.5)) * share
    load = load.withColumnRenamed("node", "userid")
    return nodes.join(load, "userid", "left").select(
        "userid", F.round(F.coalesce("load", F.lit(0.0)) * scale, 8).alias("betweenness"))


def closeness(edges: DataFrame, k: int = 32, distance: str = "inverse", seed: int = 42) -> DataFrame:
    """Closeness of every node, estimated from its distances to k pivots; exact when k covers all nodes.

    Reached pivots / sum of their distances, times the share of the other pivots that are reached.
    """
    arcs = stage(with_cost(edges, distance), "arcs")
    pivots = stage(choose_pivots(arcs, k, seed), "pivots")
    dist = distances(arcs, pivots).filter("pivot <> node").groupBy(F.col("node").alias("userid")).agg(
        F.count("*").alias("reached"), F.sum("dist").alias("total"))
    others = F.lit(pivots.count()) - F.when(F.col("pivot").isNotNull(), 1).otherwise(0)
    nodes = arcs.select(F.col("src").alias("userid")).distinct().join(
        pivots, F.col("userid") == F.col("pivot"), "left").join(dist, "userid", "left")
    r = F.coalesce("reached", F.lit(0))
    return nodes.select("userid", r.alias("reached"), F.round(
        F.when(F.col("total") > 0, r / F.col("total") * r / others).otherwise(0.0), 8).alias("closeness"))


def _move(links: DataFrame, labels: DataFrame, m2: float, step: int) -> tuple[DataFrame, float, float]:
    """One round of moves of (node, community, k), with the weight inside of the communities before it and the sum of the
    squares of their degrees. ``links`` hold a link of weight 0 from each node to itself, which brings the node its own
    community. Both sums are taken while the round is written, so a round is one pass over the links."""
    totals = labels.groupBy("community").agg(F.sum("k").alias("t"))
    there = labels.join(totals, "community").select(F.col("node").alias("dst"), F.col("community").alias("target"), "t")
    near = links.join(there, "dst").groupBy(F.col("src").alias("node"), "target").agg(
        F.sum("weight").alias("w"), F.max("t").alias("t"))
    k, home = F.col("k"), F.col("target") == F.col("community")
    # gains of a node all lack the same link to its home, so they are in the order of w - k * t / m2
    best = F.min(F.when(~home, F.struct((k * F.col("t") / m2 - F.col("w")).alias("c"), "target", "w", "t")))
    chosen = labels.join(near, "node").groupBy("node", "community", "k").agg(
        F.max(F.when(home, F.col("w"))).alias("inside"), F.max(F.when(home, F.col("t"))).alias("tot"), best.alias("b"))
    gain = F.col("b.w") - F.col("inside") - k * (F.col("b.t") - (F.col("tot") - k)) / m2
    turn = F.pmod(F.xxhash64("node", F.lit(step // 2)), F.lit(2)) == step % 2
    seen = Observation()
    chosen = chosen.observe(seen, F.sum("inside").alias("inside"), F.sum(k * F.col("tot")).alias("squares"))
    moved = stage(chosen.select("node", F.when((gain > 1e-9) & turn, F.col("b.target")).otherwise(
        F.col("community")).alias("community"), "k"), "labels")
    return moved, seen.get["inside"], seen.get["squares"]


def _local_moves(arcs: DataFrame, start: DataFrame | None = None,
                 within: DataFrame | None = None) -> tuple[DataFrame, float]:
    """Nodes move to the neighbouring community of highest modularity gain, half of them per round, until neither half
    gains any more. They start alone or from ``start``; with ``within`` they stay inside its communities.

    A round gives the modularity of the labels that it starts from, so the labels of each are judged by the next one."""
    degree = arcs.groupBy(F.col("src").alias("node")).agg(F.sum("weight").alias("k"))
    alone = degree.select("node", F.col("node").alias("community"), "k")
    labels = stage(alone if start is None else start.select("node", "community").join(degree, "node", "left").fillna(
        0.0, ["k"]), "labels")
    loop = F.sum(F.when(F.col("src") == F.col("dst"), F.col("weight")).otherwise(0.0))
    m2, loops = arcs.agg(F.sum("weight"), loop).first()
    if not m2:
        return labels.select("node", "community"), 0.0
    links = arcs.filter("src <> dst").select("src", "dst", "weight")
    if within is not None:
        links = _same_community(links, within)
    links = stage(links.select("src", "dst", "weight").unionByName(
        labels.select(F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(0.0).alias("weight"))), "links")
    best, top, idle = None, float("-inf"), 0
    for step in count():
        moved, inside, squares = _move(links, labels, m2, step)
        now = (inside + loops) / m2 - squares / (m2 * m2)
        if best is None or now > top + 1e-6:
            if best is not None:
                drop_stage(best)
            best, top = labels, now
        else:
            idle += 1
            drop_stage(labels)
            if idle == 2:
                drop_stage(moved)
                drop_stage(links)
                return best.select("node", "community"), top
        labels = moved


def _same_community(arcs: DataFrame, labels: DataFrame) -> DataFrame:
    la = labels.select(F.col("node").alias("src"), F.col("community").alias("ca"))
    lb = labels.select(F.col("node").alias("dst"), F.col("community").alias("cb"))
    return arcs.join(la, "src").join(lb, "dst").filter("ca = cb").drop("ca", "cb")


def _connected_parts(arcs: DataFrame, labels: DataFrame) -> DataFrame:
    """Communities split into their connected parts, named by their smallest node; this never lowers modularity."""
    inside = _same_community(arcs.filter("src < dst"), labels)
    found = components(inside.select(F.col("src").alias("user_a"), F.col("dst").alias("user_b")), labels)
    return stage(found.select("node", F.col("component").alias("community")), "parts")


def communities(edges: DataFrame) -> DataFrame:
    """Connected communities by modularity: local moves, refinement, aggregation, until modularity rises no more.

    After the moves of a level, each community is refined: its nodes start alone again and merge only inside of it, and
    what is not connected is parted. The refined parts are the nodes of the next level, which starts from the unrefined
    communities, so a badly connected community can fall apart there. Labels are the smallest node id of the community.
    """
    whole = stage(both_directions(edges).withColumn("weight", F.col("weight").cast("double")), "arcs")
    arcs, start, best, top = whole, None, None, float("-inf")
    own = whole.select(F.col("src").alias("node")).distinct().select("node", F.col("node").alias("part"))
    while True:
        moved, quality = _local_moves(arcs, start)
        if quality <= top + 1e-6:
            break
        top = quality
        named = moved.select(F.col("node").alias("part"), "community")
        best = stage(own.join(named, "part").select("node", "community"), "communities")
        parts = _connected_parts(arcs, _local_moves(arcs, within=moved)[0])
        renamed = parts.select(F.col("node").alias("part"), F.col("community").alias("next"))
        start = renamed.join(named, "part").groupBy(F.col("next").alias("node")).agg(F.min("community").alias("community"))
        start = stage(start, "start")
        own = stage(own.join(renamed, "part").select("node", F.col("next").alias("part")), "own")
        la = parts.select(F.col("node").alias("src"), F.col("community").alias("ca"))
        lb = parts.select(F.col("node").alias("dst"), F.col("community").alias("cb"))
        arcs = stage(arcs.join(la, "src").join(lb, "dst").groupBy(F.col("ca").alias("src"), F.col("cb").alias("dst"))
                     .agg(F.sum("weight").alias("weight")), "arcs")
    return _connected_parts(whole, best)


def composition(labels: DataFrame, sources: DataFrame) -> DataFrame:
    """Members per community and source, with the community's size and size rank: 1 for the largest, communities of one size
    share the rank.

    Only the distinct sizes are ranked in one place; n members have at most sqrt(2n) of them."""
    rows = labels.join(sources, "node", "left")
    per = stage(rows.groupBy("community", "source").agg(F.count("*").alias("members")), "composition")
    size = per.filter("community is not null").groupBy("community").agg(F.sum("members").alias("size"))
    larger = Window.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = size.groupBy("size").agg(F.count("*").alias("n")).select(
        "size", (1 + F.coalesce(F.sum("n").over(larger), F.lit(0))).alias("size_rank"))
    return per.join(size.join(ranks, "size"), "community").select("community", "source", "members", "size", "size_rank")


def group_topic(labels: DataFrame, topic: DataFrame) -> DataFrame:
    """Dominant topic and purity of each community."""
    counts = labels.join(topic, "node").groupBy("community", "topic").agg(F.count("*").alias("n"))
    total = counts.groupBy("community").agg(F.sum("n").alias("members"))
    best = top_n_per_key(counts, ["community"], [F.desc("n"), "topic"], 1)
    return best.join(total, "community").select(
        "community", "topic", "members", F.round(F.col("n") / F.col("members"), 6).alias("purity"))
