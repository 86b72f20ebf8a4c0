"""Sampled betweenness and refined communities."""

import random

import pytest

from foroscope.operators import graph as gr
from foroscope.operators.paths import betweenness_within, pair_shares

from test_graph import brute_betweenness, frame, random_edges, shortest


def test_shares_of_every_pair(spark):
    rows = random_edges(14, 22, seed=5) + [("x1", "x2", 1)]
    nodes, dist, sigma = shortest(rows, lambda w: 1.0)
    arcs = gr.with_cost(frame(spark, rows)).select("src", "dst")
    pairs = [(i, s, t) for i, (s, t) in enumerate((s, t) for s in nodes for t in nodes if s != t)]
    got = {(r.pair, r.node): r.share for r in pair_shares(arcs, spark.createDataFrame(pairs, "pair int, s string, t string"))
           .collect()}
    want = {}
    for i, s, t in pairs:
        for v in nodes:
            if v not in (s, t) and dist[s, t] < float("inf") and dist[s, v] + dist[v, t] == dist[s, t]:
                want[i, v] = sigma[s, v] * sigma[v, t] / sigma[s, t]
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_every_node_is_within_its_error(spark):
    rng = random.Random(2)
    hubs = [(f"a{i}", f"a{j}", 1) for i in range(6) for j in range(i)] + [
        (f"a{i % 6}", f"b{i:02d}", 1) for i in range(40)] + [(f"b{i:02d}", f"b{rng.randrange(40):02d}", 1) for i in range(10)]
    rows = sorted({(min(a, b), max(a, b), w) for a, b, w in hubs if a != b})
    exact = brute_betweenness(rows, lambda w: 1.0)
    n = len(exact)
    got = betweenness_within(frame(spark, rows), error=0.2, batch=64).collect()
    assert {r.userid for r in got} == set(exact)
    for r in got:
        assert r.error <= 0.2 and abs(r.betweenness - exact[r.userid] / ((n - 1) * (n - 2))) <= r.error
    assert max(r.betweenness for r in got) > 0.05


def test_small_graphs(spark):
    assert [(r.betweenness, r.error) for r in betweenness_within(frame(spark, [("a", "b", 1)])).collect()] == [(0.0, 0.0)] * 2
    assert betweenness_within(frame(spark, [])).count() == 0


def planted(groups=6, size=12, seed=1):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        names = [f"g{g}n{i:02d}" for i in range(size)]
        rows += [(names[i], names[j], 3) for i in range(size) for j in range(i + 1, size) if rng.random() < 0.5]
        rows += [(names[i], names[i + 1], 1) for i in range(size - 1)]
        rows.append((names[0], f"g{(g + 1) % groups}n05", 1))
    return sorted({(min(a, b), max(a, b), w) for a, b, w in rows})


def modularity(rows, label):
    total = 2 * sum(w for *_, w in rows)
    degree, inside = {}, 0
    for a, b, w in rows:
        degree[label[a]] = degree.get(label[a], 0) + w
        degree[label[b]] = degree.get(label[b], 0) + w
        inside += 2 * w * (label[a] == label[b])
    return inside / total - sum(d * d for d in degree.values()) / total ** 2


def one_level(rows):
    """Nodes one after the other to the neighbouring community of highest modularity, until none moves."""
    label = {n: n for a, b, _ in rows for n in (a, b)}
    moved = True
    while moved:
        moved = False
        for node in sorted(label):
            options = {label[b] for a, b, _ in rows if a == node} | {label[a] for a, b, _ in rows if b == node}
            best = max(sorted(options), key=lambda c: modularity(rows, label | {node: c}))
            if modularity(rows, label | {node: best}) > modularity(rows, label) + 1e-9:
                label[node], moved = best, True
    return label


@pytest.mark.parametrize("rows", [planted(), random_edges(40, 60, seed=9)])
def test_communities_are_connected(spark, rows):
    import duckdb

    found = gr.communities(frame(spark, rows)).toPandas()
    edges = spark.createDataFrame(rows, "a string, b string, w long").toPandas()
    con = duckdb.connect()
    con.register("found", found)
    con.register("edges", edges)
    parts = con.sql("""
      with recursive arcs as (select a, b from edges union all select b, a from edges),
      inside as (select a, b from arcs join found x on x.node = a join found y on y.node = b where x.community = y.community),
      reach(node, root) as (select node, node from found union select b, root from reach join inside on a = node)
      select count(distinct community) as communities, count(distinct part) as parts from (
        select node, min(root) as part from reach group by 1) join found using (node)""").fetchall()[0]
    assert parts[0] == parts[1]
    label = dict(zip(found.node, found.community, strict=True))
    assert all(label[c] == c and c <= n for n, c in label.items())
    single = modularity(rows, {n: n for n in label})
    quality = modularity(rows, label)
    assert quality > single + 0.2
    assert quality >= modularity(rows, one_level(rows)) - 1e-9


def test_planted_groups(spark):
    label = {r.node: r.community for r in gr.communities(frame(spark, planted())).collect()}
    assert len(set(label.values())) == 6 and all(label[n] == label[f"{n[:2]}n00"] for n in label)


def test_path_longer_than_any_fixed_number_of_rounds(spark):
    rows = [(f"n{i:03d}", f"n{i + 1:03d}", 1) for i in range(24)]
    pivots = spark.createDataFrame([("n000",)], "pivot string")
    got = {r.node: r.dist for r in gr.distances(gr.with_cost(frame(spark, rows)), pivots).collect()}
    assert got == {f"n{i:03d}": float(i) for i in range(25)}
