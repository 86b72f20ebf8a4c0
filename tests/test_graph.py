"""Graph operators against brute force on small graphs."""

import itertools
import random

import pytest

from foroscope.operators import edges as ed
from foroscope.operators import graph as gr
from foroscope.plans import QUERIES


def random_edges(n=20, m=34, seed=3):
    rng = random.Random(seed)
    pairs = rng.sample(list(itertools.combinations([f"n{i:02d}" for i in range(n)], 2)), m)
    return [(a, b, rng.randint(1, 4)) for a, b in pairs]


def frame(spark, rows):
    return spark.createDataFrame(rows, "user_a string, user_b string, weight long")


def shortest(rows, cost):
    """All-pairs distances and path counts by exhaustive relaxation."""
    nodes = sorted({x for a, b, _ in rows for x in (a, b)})
    arcs = {(a, b): cost(w) for a, b, w in rows} | {(b, a): cost(w) for a, b, w in rows}
    dist = {(s, t): 0.0 if s == t else float("inf") for s in nodes for t in nodes}
    for _ in nodes:
        for s in nodes:
            for (u, v), c in arcs.items():
                dist[s, v] = min(dist[s, v], dist[s, u] + c)
    sigma = {}
    for s in nodes:
        order = sorted(nodes, key=lambda t: dist[s, t])
        for t in order:
            sigma[s, t] = 1.0 if s == t else sum(
                sigma[s, u] for (u, v), c in arcs.items()
                if v == t and dist[s, t] < float("inf") and abs(dist[s, u] + c - dist[s, t]) < 1e-9)
    return nodes, dist, sigma


def brute_betweenness(rows, cost):
    nodes, dist, sigma = shortest(rows, cost)
    out = dict.fromkeys(nodes, 0.0)
    for s, t in itertools.permutations(nodes, 2):
        if dist[s, t] == float("inf"):
            continue
        for v in nodes:
            if v not in (s, t) and abs(dist[s, v] + dist[v, t] - dist[s, t]) < 1e-9:
                out[v] += sigma[s, v] * sigma[v, t] / sigma[s, t]
    return out


@pytest.mark.parametrize("distance,cost", [("unit", lambda w: 1.0), ("inverse", lambda w: 1.0 / w),
                                           ("weight", float)])
def test_betweenness_exact_with_all_pivots(spark, distance, cost):
    rows = random_edges()
    want = brute_betweenness(rows, cost)
    got = {r.userid: r.betweenness for r in gr.betweenness(
        frame(spark, rows), k=100, distance=distance, normalised=False).collect()}
    assert got.keys() == want.keys()
    for node, value in want.items():
        assert got[node] == pytest.approx(value / 2, abs=1e-6)


@pytest.mark.parametrize("distance,tables", [("unit", False), ("unit", True), ("inverse", True)])
def test_betweenness_of_all_nodes(spark, monkeypatch, distance, tables):
    """Through the tasks and through tables, there in many blocks of sources; a path, two parts and a hub beside."""
    monkeypatch.setattr(gr.brandes, "STATE", 200)
    monkeypatch.setattr(gr.brandes, "CHUNK", 7)
    if tables:
        monkeypatch.setattr(gr.brandes, "ARCS", 0)
        monkeypatch.setattr(gr, "SOURCE_NODES", 900)
    rows = random_edges(16, 26) + [("hub", f"x{i}", 1) for i in range(12)] + [("hub", "n00", 2), ("p", "q", 1)]
    if not tables:
        rows += [(f"y{i:02d}", f"y{i + 1:02d}", 1) for i in range(20)]
    cost = (lambda w: 1.0) if distance == "unit" else (lambda w: 1.0 / w)
    want = brute_betweenness(rows, cost)
    got = {r.userid: r.betweenness for r in gr.betweenness(
        frame(spark, rows), k=None, distance=distance, normalised=False).collect()}
    assert got == {node: pytest.approx(value / 2, abs=1e-6) for node, value in want.items()}


def test_structural_signals_come_from_all_nodes(spark, tmp_path):
    rng = random.Random(9)
    orders = [(o, rng.randint(1, 14)) for o in range(40)] + [(40, None), (None, 3)]
    lines = [(rng.choice([*range(41), None]), rng.randint(1, 6), rng.choice([*range(1, 9), None])) for _ in range(70)]
    tables = {"customer": ("select explode(sequence(0L, 14L)) as c_custkey", None),
              "orders": (orders, "o_orderkey long, o_custkey long"),
              "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long")}
    for name, (rows, schema) in tables.items():
        df = spark.sql(rows) if schema is None else spark.createDataFrame(rows, schema)
        if name == "lineitem":
            df = df.selectExpr("*", "1 as l_linenumber", "2.0D as l_quantity", "timestamp '1997-01-01' as l_shipdate",
                               "'A' as l_returnflag")
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    buyer = {o: c for o, c in orders if o is not None}
    met = {(f"C{buyer[o]}", f"S{s}") for o, _, s in lines if buyer.get(o) and s}
    want = brute_betweenness([(*p, 1) for p in met], lambda w: 1.0)
    got = {r.userid: r.betweenness_private for r in QUERIES["structural_signals"](spark, str(tmp_path)).collect()}
    n = len(want)
    assert n > 16 and sorted(got) == sorted(str(i) for i in range(1, 15))
    for userid, value in got.items():
        node = f"C{userid}"
        assert value == (pytest.approx(want[node] / ((n - 1) * (n - 2)), abs=1e-7) if node in want else None)


def test_betweenness_normalised_star(spark):
    rows = [("c", x, 1) for x in "lmno"]
    got = {r.userid: r.betweenness for r in gr.betweenness(frame(spark, rows), k=10).collect()}
    assert got["c"] == pytest.approx(1.0) and got["l"] == 0.0


def test_isolated_pair_has_no_betweenness(spark):
    got = gr.betweenness(frame(spark, [("a", "b", 1)]), k=5).collect()
    assert [r.betweenness for r in got] == [0.0, 0.0]


def test_closeness(spark):
    rows = random_edges()
    nodes, dist, _ = shortest(rows, lambda w: 1.0 / w)
    got = {r.userid: r.closeness for r in gr.closeness(frame(spark, rows), k=100).collect()}
    for s in nodes:
        reached = [d for t in nodes if t != s and (d := dist[s, t]) < float("inf")]
        want = len(reached) / sum(reached) * len(reached) / (len(nodes) - 1)
        assert got[s] == pytest.approx(want, abs=1e-6)


def test_components_long_path_and_isolated(spark):
    rows = [(f"p{i:03d}", f"p{i + 1:03d}", 1) for i in range(60)] + [("x", "y", 1)]
    nodes = spark.createDataFrame([("alone",), ("x",), ("p000",)], "node string")
    got = {r.node: r.component for r in gr.components(frame(spark, rows)).collect()}
    assert {got[f"p{i:03d}"] for i in range(61)} == {"p000"} and got["y"] == "x"
    some = {r.node: r.component for r in gr.components(frame(spark, rows), nodes).collect()}
    assert some == {"alone": "alone", "x": "x", "p000": "p000"}


TRIANGLES = [("a", "b", 1), ("b", "c", 1), ("a", "c", 1), ("d", "e", 1), ("e", "f", 1), ("d", "f", 1), ("c", "d", 1)]


def test_communities_two_triangles(spark):
    labels = gr.communities(frame(spark, TRIANGLES))
    got = {r.node: r.community for r in labels.collect()}
    assert got == dict(a="a", b="a", c="a", d="d", e="d", f="d")
    q = ed.modularity(frame(spark, TRIANGLES), labels).first()
    assert q.communities == 2 and q.modularity == pytest.approx(6 / 7 - 0.5, abs=1e-6)


def test_communities_better_than_singletons(spark):
    edges = frame(spark, random_edges(30, 60, 8))
    labels = gr.communities(edges)
    assert ed.modularity(edges, labels).first().modularity > 0.2


def test_composition_ranks_communities_by_size(spark):
    members = {"a": 4, "b": 2, "c": 5, "d": 2, "e": 1}
    labels = spark.createDataFrame([(f"{c}{i}", c) for c, n in members.items() for i in range(n)] + [("z", None)],
                                   "node string, community string")
    sources = spark.createDataFrame([(f"{c}{i}", "xy"[i % 2]) for c, n in members.items() for i in range(n) if c != "e"],
                                    "node string, source string")
    got = {(r.community, r.source): (r.members, r["size"], r.size_rank) for r in gr.composition(labels, sources).collect()}
    assert got == {("a", "x"): (2, 4, 2), ("a", "y"): (2, 4, 2), ("b", "x"): (1, 2, 3), ("b", "y"): (1, 2, 3),
                   ("c", "x"): (3, 5, 1), ("c", "y"): (2, 5, 1), ("d", "x"): (1, 2, 3), ("d", "y"): (1, 2, 3),
                   ("e", None): (1, 1, 5)}


def test_a_round_of_moves_is_few_jobs(spark, monkeypatch):
    """Modularity is a by-product of the next round, not a pass of its own."""
    rounds, sc = [], spark.sparkContext
    monkeypatch.setattr(gr, "stage", lambda df, name, write=gr.stage: rounds.append(name) or write(df, name))
    arcs = ed.both_directions(frame(spark, random_edges(30, 60, 8))).selectExpr("src", "dst", "cast(weight as double) as weight")
    sc.setJobGroup("moves", "moves")
    try:
        labels, quality = gr._local_moves(arcs)
        jobs = len(sc.statusTracker().getJobIdsForGroup("moves"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 12 * rounds.count("labels")
    found = ed.modularity(frame(spark, random_edges(30, 60, 8)), labels).first()
    assert quality == pytest.approx(found.modularity, abs=1e-6)


def test_clustering(spark):
    got = {r.userid: (r.triangles, r.clustering) for r in ed.clustering(frame(spark, TRIANGLES)).collect()}
    assert got["a"] == (1, 1.0) and got["c"] == (1, pytest.approx(1 / 3, abs=1e-6))


def test_band_and_mega_threads(spark):
    rows = [("f", "t1", f"u{i:02d}") for i in range(12)] + [("f", "big", f"u{i % 3}") for i in range(101)]
    posts = spark.createDataFrame(rows, "forum string, threadid string, userid string")
    full = ed.copart_edges(posts, max_posts=100).count()
    banded = ed.copart_edges(posts, max_posts=100, band=9).collect()
    assert full == 12 * 11 // 2
    assert len(banded) == full - 3  # ranks 10 and 11 apart: (0,10) (0,11) (1,11)
    assert ed.copart_edges(posts).filter("user_a = 'u0' and user_b = 'u1'").count() == 1


def test_no_thread_is_lost_when_threads_grow(spark):
    """Threads larger than a block, each three times as large as the last."""
    sizes = {"t0": 30, "t1": 150, "t2": 450}
    posts = spark.createDataFrame([("f", t, f"{i:03d}") for t, n in sizes.items() for i in range(n)],
                                  "forum string, threadid string, userid string")
    edges = ed.copart_edges(posts).collect()
    assert len(edges) == 450 * 449 // 2 and all(e.user_a < e.user_b for e in edges)
    weight = {(e.user_a, e.user_b): e.weight for e in edges}
    assert weight["000", "029"] == 3 and weight["000", "149"] == 2 and weight["149", "449"] == 1
    banded = ed.copart_edges(posts, band=9).collect()
    assert len(banded) == 9 * 450 - 45 and sum(e.weight for e in banded) == sum(9 * n - 45 for n in sizes.values())


def test_closeness_of_every_node_from_few_pivots(spark):
    rows = random_edges()
    nodes, dist, _ = shortest(rows, lambda w: 1.0 / w)
    got = {r.userid: (r.reached, r.closeness) for r in gr.closeness(frame(spark, rows), k=5).collect()}
    assert set(got) == set(nodes) and all(0 <= r <= 5 for r, _ in got.values())


def test_message_edges_drop_self_and_placeholder(spark):
    rows = [("a", "b"), ("a", "b"), ("b", "b"), ("0", "a"), ("a", "0"), (None, "a")]
    got = ed.message_edges(spark.createDataFrame(rows, "src string, dst string")).collect()
    assert [(r.src, r.dst, r.weight) for r in got] == [("a", "b", 2)]
