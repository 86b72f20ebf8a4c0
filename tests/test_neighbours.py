"""Exact neighbour search against comparisons of all pairs."""

import numpy as np
import pytest

from foroscope.operators import neighbours as nb


def clustered(rng, groups, size, dims=16, spread=0.05):
    centres = rng.normal(size=(groups, dims))
    return (centres[:, None, :] + spread * rng.normal(size=(groups, size, dims))).reshape(-1, dims)


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(4)
    x = np.concatenate([clustered(rng, 12, 40), rng.normal(size=(150, 16))])
    x = np.concatenate([x, x[:30], 3 * x[30:40]])  # equal vectors, and equal directions
    return x[rng.permutation(len(x))]


def frame(spark, x, odd=True):
    rows = [(i, [float(v) for v in r], "extra", 0) for i, r in enumerate(x)]
    if odd:
        rows += [(100_000, None, "e", 1), (100_001, [0.0] * x.shape[1], "e", 2), (None, [1.0] * x.shape[1], "e", 3)]
    return spark.createDataFrame(rows, "vec_id long, vec array<double>, key string, cell int").repartition(5)


def cosines(x):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    return u @ u.T


@pytest.mark.parametrize("part", [4096, 7])
def test_pairs(spark, points, monkeypatch, part):
    monkeypatch.setattr(nb, "PART", part)
    monkeypatch.setattr(nb, "STEP", 13 if part == 7 else 512)
    got = {(r.user_a, r.user_b): r.similarity for r in nb.similar_pairs(frame(spark, points), "vec_id", 0.97).collect()}
    cos = cosines(points)
    a, b = np.nonzero(np.triu(cos >= 0.97, 1))
    assert set(got) == set(zip(a.tolist(), b.tolist(), strict=True)) and len(a) > 1000
    assert all(abs(got[p] - cos[p]) < 1e-6 for p in got)


def brute_density(x, threshold, least):
    cos = cosines(x)
    near = cos >= threshold
    count = near.sum(axis=1)
    core = count >= least
    label = np.where(core, np.arange(len(x)), len(x))
    while True:
        new = np.where(core, np.where(near & core, label, len(x)).min(axis=1), label)
        if (new == label).all():
            break
        label = new
    out = []
    for i in range(len(x)):
        if core[i]:
            out.append((i, int(count[i]), "core", int(label[i])))
        elif (near[i] & core).any():
            best = min(np.flatnonzero(near[i] & core), key=lambda j: (-round(cos[i, j], 6), j))
            out.append((i, int(count[i]), "border", int(label[best])))
        else:
            out.append((i, int(count[i]), "noise", -1))
    return out


@pytest.mark.parametrize(("part", "least"), [(4096, 10), (9, 10), (9, 18)])
def test_density_clusters(spark, points, monkeypatch, part, least):
    monkeypatch.setattr(nb, "PART", part)
    got = {r.vec_id: tuple(r) for r in nb.density_clusters(frame(spark, points), "vec_id", 0.9976, least).collect()}
    want = brute_density(points, 0.9976, least)
    assert [got[i] for i in range(len(points))] == want
    assert {w[2] for w in want} == {"core", "border", "noise"}
    assert got[100_000][1:] == got[100_001][1:] == (0, "noise", -1)


def test_many_equal_vectors_are_one_row(spark):
    x = np.concatenate([np.tile(np.eye(1, 8), (3000, 1)), np.eye(8)])
    got = nb.density_clusters(frame(spark, x, odd=False), "vec_id", 0.99, 50).groupBy("role", "cluster").count().collect()
    assert sorted(map(tuple, got)) == [("core", 0, 3001), ("noise", -1, 7)]


@pytest.mark.parametrize("part", [4096, 11])
def test_nearest_rows_of_many_queries(spark, points, monkeypatch, part):
    monkeypatch.setattr(nb, "PART", part)
    df = frame(spark, points)
    got = {}
    for r in nb.nearest_rows(df, "vec_id", df.filter("vec_id % 7 = 0"), 5).collect():
        got.setdefault(r.query, {})[r.rank] = (r.key, r.similarity)
    cos = np.round(cosines(points), 6)
    assert sorted(got) == [i for i in range(len(points)) if i % 7 == 0]
    for q, found in got.items():
        order = sorted(range(len(points)), key=lambda j: (-cos[q, j], j))[:5]
        assert [found[i + 1][0] for i in range(5)] == order
        assert np.allclose([found[i + 1][1] for i in range(5)], cos[q, order], atol=2e-6)


def test_cells_prune(spark):
    """In clustered vectors a row is compared with a small part of all others."""
    x = clustered(np.random.default_rng(8), 60, 50)
    found = nb.place(nb.usable(frame(spark, x, odd=False), "vec_id", "vec"))
    rows = nb.dealt(found, found.home.selectExpr("key", "0L as mark", "vec", "cell"), float(np.arccos(0.97)))
    work = rows.groupBy("cell", "part").pivot("kind", [0, 1, 2]).count().fillna(0).selectExpr(
        "sum(`0` * (`1` + `2`)) as compared").first().compared
    assert work / len(x) < 0.2 * len(x)


def test_cells_that_nothing_prunes_are_packed(spark):
    """Where every vector visits every cell, it is sent once for a bin of many cells."""
    x = np.random.default_rng(9).normal(size=(1500, 32))
    found = nb.place(nb.usable(frame(spark, x, odd=False), "vec_id", "vec"))
    sent = nb.dealt(found, found.home.selectExpr("key", "0L as mark", "vec", "cell"), float(np.arccos(0.2)))
    assert len(found.centres) == 38 and sent.count() < 4 * len(x)


def test_nothing_usable(spark):
    empty = frame(spark, np.zeros((3, 4)))
    assert nb.similar_pairs(empty.limit(0), "vec_id", 0.9).count() == 0
    assert nb.nearest_rows(empty.filter("vec_id < 3"), "vec_id", empty, 3).count() == 0
    assert {r.role for r in nb.density_clusters(empty.filter("vec_id < 3"), "vec_id", 0.9, 2).collect()} == {"noise"}
