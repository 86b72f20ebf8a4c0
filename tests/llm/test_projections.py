import numpy as np

from foroscope.llm.projections import least_count, near_vectors

KIND = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.95):
    good = {}
    for i, (_, v, _) in enumerate(rows):
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v, np.float32).astype(float)
            good[i] = a / np.linalg.norm(a)
    links = {i: {j for j, b in good.items() if j != i and len(a) == len(b) and a @ b >= threshold} for i, a in good.items()}
    label = [r[0] for r in rows]
    changed = True
    while changed:
        changed = False
        for i, own in links.items():
            low = min([label[i], *[label[j] for j in own]])
            changed |= low != label[i]
            label[i] = low
    return sorted((r[0], len(links.get(i, ())), label[i], label[i] == r[0]) for i, r in enumerate(rows))


def result(df):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def clusters(seed, n=40, copies=12, size=32):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        centre = rng.standard_normal(size)
        for _ in range(int(rng.integers(1, copies))):
            out.append((centre + rng.standard_normal(size) * rng.choice([0.0, 0.05, 0.12, 0.16])).tolist())
    rng.shuffle(out)
    return [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(out)]


def test_recall_and_no_wrong_link(spark):
    rows = clusters(1)
    got, want = result(near_vectors(spark.createDataFrame(rows, KIND))), brute(rows)
    assert sum(w[1] for w in want) > 300
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)


def test_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, 2), (3, [2.0, 4.0, 6.0], None), (4, None, 1), (5, [0.0, 0.0, 0.0], 1), (6, [1.0, None, 3.0], 1),
            (7, [float("nan"), 1.0, 1.0], 1), (8, [1.0, 2.0], 1), (9, [], 1), (10, [float("inf"), 1.0, 1.0], 1),
            (11, [-1.0, -2.0, -3.0], 1)]
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "1 as node", "2 as key", "3 as grid", "4 as n")
    assert result(near_vectors(df)) == brute(rows)
    assert result(near_vectors(df.limit(0))) == []
    nameless = near_vectors(spark.createDataFrame([(None, v, 1), (1, v, 1)], KIND)).collect()
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in nameless} == {(None, 0, None, False), (1, 0, 1, True)}


def test_large_cells_are_split(spark):
    rows = [(i, [float(np.float32(x)) for x in 5 + np.random.default_rng(i).standard_normal(16) * 0.05], 0)
            for i in range(120)]
    assert result(near_vectors(spark.createDataFrame(rows, KIND), block=16)) == brute(rows)


def test_count_is_calibrated():
    rng = np.random.default_rng(3)
    met = (abs(rng.standard_normal((20000, 32))) <= 2.0).sum(axis=1)
    assert (met >= least_count(32, 2.0, 0.002)).mean() >= 0.995
