import itertools
import random

import pytest

from foroscope.operators import identity as idn


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def brute(users):
    forums = sorted({f for f, _ in users})
    out = set()
    for fa, fb in itertools.combinations(forums, 2):
        for ha in {h for f, h in users if f == fa}:
            scored = sorted(((-2 * lcs(ha, hb) / (len(ha) + len(hb)), hb) for hb in {h for f, h in users if f == fb}))
            if scored and 200 * lcs(ha, scored[0][1]) >= 85 * (len(ha) + len(scored[0][1])) and scored[0][1] != ha:
                out.add((ha, fa, scored[0][1], fb, round(-scored[0][0], 3)))
    return out


def variants(rng, n, alphabet="ab1_", lengths=(4, 14)):
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(*lengths))) for _ in range(n)]
    out = set(base)
    for h in base:
        i = rng.randrange(len(h))
        out.add(h[:i] + rng.choice(alphabet) + h[i + 1:])
        out.add(h[:i] + h[i + 1:])
    return sorted(x for x in out if x)


def run(spark, users):
    df = spark.createDataFrame(users, "forum string, username string")
    return {(r.handle_a, r.forum_a, r.handle_b, r.forum_b, r.similarity) for r in idn.fuzzy_handles(df).collect()}


def test_fuzzy_equals_brute_force(spark):
    rng = random.Random(5)
    users = [(rng.choice("ABC"), h) for h in variants(rng, 60)]
    assert run(spark, users) == brute(users)


def test_segment_blocking_loses_nothing(monkeypatch):
    monkeypatch.setattr(idn, "MAX_VARIANTS", 0)
    rng = random.Random(9)
    handles = variants(rng, 80, "abcdef0_", (5, 30))
    for a in handles[:90]:
        keys = set(idn.blocking_keys(a, True))
        for b in handles:
            if 200 * lcs(a, b) >= 85 * (len(a) + len(b)):
                assert keys & set(idn.blocking_keys(b, False)), (a, b)


@pytest.mark.parametrize("a,b", [("hacker99", "hacker_99"), ("abc", "abd"), ("x", "x"), ("", "a"), ("áñb", "anb")])
def test_common_length(a, b):
    assert idn.common_length(a, b) == lcs(a, b)


def test_threshold_and_exact_best(spark):
    users = [("A", "aaaabbbbccccd"), ("B", "aaaabbbbccccdeeee"), ("A", "same_name"), ("B", "same_name"), ("B", "same_nam3"),
             ("A", "abcdefg"), ("B", "abcdef")]
    got = run(spark, users)
    assert ("abcdefg", "A", "abcdef", "B", 0.923) in got
    assert all(x[0] != "same_name" for x in got)  # the best hit is the same handle
    assert ("aaaabbbbccccd", "A", "aaaabbbbccccdeeee", "B", 0.867) in got


def test_exact_pairs_and_candidates(spark):
    rows = [("A", "1", "neo_x"), ("B", "2", "neo_x"), ("C", "3", "neo_x"), ("A", "4", "abc"), ("B", "5", "abc"),
            ("A", "6", "trinity1"), ("B", "7", "trinity2")]
    users = spark.createDataFrame(rows, "forum string, userid string, username string")
    assert [r.username for r in idn.exact_handles(users).collect()] == ["neo_x"]
    got = idn.candidates(users, idn.fuzzy_handles(users)).collect()
    assert sum(r.match_type == "exact" for r in got) == 4
    assert {(r.handle_a, r.handle_b) for r in got if r.match_type == "fuzzy"} == {("trinity1", "trinity2")}


def test_convergence_counts_signals(spark):
    rows = [("a", "b", 0.5, 0.9, 0.8), ("a", "c", 1.5, 0.2, 0.75), ("b", "c", 1.0, 0.85, 0.1)]
    df = spark.createDataFrame(rows, "user_a string, user_b string, delta double, handle_sim double, embedding_sim double")
    got = {(r.user_a, r.user_b): (r.n_signals, r.combined) for r in idn.convergence(df).collect()}
    assert got["a", "b"] == (2, pytest.approx((0.9 + 1 + 0.8) / 3, abs=1e-6))
    assert got["a", "c"] == (1, pytest.approx((0.2 + 0 + 0.75) / 3, abs=1e-6))
    assert got["b", "c"][0] == 1


def test_actor_table_builds_the_public_graph_once(spark, monkeypatch):
    from conftest import SF

    from foroscope.operators import edges as ed
    from foroscope.plans.identity import actor_table

    built, build = [], ed.copart_edges
    monkeypatch.setattr(ed, "copart_edges", lambda *a, **k: built.append(1) or build(*a, **k))
    assert actor_table(spark, SF).count() > 0 and len(built) == 1
