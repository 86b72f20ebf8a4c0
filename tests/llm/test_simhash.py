import re

import numpy as np
import xxhash
from conftest import SF

from foroscope.llm.simhash import (exact_masks, fingerprint, forest, grow_forest, near_neighbours, pack_bits,
                                   shingle_hashes, shortest_forest, simhash_groups, stage_simhash, stars)

from .conftest import ODD


def brute(rows, width=4):
    prints = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0)
    ids = [2**63 - 1 if i is None else i for i, _ in rows]
    label = ids[:]
    changed = True
    while changed:
        changed = False
        for a in range(len(rows)):
            low = min(label[b] for b in range(len(rows)) if (prints[a] ^ prints[b]).bit_count() <= 4)
            changed |= low != label[a]
            label[a] = low
    return sorted(((i, "%016x" % p, None if c == 2**63 - 1 else c) for (i, _), p, c in zip(rows, prints, label,
                                                                                       strict=True)), key=str)


def result(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_brute_force(spark, frame):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(simhash_groups(frame(rows))) == brute(rows)


def test_odd_rows(frame):
    assert result(simhash_groups(frame(ODD))) == brute(ODD)
    assert result(simhash_groups(frame([]))) == []


def test_exact_masks_find_every_close_pair():
    rng = np.random.default_rng(1)
    masks = exact_masks(4, 3)
    for _ in range(2000):
        flips = rng.choice(64, 4, replace=False)
        difference = sum(1 << int(b) for b in flips)
        assert any(difference & (m[0] % 2**64) == 0 for m in masks)


def test_bit_slices_match_popcounts():
    rng = np.random.default_rng(2)
    for words, radius in ((1, 4), (4, 48)):
        base = rng.integers(0, 2**63, (70, words)).astype(np.uint64)
        near = base[:40] ^ (np.uint64(1) << rng.integers(0, 64, (40, words)).astype(np.uint64))
        prints = np.concatenate([base, near, near[:20]])
        close = np.bitwise_count(prints[:, None, :] ^ prints[None, :, :]).sum(axis=2) <= radius
        a, b = np.nonzero(np.triu(close, 1))
        group = np.repeat(np.arange(13), 10)
        got = set(zip(*(x.tolist() for x in near_neighbours(prints, group, radius)), strict=True))
        assert got == {(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True) if group[i] == group[j]}
        want = {tuple(x) for x in stars(a, b, len(prints)).tolist()}
        assert {tuple(x) for x in forest(prints, radius).tolist()} == want


def test_bits_are_a_majority():
    assert fingerprint(np.array([1, 3, 2], np.uint64)) == [3]
    assert fingerprint(np.array([1, 2], np.uint64)) == [0]
    assert fingerprint(shingle_hashes(b"", 4)) == [0]


def test_stage_keeps_one_of_near_copies(spark, frame):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(4000)]
    base = [list(rng.choice(words, 300)) for _ in range(12)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    for i, b in enumerate(base[:6]):
        copy = list(b)
        for at in rng.choice(300, 4, replace=False):  # similarity of five-word shingles about 0.88
            copy[at] = "changed"
        rows.append((100 + i, " ".join(copy)))
    rows += [(200, rows[0][1]), (None, rows[1][1]), (300, ""), (301, None), (302, "")]
    kept = stage_simhash(spark, frame(rows), "")
    assert kept.columns == frame(rows).columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([*range(12), None, 300, 301, 302], key=str)


def test_stage_against_exact_similarity(spark, frame):
    rng = np.random.default_rng(7)
    rows = []
    for k in range(40):  # pairs of 0.55 to 0.95 at two lengths
        n = (400, 60)[k % 2]
        base = [f"a{k}x{i}" for i in range(n)]
        new = round(n * rng.uniform(0.02, 0.3))
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(base[:n - new] + [f"b{k}x{i}" for i in range(new)]))]
    rows += [(200, "p q r s t u v w"), (201, "p q r s t u v y")]  # three of five shingles
    for i in range(3):  # one shingle holds most places
        rows.append((300 + i, " ".join(["na"] * 200 + [f"c{i}x{j}" for j in range(60)])))
    chain = [f"d{i}" for i in range(400)]  # a link that fails beside others that hold
    rows += [(400 + i, " ".join(chain[30 * i:30 * i + 280])) for i in range(5)]
    sets = {}
    for doc, text in rows:
        w = text.split()
        sets[doc] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    label = {d: d for d in sets}
    for _ in range(10):
        for a in sets:
            label[a] = min(label[b] for b in sets if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    kept = {r.doc_id for r in stage_simhash(spark, frame(rows), "").collect()}
    assert kept == {d for d in label if label[d] == d} and 10 < len(kept) < len(rows) - 10


def test_stage_decides_each_text_of_a_repeated_id(spark, frame):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (2, a), (2, b), (3, b + " more"), (4, a), (4, a + " more"), (5, "alone " + "x " * 20)]
    kept = sorted((r.doc_id, r.text) for r in stage_simhash(spark, frame(rows), "").collect())
    assert kept == sorted([(1, a), (2, b), (5, rows[-1][1])])


def test_stage_in_a_dense_group_with_failing_links(spark, frame, monkeypatch):
    """Copies of one base that are alike to it, not to each other, beside chains of both kinds."""
    rng = np.random.default_rng(3)
    base = [f"a{i}" for i in range(300)]
    rows = [(1000, " ".join(base))]
    for i in range(150):  # 0.88 to the base, about 0.78 to each other
        copy = list(base)
        for at in rng.choice(60, 4, replace=False):
            copy[5 * at] = f"c{i}x{at}"
        rows.append((i, " ".join(copy)))
    sets = {}
    for doc, text in rows:
        w = text.split()
        sets[doc] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    label = {d: d for d in sets}
    for _ in range(5):
        for x in sets:
            label[x] = min(label[y] for y in sets if len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]))
    want = {d for d in label if label[d] == d}
    kept = {r.doc_id for r in stage_simhash(spark, frame(rows), "").collect()}
    assert kept == want


def test_forests_are_shortest_and_connect_the_same():
    rng = np.random.default_rng(11)
    for _ in range(30):
        n = 60
        centre = rng.integers(0, 2**63, (1, 4)).astype(np.uint64)
        prints = np.repeat(centre, n, axis=0)
        for row in prints:
            for bit in rng.choice(256, rng.integers(0, 40), replace=False):
                row[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
        d = np.bitwise_count(prints[:, None, :] ^ prints[None, :, :]).sum(axis=2)
        a, b = np.nonzero(np.triu(d <= 32, 1))
        weight, label = d[a, b].astype(np.int64), rng.integers(0, 45, n)
        label = np.unique(label, return_inverse=True)[1]
        chosen = shortest_forest(a, b, weight, label)
        near = np.array([pack_bits((d[i] <= 32) & (np.arange(n) != i)) for i in range(n)])
        links = grow_forest(prints, near, label)

        def groups(pairs):
            own = label.copy()
            for i, j in pairs:
                own[own == own[j]] = own[i]
            return [np.flatnonzero(own == x).tolist() for x in sorted(set(own), key=lambda x: own.tolist().index(x))]

        every = groups(zip(a, b, strict=True))
        assert groups(zip(a[chosen], b[chosen], strict=True)) == every == groups(links)
        assert sum(d[i, j] for i, j in links) == weight[chosen].sum() and len(links) == len(chosen)
