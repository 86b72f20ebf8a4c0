import hashlib
import zlib
from collections import defaultdict

import pytest
from check import compare, connect
from conftest import SF

from foroscope.llm import merkle
from foroscope.llm.merkle import manifest, merkle_manifest, missing

from .conftest import ODD

LAST = 2**63 - 1


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def prove(nodes, place):
    """Siblings from a level of nodes to its root, as (left, right) pairs, and the root."""
    out = []
    while len(nodes) > 1:
        run = place - place % 3
        out.append((nodes[run:place], nodes[place + 1:run + 3]))
        nodes = [digest(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        place //= 3
    return out, nodes[0]


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)"""
    sources = defaultdict(list)
    for doc, text, lang, source, n in rows:
        def leaf(t, doc=doc, lang=lang, source=source, n=n):
            return digest(*map(field, (doc, source, lang, n, t)))

        bad = text
        if text is not None and doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0:
            bad = text.replace("\n", "")
        sources[source].append((LAST if doc is None else doc, leaf(text), leaf(bad)))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    subroots = [prove([x[1] for x in sorted(sources[s])], 0)[1] for s in order]
    out = []
    for i, source in enumerate(order):
        leaves = sorted(sources[source])
        upper, root = prove(subroots, i)
        for place, (doc, own, bad) in enumerate(leaves):
            lower, subroot = prove([x[1] for x in leaves], place)
            node, proof = bad, []
            for left, right in lower + upper:
                proof += left + right
                node = digest(*left, node, *right)
            out.append((None if doc == LAST else doc, own, subroot, root, digest(*proof), node, node == root))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                       "verified").collect()), key=str)


def plain(rows):
    rows = [(*r, *[None] * (4 - len(r))) for r in rows]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows]


def test_sql(spark):
    ok, message, _ = compare(spark, connect(SF), "op11",
                             lambda s, d: merkle_manifest(s.read.parquet(f"{d}/documents.parquet")), merkle.ORACLE, SF)
    assert ok, message


def test_odd_rows(frame):
    assert result(merkle_manifest(frame(ODD))) == brute(plain(ODD))
    assert result(merkle_manifest(frame([]))) == []


@pytest.mark.parametrize("sizes", [[1], [1, 1], [1, 2, 3, 4], [9, 10, 28, 1], [1] * 14, [100, 1, 1, 3, 82]])
def test_tree_shapes(frame, monkeypatch, sizes):
    monkeypatch.setattr(merkle, "SPAN_ROWS", 7)
    rows, doc = [], 0
    for i, n in enumerate(sizes):
        for _ in range(n):
            doc += 1
            rows.append((doc * 7 % 1000, f"text\n{doc}", "en" if doc % 3 else None, None if i == 0 else f"source {chr(233 + i)}"))
    assert result(merkle_manifest(frame(rows))) == brute(plain(rows))


def test_blocks_of_any_depth_give_the_same_tree(frame):
    rows = [(i, f"t\n{i}", None, "a" if i % 5 else "b") for i in range(300)]
    want = brute(plain(rows))
    for depth in (1, 2, 8):
        proofs = manifest(frame(rows), merkle.without_newlines(), depth)["proofs"]
        assert result(proofs.withColumnRenamed("id", "doc_id")) == want


def test_hot_source_repeated_rows_and_missing_ids(frame):
    rows = [(i, f"text {i}", None, "hot") for i in range(700)] + [(i, "x\ny", None, f"s{i}") for i in range(300)]
    rows += [(None, "same", None, "hot")] * 200 + [(5, "same\n", None, "hot")] * 100
    assert result(merkle_manifest(frame(rows).repartition(5))) == brute(plain(rows))


def test_fetched_nodes_are_the_minimal_union():
    """Against marking: a node is fetched if some leaf's proof needs it and no leaf of the span derives it."""
    for size in (1, 2, 3, 10, 27, 28, 100):
        for first in range(size):
            for end in range(first + 1, size + 1):
                needed, level, n, known = set(), 0, size, set(range(first, end))
                while n > 1:
                    for p in known:
                        needed |= {(level, q) for q in range(p - p % 3, min(p - p % 3 + 3, n)) if q not in known}
                    level, n, known = level + 1, -(-n // 3), {p // 3 for p in known}
                got = {(lv, p) for lv, _, _, places in missing(first, end, size) for p in places}
                # siblings that fetched nodes complete are derived above
                assert got == needed


def test_tampering_is_found_everywhere_it_happened(frame):
    docs = frame([(i, "a\nb" if i % 2 else "ab", None, f"s{i % 3}") for i in range(60)])
    for row in merkle_manifest(docs).collect():
        changed = zlib.crc32(str(row.doc_id).encode()) % 2 == 0 and row.doc_id % 2 == 1
        assert row.verified == (not changed) and (row.folded_root == row.root) == row.verified
