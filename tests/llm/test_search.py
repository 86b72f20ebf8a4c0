import math
import random
import re
from collections import Counter

import pytest
from check import compare, connect
from conftest import SF

from foroscope.llm import search
from foroscope.llm.search import ranked_search, search_documents, share

from .conftest import ODD

LAST = 2**63 - 1


def terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(rows, items, k=10):
    counts = [(LAST if d is None else d, Counter(terms(t))) for d, t in rows if terms(t)]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    held = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for doc, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) *
                        (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, doc))
        out += [(item, i + 1, None if d == LAST else d, -s) for i, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.select("item", "rank", search.id_text("id"), "score").collect()), key=str)


@pytest.fixture
def queries(spark):
    def make(items):
        return spark.createDataFrame(items, "item_id string, text string").selectExpr("*", "1 as id", "'x' as term",
                                                                                     "2 as block", "3 as rank")
    return make


def test_sql(spark):
    def query(s, d):
        return ranked_search(s.read.parquet(f"{d}/documents.parquet"), s.read.parquet(f"{d}/benchmark.parquet"))

    ok, message, _ = compare(spark, connect(SF), "op13", query, search.ORACLE, SF)
    assert ok, message


def test_odd_rows(frame, queries):
    items = [("a", "One line, that is HERE twice"), ("b", None), ("c", ""), ("d", "..."), (None, "no id"),
             ("a", "another text"), ("a", "another text"), ("e", "unknownword")]
    assert result(search_documents(frame(ODD), queries(items))) == brute(ODD, items)
    assert result(search_documents(frame([]), queries(items))) == []
    assert result(search_documents(frame(ODD), queries([]))) == []
    assert result(search_documents(frame([(1, None), (2, "--")]), queries(items))) == []


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["été", "naïve_x", "don't", "日本", "A1"]
    weights = [1 / (i + 1) for i in range(len(words))]

    def text(size):
        return " ".join(rng.choices(words, weights, k=size))

    docs = [(i, text(rng.randint(0, 60))) for i in range(n)]
    items = [(f"q{i}", text(rng.randint(1, 25))) for i in range(30)]
    return docs + docs[:20] + [(None, docs[0][1])], items + [("copy", items[0][1])]


@pytest.mark.parametrize("block_bytes", [1 << 20, 300, 1])
def test_blocks_of_any_size_and_chunks_agree(frame, queries, monkeypatch, block_bytes):
    monkeypatch.setattr(search, "CELLS", 1 if block_bytes == 300 else 1 << 22)
    monkeypatch.setattr(search, "WORDS", 200 if block_bytes == 300 else 1 << 21)
    docs, items = corpus(150, 7)
    if block_bytes == 1:
        items = items[:3]
    found = search_documents(frame(docs).repartition(3), queries(items), block_bytes=block_bytes)
    assert result(found) == brute(docs, items)


def test_large_group_of_equal_documents_and_a_very_long_one(frame, queries):
    docs = [(i, "the same words again") for i in range(2000, 0, -1)] + [(3000, "the " * 80_000 + "rare")]
    items = [("x", "same the"), ("y", "rare"), ("z", "the")]
    assert result(search_documents(frame(docs).repartition(4), queries(items))) == brute(docs, items)


def test_sharing_keeps_every_list_and_saves_work():
    rng = random.Random(3)
    for _ in range(50):
        atoms = rng.randint(1, 30)
        lists = [sorted(rng.sample(range(atoms), rng.randint(0, atoms))) for _ in range(rng.randint(1, 12))]
        short, sums = share([list(x) for x in lists], atoms)

        def spread(node, sums=sums, atoms=atoms):
            return [node] if node < atoms else [x for part in sums[node - atoms] for x in spread(part)]

        assert [sorted(x for n in nodes for x in spread(n)) for nodes in short] == lists
        assert sum(map(len, short)) + 2 * len(sums) <= sum(map(len, lists)) + len(sums)
        used = Counter(n for nodes in short for n in nodes)
        for i in reversed(range(len(sums))):  # every list that uses a sum uses its parts
            for part in sums[i]:
                used[part] += used[atoms + i]
        assert all(used[atoms + i] >= 2 for i in range(len(sums)))


def test_items_that_share_a_passage_share_its_sum():
    lists, sums = share([list(range(8)), list(range(8)), [*range(8), 9]], 10)
    assert len(sums) == 7 and [len(x) for x in lists] == [1, 1, 2]
