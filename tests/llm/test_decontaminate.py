import re

import pytest
from check import compare, connect
from conftest import SF

from foroscope.llm import decontaminate
from foroscope.llm.decontaminate import benchmark_overlap, search_benchmark, stage_decontaminate

from .conftest import ODD

LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(LETTERS, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, window=13):
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for item, other in items:
            v = words(other)
            n = min(len(v), window)
            wins = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if v else set()
            for i in range(len(w) - n + 1):
                if v and tuple(w[i:i + n]) in wins:
                    hit.update(range(i, i + n))
                    found.add(item)
        found.discard(None)
        out.append((doc, len(w), len(hit), len(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def bench(spark):
    def make(items):
        return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as id", "'t' as item")
    return make


def test_sql(spark):
    ok, message, _ = compare(spark, connect(SF), "op4", lambda s, d: benchmark_overlap(
        s.read.parquet(f"{d}/documents.parquet"), s.read.parquet(f"{d}/benchmark.parquet")), decontaminate.ORACLE, SF)
    assert ok, message


def test_odd_rows(frame, bench):
    long = " ".join(f"Wörd{i}" for i in range(30))
    rows = [*ODD, (10, long), (11, "x " + long.upper().replace("Ö", "ö") + " y " * 500), (12, "short item"), (13, long[:60]),
            (14, "a short, ITEM! a short item")]
    items = [(1, long), (2, "short item"), (2, "short item"), (3, None), (4, "..."), (None, "no id at all")]
    assert result(benchmark_overlap(frame(rows), bench(items))) == brute(rows, items)
    assert result(benchmark_overlap(frame(rows), bench([]))) == brute(rows, [])
    assert result(benchmark_overlap(frame([]), bench(items))) == []


def test_blocks_of_the_benchmark_and_small_shards(frame, bench, monkeypatch):
    items = [(i, " ".join(f"w{(i * 7 + k) % 40}" for k in range(3 + i))) for i in range(30)]
    rows = [(i, " ".join(f"w{(i * 3 + k) % 40}" for k in range(i * 2))) for i in range(40)]
    got = search_benchmark(frame(rows), bench(items), block_bytes=200).withColumnRenamed("id", "doc_id")
    assert result(got) == brute(rows, items)


def test_longest_stretch(frame, bench):
    item = " ".join(f"w{i}" for i in range(20))
    got = search_benchmark(frame([(1, f"a b {item} c")]), bench([(7, item)])).first()
    assert (got.longest, got.longest_at, got["items"]) == (20, 2, ["7"])


def test_stage(spark, tmp_path, frame, bench):
    item = " ".join(f"w{i}" for i in range(20))
    bench([(7, item)]).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = frame([(1, item), (2, "clean text"), (3, item + " filler" * 1000), (4, None)])
    assert sorted(r.doc_id for r in stage_decontaminate(spark, docs, str(tmp_path)).collect()) == [2, 3, 4]
