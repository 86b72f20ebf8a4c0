import hashlib
import re
from collections import defaultdict

import pytest
from check import compare, connect
from conftest import SF

from foroscope.llm import lines
from foroscope.llm.lines import apply_bitmaps, keep_bitmaps, line_dedup, stream_first

from .conftest import ODD

LAST = 2**63 - 1


def brute(rows):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(LAST if doc is None else doc)
    out = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if len(key(x)) < 10 or min(holders[key(x)]) == (LAST if doc is None else doc)]
        out.append((doc, len(all_lines), len(all_lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect()), key=str)


def test_sql(spark):
    ok, message, _ = compare(spark, connect(SF), "op10", lambda s, d: line_dedup(s.read.parquet(f"{d}/documents.parquet")),
                             lines.ORACLE, SF)
    assert ok, message


def test_odd_rows(frame):
    assert result(line_dedup(frame(ODD))) == brute(ODD)
    assert result(line_dedup(frame([]))) == []


def test_hot_line_over_partitions(spark, frame):
    rows = [(i, f"a line that every document has\nown line number {i} here\n" + "y" * (i % 7)) for i in range(400)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        assert result(line_dedup(frame(rows).repartition(9))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_columns_stay_and_bitmaps_are_small(frame):
    docs = frame([(1, "the same long line\nx"), (2, "the same long line\ny")])
    cleaned = apply_bitmaps(docs, keep_bitmaps(docs))
    assert set(docs.columns) <= set(cleaned.columns)
    assert {r.doc_id: r.text for r in cleaned.collect()} == {1: "the same long line\nx", 2: "y"}
    assert keep_bitmaps(docs).count() == 1


@pytest.mark.parametrize("cut", range(1, 12))
def test_stream_does_not_depend_on_batches(cut):
    import pyarrow as pa

    rows = sorted([(h, 0, d, 0, p) for h, docs in ((1, [3, 3, 4]), (2, [1]), (5, [2, 2, 7, 9]), (6, [1, 8]))
                   for p, d in enumerate(docs)])
    table = pa.Table.from_pylist([dict(zip(lines.LINES.names, r, strict=True)) for r in rows], lines.LINES)
    whole = pa.Table.from_batches(stream_first(table.to_batches()), lines.FOUND).to_pylist()
    parts = pa.Table.from_batches(stream_first(table.to_batches(max_chunksize=cut)), lines.FOUND).to_pylist()

    def order(r):
        return tuple(r.values())

    assert sorted(whole, key=order) == sorted(parts, key=order)
    assert [(r["h1"], r["id"]) for r in whole if r["kind"] == lines.DROP] == [(5, 7), (5, 9), (6, 8)]
