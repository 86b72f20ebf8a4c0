import hashlib
import re
from collections import defaultdict

import pytest
from check import compare, connect
from conftest import SF
from pyspark.sql import functions as F

from foroscope.llm import exact
from foroscope.llm.exact import exact_dedup, kept_documents

from .conftest import ODD

LAST = 2**63 - 1


def brute(rows):
    """Groups by whole texts; the first row of the smallest id stays."""
    groups = defaultdict(list)
    for doc, text in rows:
        groups[re.sub("[ \t\n\x0b\x0c\r]+", " ", text or "")].append(LAST if doc is None else doc)
    out = []
    for text, ids in groups.items():
        keep = min(ids)
        for i, doc in enumerate(sorted(ids)):
            out.append((None if doc == LAST else doc, None if keep == LAST else keep, len(ids), i == 0,
                        hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_sql(spark):
    ok, message, _ = compare(spark, connect(SF), "op12",
                             lambda s, d: exact_dedup(s.read.parquet(f"{d}/documents.parquet")), exact.ORACLE, SF)
    assert ok, message


def test_odd_rows(frame):
    assert result(exact_dedup(frame(ODD))) == brute(ODD)
    assert result(exact_dedup(frame([]))) == []


def test_blanks_case_and_wide_spaces(frame):
    rows = [(9, "a  b"), (8, "a\n\tb"), (7, "A b"), (6, "a b "), (5, "a b"), (4, "a b"), (3, " a b"), (2, "a b")]
    assert result(exact_dedup(frame(rows))) == brute(rows)


@pytest.mark.parametrize("digest", [lambda t: F.substring(F.md5(t), 1, 1), lambda t: F.lit("x")])
def test_texts_that_share_a_digest_stay_apart(frame, digest):
    rows = ODD + [(i, f"text number {i % 40}") for i in range(10, 200)]
    assert result(exact_dedup(frame(rows), digest=digest)) == brute(rows)


def test_large_group_of_copies_and_long_texts(frame):
    rows = [(i, "the same text") for i in range(900)] + [(i, f"own text {i}") for i in range(900, 1500)]
    rows += [(None, "the same text")] * 300 + [(5000 + i, "long " * 60_000 + "x" * (i % 2)) for i in range(4)]
    assert result(exact_dedup(frame(rows).repartition(7))) == brute(rows)


def test_many_repeats_of_one_row(frame, monkeypatch):
    monkeypatch.setattr(exact, "STRETCH", 16)
    rows = [(None, "no id")] * 100 + [(3, "id")] * 33 + [(3, "other")] * 16
    assert result(exact_dedup(frame(rows))) == brute(rows)


def test_kept_texts(frame):
    kept = kept_documents(frame([(2, "a  b"), (1, "a b"), (3, None)])).collect()
    assert sorted(map(tuple, kept)) == [(1, "a b", 2), (3, "", 1)]


def test_native_plan_without_python(spark):
    plan = exact_dedup(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
