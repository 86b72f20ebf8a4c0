"""Learned languages and phrase lists against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from foroscope.operators import gazetteer as gz
from foroscope.operators import language as lg

TEXTS = {"en": "the cat and the dog sat on the mat with that other thing", "fr": "le chat et le chien sont sur le tapis avec",
         "xx": "ჩემი 𝒜𝒜𝒜 სახლი დიდი არის"}


def rows(n=60):
    rng = random.Random(1)
    out = [(i, lang, " ".join(rng.choices(TEXTS[lang].split(), k=12)) + "!" * (i % 2)) for i, lang in enumerate(
        rng.choices(sorted(TEXTS), k=n))]
    return out + [(900, None, "the cat"), (901, "en", None), (902, "fr", "12 !"), (903, None, "")]


def grams(text):
    plain = " " + re.sub(r"[\W\d_]+", " ", (text or "").lower()).strip() + " "
    return [plain[i:i + 3] for i in range(len(plain) - 2)] if plain.strip() else []


def test_scores_and_detection(spark):
    data = rows()
    df = spark.createDataFrame(data, "id long, lang string, text string")
    profiles = lg.learn_profiles(df.filter("id % 3 <> 0"), "lang", "text")
    counts = {lang: Counter(g for i, x, t in data if x == lang and i % 3 for g in grams(t)) for lang in TEXTS}
    known = len(set().union(*counts.values()))
    want = {}
    for i, _, text in data:
        found = grams(text)
        for lang in TEXTS if found else ():
            total = sum(counts[lang].values()) + known
            want[i, lang] = sum(math.log((counts[lang][g] + 1) / total) for g in found) / len(found)
    got = {(r.id, r.language): r.score for r in lg.score_languages(df, "id", "text", profiles).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in want)
    found = {r.id: r.language for r in lg.detect(df, "id", "text", profiles).collect()}
    assert all(found[i] == lang for i, lang, _ in data if i < 900)
    assert [found[i] for i in (901, 902, 903)] == ["unknown"] * 3 and found[900] == "en" and len(found) == len(data)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("text is not null and lang is not null")
    profiles = lg.learn_profiles(docs.filter("doc_id % 5 <> 0"), "lang", "text")
    held = docs.filter("doc_id % 5 = 0")
    found = {r.doc_id: r.language for r in lg.detect(held, "doc_id", "text", profiles).collect()}
    want = {r.doc_id: r.lang for r in held.select("doc_id", "lang").collect()}
    assert sum(found[i] == want[i] for i in want) / len(want) >= 0.98


def test_majority_route(spark):
    rows = [("a", "fr"), ("a", "fr"), ("a", "en"), ("b", "de"), ("b", "en")]
    got = lg.majority_route(spark.createDataFrame(rows, "source string, language string"), "source", ["fr"]).collect()
    assert sorted(map(tuple, got)) == [("a", "fr", 66.7, "fr"), ("b", "de", 50.0, "en")]


def brute_mentions(texts, terms):
    listed = {}
    for term, label in terms:
        words = tuple(re.findall(r"\w+", (term or "").lower()))
        if words:
            listed[words] = min(label, listed.get(words, label))
    out = []
    for key, text in texts:
        words, at = re.findall(r"\w+", (text or "").lower()), 0
        while at < len(words):
            sizes = [n for n in sorted({len(w) for w in listed}, reverse=True) if tuple(words[at:at + n]) in listed and
                     at + n <= len(words)]
            if sizes:
                phrase = tuple(words[at:at + sizes[0]])
                out.append((key, at, sizes[0], " ".join(phrase), listed[phrase]))
                at += sizes[0]
            else:
                at += 1
    return sorted(out)


def test_longest_mentions(spark):
    rng = random.Random(8)
    words = "a b c d e".split()
    terms = [(" ".join(rng.choices(words, k=rng.randint(1, 5))), rng.choice("xyz")) for _ in range(40)]
    terms += [("A, b", "w"), ("", "x"), (None, "x"), ("...", "x"), ("New-York City", "place")]
    texts = [(i, " ".join(rng.choices([*words, "f", "g"], k=rng.randint(0, 60)))) for i in range(60)]
    texts += [(100, None), (101, "in new york, CITY of a"), (102, "a " * 30_000)]
    listed = gz.gazetteer(spark.createDataFrame(terms, "term string, label string"), "term", "label")
    got = gz.mentions(spark.createDataFrame(texts, "id long, text string").repartition(4), "id", "text", listed)
    assert sorted(map(tuple, got.collect())) == brute_mentions(texts, terms)
    nothing = gz.gazetteer(spark.createDataFrame([], "term string, label string"), "term", "label")
    assert gz.mentions(spark.createDataFrame(texts, "id long, text string"), "id", "text", nothing).count() == 0


def test_runs_and_grams_take_one_pass(spark):
    texts = ["", "one", "one two", "a b  c, d_e 𝒜𝒜 ß!", "x " * 40 + "y" * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").select(
        "id", "text", gz.tokens(F.col("text")).alias("t"), lg.letters(F.col("text")).alias("c"))
    out = df.select("text", *[gz.runs(F.col("t"), n).alias(f"r{n}") for n in (1, 2, 3)], lg.grams("c", 3).alias("g"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "slice(" not in plan
    for r in out.collect():
        t = re.findall(r"\w+", r.text.lower())
        for n in (1, 2, 3):
            assert r[f"r{n}"] == [" ".join(t[i:i + n]) for i in range(len(t) - n + 1)]
        assert (r.g or []) == grams(r.text)


def test_runs_are_sorted_by_their_hash(spark):
    listed = gz.gazetteer(spark.createDataFrame([("a b", "x"), ("c", "y")], "term string, label string"), "term", "label")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = gz.candidates(spark.createDataFrame([(1, "a b c")], "id long, text string"), "id", "text", listed)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin \[hash#", plan)
    assert sorted(map(tuple, found.collect())) == [(1, 0, 2, "a b", "x"), (1, 2, 1, "c", "y")]


@pytest.mark.parametrize("most", [1 << 28, 4096])
def test_only_marked_runs_are_shuffled(spark, monkeypatch, most):
    monkeypatch.setattr(gz, "MOST_BITS", most)
    listed = gz.gazetteer(spark.range(3000).selectExpr("concat('w', id, ' x') as term", "'l' as label"), "term", "label")
    table, parts = gz.marks(listed)
    assert parts == (16 if most > 4096 else 1) and table.count() == parts
    rows = spark.range(20_000).selectExpr("id", "xxhash64(concat('w', id, ' x')) as hash")
    kept = [r.id for r in gz.marked(rows, listed).collect()]
    assert {*range(3000)} <= {*kept} and len(kept) == len({*kept})
    if most > 4096:
        assert len(kept) < 3400  # some 85 others are expected
    texts = spark.createDataFrame([(1, "w1 x w3001 x"), (2, "w2999 x"), (3, "w1 w2")], "id long, text string")
    found = gz.candidates(texts, "id", "text", listed)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "getbit" in plan or "bit_get" in plan
    assert sorted(map(tuple, found.collect())) == [(1, 0, 2, "w1 x", "l"), (2, 0, 2, "w2999 x", "l")]
