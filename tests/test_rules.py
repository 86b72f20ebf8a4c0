"""Edge rows for the rules that pandas and SQL treat differently."""

import datetime as dt
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from foroscope.functions import ranking as rk
from foroscope.functions import stats as st
from foroscope.functions import text as tf
from foroscope.functions import vectors as vf
from foroscope.functions.wordlists import FUNCTION_WORDS
from foroscope.operators import activity as ac
from foroscope.operators import clean as cl
from foroscope.operators import enrich as en
from foroscope.operators import report as rp
from foroscope.operators import sample as sp
from foroscope.operators import texts as tx
from foroscope.operators import vectors as vx
from foroscope.plans import QUERIES
from conftest import SF


def test_clean_users(spark):
    rows = [("f", "1", " ADMIN ", dt.datetime(1970, 1, 1), "\tME@x \n"), ("f", "2", "admin", dt.datetime(2000, 1, 1), ""),
            ("f", "3", None, None, None)]
    df = spark.createDataFrame(rows, "forum string, userid string, username string, joindate timestamp, contact string")
    got = {r.userid: (r.username, r.joindate, r.contact, r.username_raw) for r in cl.clean_users(df).collect()}
    assert got == {"1": ("admin", None, "me@x", " ADMIN "), "2": ("admin", dt.datetime(2000, 1, 1), None, "admin"),
                   "3": (None, None, None, None)}


def test_flags_and_labels(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 12, 31, 23), "  abcd "), (dt.datetime(2026, 1, 1), "abcde"), (None, None)],
                               "dateline timestamp, pagetext string")
    assert [(r.dateline_valid, r.text_valid) for r in cl.flag_posts(df).collect()] == [
        (True, False), (False, True), (False, False)]
    words = spark.createDataFrame([("Sales, maybe",), ("it is sales.",), ("",), (None,)], "t string")
    got = [(r.a, r.b) for r in words.select(cl.canonical_label("t", ["sales"]).alias("a"),
                                            cl.canonical_label("t", ["sales"], True).alias("b")).collect()]
    assert got == [("sales", "sales"), ("unknown", "sales"), ("unknown", "unknown"), ("unknown", "unknown")]


def test_strip_markup_and_local_part(spark):
    df = spark.createDataFrame([("<p>a&amp;b</p><script>x<y\n</script> [b]c[/b] https://u.example/x  d", "!r:host", "me@h")],
                               "h string, room string, mail string")
    row = df.select(tf.strip_markup("h").alias("h"), tf.local_part("room").alias("r"), tf.local_part("mail").alias("m")).first()
    assert tuple(row) == ("a&b c d", "r", "me")
    cases = {'[quote name="x" date="y"]q[/quote]': "q", "[h1]t[/h1]": "t", "it&#8217;s": "it\u2019s", "&#x2014;": "\u2014",
             "caf&eacute;&nbsp;x": "caf\u00e9 x", "&amp;eacute; &lt;b&gt;": "&eacute; <b>", "&bogus; &#0;": "&bogus; &#0;"}
    got = spark.createDataFrame([(k,) for k in cases], "h string").select("h", tf.strip_markup("h").alias("p")).collect()
    assert {r.h: r.p for r in got} == cases


def hours(spark, rows):
    return spark.createDataFrame([(u, dt.datetime(2024, 1, 1 + i % 28, h)) for i, (u, h) in enumerate(rows)],
                                 "userid string, dateline timestamp")


def brute_offset(hs):
    if len(hs) < 5:
        return None
    score = {o: sum(8 <= (h + o) % 24 <= 23 for h in hs) for o in range(-12, 13)}
    return max(score, key=lambda o: (score[o], -o))


def test_utc_offset(spark):
    rng = random.Random(1)
    users = {"few": [3] * 4, "one_hour": [3] * 5, "flat": list(range(24)), "edge": [7, 7, 8, 23, 0, 15, 16]}
    users |= {f"r{i}": [rng.choice([2, 3, 4, 20, 21]) for _ in range(9)] for i in range(6)}
    df = hours(spark, [(u, h) for u, hs in users.items() for h in hs])
    got = {r.userid: r.utc_offset for r in ac.tz_profile(df).collect()}
    assert got == {u: brute_offset(hs) for u, hs in users.items()}
    assert got["flat"] == -12
    peaks = {r.userid: r.peak_hours for r in ac.peak_hours(df).collect()}
    assert peaks["one_hour"] == [3, 0, 1] and peaks["flat"] == [0, 1, 2]


def test_series_filled_and_constant(spark):
    days = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 17)]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp")
    assert ac.period_counts(df, "t", "week").count() == 2
    weeks = {r.period.day: r.posts for r in ac.filled_counts(df, "t", "week").collect()}
    assert weeks == {1: 2, 8: 0, 15: 1}
    flat = spark.createDataFrame([(d,) for d in days[1:]], "t timestamp")
    assert [(r.z, r.spike) for r in ac.spikes(flat, "t").collect()] == [(None, False)] * 2


@pytest.mark.parametrize("size", [3, 5, 6, 17, 100])
def test_even_time_sample(spark, size):
    rows = [("u", i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i)) for i in range(size)]
    df = spark.createDataFrame(rows, "userid string, postid int, dateline timestamp")
    got = sorted(r.postid for r in sp.even_time_sample(df, 5).collect())
    assert got == (list(range(size)) if size <= 5 else [int(i * size / 5) for i in range(5)])


def test_samples_are_subsets_and_repeat(spark):
    df = spark.range(1000).selectExpr("id", "case when id < 700 then 'hot' else cast(id % 4 as string) end as section")
    quota = sp.quota_sample(df, "section", "id", 20)
    assert {r["section"]: r["count"] for r in quota.groupBy("section").count().collect()} == dict.fromkeys(
        ["hot", "0", "1", "2", "3"], 20)
    assert sorted(quota.collect()) == sorted(sp.quota_sample(df.repartition(3), "section", "id", 20).collect())
    strat = {r["section"]: r["count"] for r in sp.stratified_sample(df, "section", "id", 100).groupBy("section").count().collect()}
    assert strat["hot"] == 70 and sum(strat.values()) <= 100


def test_exact_quantiles_large_skewed(spark):
    rows = spark.range(60000).selectExpr(
        "case when id % 3 = 0 then 'hot' else cast(id % 7 as string) end as k",
        "case when id % 5 = 0 then 1.5 else cast((id * 7919) % 50021 as double) end as v")
    got = {(r.k, r.prob): r.quantile for r in st.exact_quantiles(rows, ["k"], "v", [0.01, 0.5, 0.9], accuracy=500).collect()}
    import duckdb

    want = duckdb.sql("""with r as (select case when id % 3 = 0 then 'hot' else cast(id % 7 as varchar) end as k,
      case when id % 5 = 0 then 1.5 else ((id * 7919) % 50021)::double end as v from range(60000) t(id))
      select k, p, case p when 0.01 then quantile_cont(v, 0.01) when 0.5 then quantile_cont(v, 0.5)
        else quantile_cont(v, 0.9) end from r, (values (0.01), (0.5), (0.9)) x(p) group by k, p""").fetchall()
    for k, p, q in want:
        assert got[k, float(p)] == pytest.approx(q)


def test_rank_in_groups_with_outliers(spark):
    rows = [("hot", i, 10 ** 12 if i == 0 else i) for i in range(500)] + [("b", 1, 5), ("b", 2, 5)]
    df = spark.createDataFrame(rows, "k string, id long, v long")
    got = rk.rank_in_groups(df, ["k"], ["v", "id"], rk.range_bucket(df, "v"))
    ranks = {(r.k, r.id): (r.rank0, r.group_size) for r in got.collect()}
    assert ranks["hot", 0] == (499, 500) and ranks["hot", 1] == (0, 500) and ranks["b", 2] == (1, 2)


def test_average_rank_and_spearman_identity(spark):
    df = spark.createDataFrame([(x,) for x in [3.0, 1.0, 3.0, 2.0]], "x double")
    assert sorted((r.x, r.rk) for r in st.average_rank(df, "x", "rk").collect()) == [(1.0, 1.0), (2.0, 2.0), (3.0, 3.5), (3.0, 3.5)]
    pairs = spark.createDataFrame([(f"a{i}", f"a{j}", float(i * j % 7)) for i in range(6) for j in range(i)],
                                  "user_a string, user_b string, similarity double")
    assert vx.spearman(pairs, pairs, "same", min_shared=5).first().spearman_rho == 1.0
    assert vx.spearman(pairs, pairs, "same").count() == 0


def test_vectors_zero_identical_single(spark):
    rows = [("a", "g", [0.0, 0.0]), ("b", "g", [1.0, 1.0]), ("c", "h", [2.0, 2.0])]
    df = spark.createDataFrame(rows, "actor string, grp string, vec array<double>").withColumn("members", F.lit(5))
    sims = {(r.user_a, r.user_b): r.similarity for r in vx.cosine_pairs(df).collect()}
    assert sims == {("a", "b"): 0.0, ("a", "c"): 0.0, ("b", "c"): 1.0}
    cohesion = {(r.grp_a, r.grp_b): r.cohesion for r in vx.cohesion_matrix(df).collect()}
    assert cohesion == {("g", "g"): 0.0, ("h", "h"): 1.0, ("g", "h"): 0.5}
    assert vf.pairs_of(df, "actor").count() == 3


def test_style_blank_and_joined(spark):
    rows = [("u", 1, "Hello there. We"), ("u", 2, "go on"), ("u", 3, "now! ..."), ("v", 4, "?!"), ("v", 5, "  ")]
    df = spark.createDataFrame(rows, "userid string, postid long, pagetext string")
    per = {r.postid: r for r in tx.style_features(df).collect()}
    assert per[4].mean_sentence_len == 0.0 and per[4].punct_quest_ratio == 0.0
    assert per[1].mean_sentence_len == 1.5 and per[1].std_sentence_len == 0.5
    got = {r.userid: r for r in tx.actor_style(df).collect()}
    # joined: "Hello there. We go on now! ..." -> sentences of 2 and 4 words
    assert (got["u"].mean_sentence_len, got["u"].std_sentence_len) == (3.0, 1.0)
    assert got["u"].punct_period_ratio == pytest.approx(4 / len("Hello there. We go on now! ..."))
    assert got["v"].mean_sentence_len == 0.0


def test_style_counts_without_word_arrays(spark):
    odd = ["  ...The Cat, y EL gato! también? TAMBIÉN \u212anow know \u0130n. \U00010400a \U00010428The", "", "?!", "\u00a0a_b 9x X9",
           "x x. xx", ",;,; a;b,C", "más m\u00e1\u0301s", "\U0001d7d9 \U0001f600The", "of the <b>of</b> http://to.the"]
    df = spark.createDataFrame([("u", i, t) for i, t in enumerate(odd)], "userid string, postid long, pagetext string")
    out = tx._text_counts(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan
    word = re.compile(r"\w+")  # of these texts: letters, numbers and underscores
    for r in out.collect():
        text = odd[r.postid]
        found = word.findall(text)
        assert r.n_words == len(found)
        assert r.func == sum(w.lower() in FUNCTION_WORDS for w in found)
        assert r.caps == sum(unicodedata.category(w[0]) == "Lu" for w in found)
        assert list(r.pieces) == [len(p.split()) for p in re.split(r"[.!?]+", text)]
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c")
    chars = spark.range(1, 0x110000).filter("id < 55296 or id > 57343").select(char).filter(~F.col("c").isin(*".!?"))
    assert chars.filter(F.col("c").rlike(f"^{tx.TOKEN}$") != F.col("c").rlike(f"^{tx.RUN}$")).isEmpty()
    vectors = tx.delta_vectors(df, min_words=1)
    assert vectors.first().n_words == sum(len(re.findall("[a-zA-Z]+", re.sub(r"https?://\S+", " ", re.sub("<[^>]+>", " ", t))))
                                          for t in odd)


def test_tfidf_bigrams_cross_texts(spark):
    rows = [("g", 1, "red car"), ("g", 2, "the"), ("g", 3, "fast red"), ("h", 4, "car fast")]
    df = spark.createDataFrame(rows, "grp string, postid long, pagetext string")
    got = {(r.grp, r.term): r.tf for r in tx.term_counts(df, "grp", ["the"]).collect()}
    assert got["g", "car fast"] == 1 and got["g", "red"] == 2 and ("g", "the") not in got
    assert got["h", "car fast"] == 1 and got["g", "fast red"] == 1


def test_topics_are_found_once(spark):
    rows = [("u", i, f"apple pear plum {'rain snow wind' if i % 2 else 'iron gold zinc'}") for i in range(40)]
    found = tx.topics(spark.createDataFrame(rows, "userid string, postid long, pagetext string"), k=2)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "UDF" not in plan  # a written table, not the model run again by each reader
    assert found.count() == 40 and found.columns == ["postid", "topic", "share"]


def test_snapshot_and_null_keys(spark):
    rows = [(2019, "a"), (2019, "b"), (2020, "a"), (2022, "a"), (2022, "c")]
    got = {(r.kind, r.from_year, r.to_year): (r.persist, r.vanish, r.appear) for r in rp.snapshot_transitions(
        spark.createDataFrame(rows, "yr int, handle string"), "yr", "handle").collect()}
    assert got == {("consecutive", 2019, 2020): (1, 1, 0), ("consecutive", 2020, 2022): (1, 0, 1),
                   ("first_last", 2019, 2022): (1, 1, 1)}
    nulls = spark.createDataFrame([("a", "x"), (None, "x"), ("a", None)], "actor string, label string")
    assert [tuple(r) for r in rp.label_share(nulls, "actor", "label").collect()] == [("a", "x", 1, 1.0, True)]


def test_corpus_cap_and_parts(spark):
    rows = [("u", i, "x" * 10) for i in range(120)] + [("w", 500, "short")]
    df = spark.createDataFrame(rows, "userid string, postid long, pagetext string")
    parts = {r.part: r.n_posts for r in rp.actor_corpus(df).collect()}
    assert parts == {0: 50, 1: 50, 2: 20}
    capped = rp.actor_corpus(df, max_chars=100).collect()
    assert sum(r.n_posts for r in capped) == 10  # posts that start before character 100


def test_resume_skips_finished_rows(spark, tmp_path):
    df = spark.createDataFrame([(i, "why?" if i % 2 else "so!") for i in range(20)], "id long, text string")
    path = str(tmp_path / "scores")
    en.score_rows(df.filter("id < 5"), "id", "text", lambda s: s.map(lambda _: "old")).write.parquet(path)
    got = {r.id: r.label for r in en.score_with_resume(spark, df, "id", "text", en.rule_scorer, path).collect()}
    assert len(got) == 20 and got[0] == "old" and got[7].startswith("Question") and got[8].startswith("exclam")


def test_group_limit_before_the_shuffle(spark):
    plan = QUERIES["topn_longest"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    plan = QUERIES["dedup_posts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("name", """posts_by_section copart_edges cosine_pairs hour_similarity concentration funnel describe_group
    snapshot_transitions combined_score utc_offset even_time_sample style_similarity delta_suspects vector_topk""".split())
def test_no_cartesian_plans(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = QUERIES["monthly_activity"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan
    plan = QUERIES["label_leaders"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,purchase)" in plan
