"""Text queries."""

from pyspark.sql import functions as F

from foroscope import model
from foroscope.functions.wordlists import FUNCTION_WORDS, LANGUAGE_WORDS
from foroscope.model import cte, table
from foroscope.operators import gazetteer as gz
from foroscope.operators import language as lg
from foroscope.operators import texts as tx
from foroscope.plans.registry import query
from foroscope.session import stage


def sql_list(items) -> str:
    return "(" + ", ".join("'" + i + "'" for i in items) + ")"


FW = sql_list(FUNCTION_WORDS)
TOKEN_SQL = tx.TOKEN
WORD_SQL = "[\\p{L}\\p{N}_]+"

# style features of a column ``pagetext`` of relation ``@rel@`` keyed by ``@key@``
STYLE = """
parts as (select @key@, pagetext, length(pagetext)::double as chars,
    list_filter(list_transform(regexp_split_to_array(pagetext, '[.!?]+'),
      lambda s: len(regexp_extract_all(s, '""" + TOKEN_SQL + """'))), lambda n: n > 0) as sent,
    regexp_extract_all(pagetext, '""" + WORD_SQL + """') as w from @rel@),
style as (select @key@, len(sent) = 0 or len(w) = 0 as blank, sent, w, chars, pagetext from parts),
feat as (select @key@,
  case when blank then 0 else list_avg(sent) end as mean_sentence_len,
  case when blank then 0 else sqrt(greatest(len(sent)::hugeint * list_sum(list_transform(sent, lambda n: n * n))
    - list_sum(sent)::hugeint * list_sum(sent)::hugeint, 0)::double) / len(sent) end as std_sentence_len,
  case when blank then 0 else (length(pagetext) - length(replace(pagetext, '.', ''))) / chars end as punct_period_ratio,
  case when blank then 0 else (length(pagetext) - length(replace(pagetext, ',', ''))) / chars end as punct_comma_ratio,
  case when blank then 0 else (length(pagetext) - length(replace(pagetext, '!', ''))) / chars end as punct_excl_ratio,
  case when blank then 0 else (length(pagetext) - length(replace(pagetext, '?', ''))) / chars end as punct_quest_ratio,
  case when blank then 0 else len(list_filter(w, lambda x: lower(x) in """ + FW + """)) / len(w)::double end
    as function_word_ratio,
  case when blank then 0 else len(list_filter(w, lambda x: regexp_matches(x, '^\\p{Lu}'))) / len(w)::double end
    as capitalization_ratio from style)"""


def style_sql(rel: str, key: str) -> str:
    return STYLE.replace("@rel@", rel).replace("@key@", key)


ROUNDED = ", ".join(f"round({c}, 6) as {c}" for c in tx.FEATURES)


@query("style_features", cte("text_posts") + "," + style_sql(
    "(select * from text_posts where pagetext <> '')", "postid")
       + f" select postid, {ROUNDED} from feat")
def style_features(spark, sf):
    return tx.style_features(model.text_posts(spark, sf)).select(
        "postid", *[F.round(c, 6).alias(c) for c in tx.FEATURES])


JOINED = cte("text_posts") + """, joined as (
  select userid, string_agg(pagetext, ' ' order by postid) as pagetext from text_posts where pagetext <> '' group by 1),"""


@query("actor_style", JOINED + style_sql("joined", "userid") + f" select userid, {ROUNDED} from feat")
def actor_style(spark, sf):
    return tx.actor_style(model.text_posts(spark, sf)).select(
        "userid", *[F.round(c, 6).alias(c) for c in tx.FEATURES])


VEC = "[" + ", ".join(tx.FEATURES) + "]"


@query("style_similarity", JOINED + style_sql("joined", "userid") + f""",
v as (select userid, {VEC} as vec from feat)
select a.userid as user_a, b.userid as user_b, round(list_cosine_similarity(a.vec, b.vec), 6) as similarity
from v a join v b on a.userid < b.userid""")
def style_similarity(spark, sf):
    posts = model.text_posts(spark, sf)
    return tx.style_similarity(posts, posts.select("userid").distinct())


@query("tfidf_top_terms", cte("text_posts") + f""",
t as (select userid, postid, list_filter(regexp_extract_all(lower(pagetext), '{WORD_SQL}'),
    lambda w: length(w) >= 2 and w not in {FW}) as t from text_posts),
g as (select userid, flatten(list(t order by postid)) as t from t group by 1),
terms as (select userid, unnest(t) as term from g union all
  select userid, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) from g),
c as (select userid, term, count(*) as tf from terms group by 1, 2),
vocab as (select term, count(*) as df, sum(tf) as total from c group by 1 having count(*) >= 2
  order by total desc, term limit 5000),
w as (select userid, term, tf, df,
  tf * (ln((1 + (select count(distinct userid) from c)) / (1 + df)::double) + 1) as w from c join vocab using (term)),
r as (select userid, term, tf, df, round(w / sqrt(sum(w * w) over (partition by userid)), 8) as tfidf from w)
select userid, term, tf, df, round(tfidf, 6) as tfidf from r
qualify row_number() over (partition by userid order by r.tfidf desc, term) <= 10""")
def tfidf_top_terms(spark, sf):
    top = tx.tfidf_top_terms(model.text_posts(spark, sf), "userid", FUNCTION_WORDS)
    return top.select("userid", "term", "tf", "df", F.round("tfidf", 6).alias("tfidf"))


DELTA = cte("text_posts") + f""",
t as (select userid, regexp_extract_all(lower(regexp_replace(regexp_replace(regexp_replace(pagetext, '<[^>]+>', ' ', 'g'),
    'https?://\\S+', ' ', 'g'), '[^a-zA-Z\\s]', ' ', 'g')), '[a-z]+') as t from text_posts),
vol as (select userid, cast(sum(len(t)) as bigint) as n_words from t group by 1 having sum(len(t)) >= 500),
c as (select userid, word, count(*) as c from (select userid, unnest(t) as word from t)
  where word in {FW} and userid in (select userid from vol) group by 1, 2),
vocab as (select word from c group by 1 order by sum(c) desc, word limit 200),
actors as (select * from vol order by n_words desc, userid limit 150),
f as (select userid, n_words, word, coalesce(c, 0) / n_words::double as f
  from actors cross join vocab left join c using (userid, word)),
z as (select userid, n_words, word, (f - avg(f) over w) / case when stddev_pop(f) over w = 0 then 1
    else stddev_pop(f) over w end as z from f window w as (partition by word)),
pairs as (select a.userid as user_a, b.userid as user_b, round(avg(abs(a.z - b.z)), 4) as delta,
    round(1 - sum(a.z * b.z) / (sqrt(sum(a.z * a.z)) * sqrt(sum(b.z * b.z))), 4) as cosine_delta,
    max(a.n_words) as words_a, max(b.n_words) as words_b
  from z a join z b on a.word = b.word and a.userid < b.userid group by 1, 2)"""


@query("burrows_delta", DELTA + " select user_a, user_b, delta, words_a, words_b from pairs")
def burrows_delta(spark, sf):
    return tx.delta_pairs(model.text_posts(spark, sf)).drop("cosine_delta")


@query("cosine_delta", DELTA + " select user_a, user_b, cosine_delta from pairs")
def cosine_delta(spark, sf):
    return tx.delta_pairs(model.text_posts(spark, sf)).select("user_a", "user_b", "cosine_delta")


@query("delta_suspects", DELTA + """ select user_a, user_b, delta, cosine_delta, words_a, words_b,
  cosine_delta <= (select quantile_cont(cosine_delta, 0.01) from pairs) as both from pairs
where delta <= (select quantile_cont(delta, 0.01) from pairs)""")
def delta_suspects(spark, sf):
    return tx.delta_suspects(tx.delta_pairs(model.text_posts(spark, sf)))


@query("nearest_delta", DELTA + """ select userid, min(delta) as nearest_delta from (
  select user_a as userid, delta from pairs union all select user_b, delta from pairs) group by 1""")
def nearest_delta(spark, sf):
    return tx.nearest_delta(tx.delta_pairs(model.text_posts(spark, sf)))


HITS = ", ".join(f"len(list_filter(w, lambda x: x in {sql_list(p)})) as {lang}_n"
                 for lang, p in LANGUAGE_WORDS.items())
BEST = "greatest(" + ", ".join(f"{lang}_n" for lang in sorted(LANGUAGE_WORDS)) + ")"
PICK = (f"case when {BEST} = 0 then 'unknown' "
        + " ".join(f"when {lang}_n = {BEST} then '{lang}'" for lang in sorted(LANGUAGE_WORDS)) + " end")


@query("language_route", cte("text_posts") + f""",
p as (select userid, regexp_replace(regexp_replace(pagetext, '<[^>]+>', ' ', 'g'), '^\\s+|\\s+$', '', 'g') as plain
  from text_posts),
w as (select userid, regexp_extract_all(lower(plain), '{WORD_SQL}') as w from p where length(plain) >= 30),
h as (select userid, {HITS} from w),
c as (select userid, {PICK} as language, count(*) as n from h group by 1, 2),
r as (select *, sum(n) over (partition by userid) as total,
  row_number() over (partition by userid order by n desc, language) as rk from c)
select userid, language, round(100 * n / total::double, 1) as pct,
  case when language = 'fr' then 'fr' else 'en' end as route from r where rk = 1""")
def language_route(spark, sf):
    return tx.language_route(model.text_posts(spark, sf), "userid", ["fr"])


GRAMS = """with p as (select doc_id as postid, source as userid, lang, doc_id % 5 = 0 as held_out,
  ' ' || trim(regexp_replace(lower(text), '[^\\p{L}]+', ' ', 'g')) || ' ' as plain from documents where text is not null),
g as materialized (select postid, userid, lang, held_out, unnest(list_transform(range(1, len(ch) - 1),
  lambda i: ch[i] || ch[i + 1] || ch[i + 2])) as gram
  from (select *, string_split(plain, '') as ch from p where trim(plain) <> '')),
c as (select lang, gram, count(*) as c from g where not held_out and lang is not null group by 1, 2),
t as (select lang as language, sum(c) + (select count(distinct gram) from c) as total from c group by 1),
d as (select postid, count(*) as n from g group by 1),
h as (select postid, c.lang as language, sum(ln(c + 1.0::double)) as s from g join c on g.gram = c.gram group by 1, 2),
scored as (select postid, language, round(coalesce(s, 0) / n - ln(total), 6) as score
  from d cross join t left join h using (postid, language)),
best as (select postid, language, score from scored qualify row_number() over (partition by postid order by score desc, language) = 1)"""


def gram_profiles(spark, sf):
    docs = table(spark, sf, "documents", "doc_id", "text", "lang")
    return lg.learn_profiles(docs.filter("doc_id % 5 <> 0"), "lang", "text")


def spread_texts(spark, sf):
    return model.spread(table(spark, sf, "documents", "doc_id", "text", "source").filter("text is not null").selectExpr(
        "doc_id as postid", "text", "source as userid"), "postid")


@query("language_scores", GRAMS + " select postid, language, score from scored")
def language_scores(spark, sf):
    """Log-probability of every text in each language, learned from four fifths of the texts."""
    return lg.score_languages(spread_texts(spark, sf), "postid", "text", gram_profiles(spark, sf))


@query("language_learned", GRAMS + """
select p.postid, coalesce(language, 'unknown') as language, score from p left join best using (postid)""")
def language_learned(spark, sf):
    return lg.detect(spread_texts(spark, sf), "postid", "text", gram_profiles(spark, sf))


@query("language_route_learned", GRAMS + """,
l as (select userid, coalesce(language, 'unknown') as language from p left join best using (postid)),
r as (select userid, language, count(*) as n, sum(count(*)) over (partition by userid) as total,
  row_number() over (partition by userid order by count(*) desc, language) as rk from l group by 1, 2)
select userid, language, round(100 * n / total::double, 1) as pct, case when language = 'fr' then 'fr' else 'en' end as route
from r where rk = 1""")
def language_route_learned(spark, sf):
    texts = spread_texts(spark, sf)
    found = lg.detect(texts, "postid", "text", gram_profiles(spark, sf)).join(texts.select("postid", "userid"), "postid")
    return lg.majority_route(found, "userid", ["fr"])


@query("topics_lda")
def topics_lda(spark, sf):
    posts = model.text_posts(spark, sf)
    return tx.topic_keywords(posts, tx.topics(posts))


MENTIONS = cte("text_posts") + ", m as (" + " union all ".join(
    f"select postid, '{k}'::varchar as type, lower(unnest(regexp_extract_all(pagetext, '{p}'))) as entity from text_posts"
    for k, p in tx.ENTITY_PATTERNS.items()) + ")"


@query("entity_mentions", MENTIONS + " select postid, type, entity, count(*) as mentions from m group by 1, 2, 3")
def entity_mentions(spark, sf):
    return tx.entity_mentions(model.text_posts(spark, sf))


@query("top_entities", MENTIONS + """, c as (select type, entity, count(*) as mentions from m group by 1, 2)
select type, entity, mentions, cast(row_number() over (partition by type order by mentions desc, entity) as int) as rank
from c qualify rank <= 15""")
def top_entities(spark, sf):
    return tx.top_entities(tx.entity_mentions(model.text_posts(spark, sf)), 15)


GAZETTEER = r"""words as (select doc_id as postid, unnest(t) as w, generate_subscripts(t, 1) - 1 as pos from (
    select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') as t from documents)),
ahead as (select postid, pos, w, lead(w, 1) over o as w2, lead(w, 2) over o as w3 from words
  window o as (partition by postid order by pos)),
grams as (select postid, pos, 2 as n, w || ' ' || w2 as phrase from ahead where w2 is not null
  union all select postid, pos, 3, w || ' ' || w2 || ' ' || w3 from ahead where w3 is not null),
listed as (select n, phrase, min('doc' || postid % 7) as label from grams where postid % 2 = 1 and md5(phrase)[1] = 'a' group by 1, 2),
cand as materialized (select postid, pos, n, phrase, label, pos + n as after from grams join listed using (n, phrase)
  qualify row_number() over (partition by postid, pos order by n desc) = 1),
nxt as materialized (select a.postid, a.pos, b.pos as nxt from cand a asof join (select postid, pos from cand) b
  on a.postid = b.postid and a.after <= b.pos),
walk(postid, pos) as (select postid, min(pos) from cand group by 1
  union all select x.postid, x.nxt from walk w join nxt x on x.postid = w.postid and x.pos = w.pos),
found as (select c.* from walk w join cand c on c.postid = w.postid and c.pos = w.pos)"""


def listed_phrases(spark, sf):
    """A list of two- and three-word phrases from every second text, about a sixteenth of them."""
    docs = table(spark, sf, "documents", "doc_id", "text").filter("doc_id % 2 = 1")
    rows = docs.select("doc_id", gz.tokens(F.col("text")).alias("t"))

    every = F.explode_outer(F.concat(gz.runs(F.col("t"), 2), gz.runs(F.col("t"), 3)))
    terms = rows.select(F.concat(F.lit("doc"), F.col("doc_id") % 7).alias("label"), every.alias("term"))
    return stage(gz.gazetteer(terms.filter(F.substring(F.md5("term"), 1, 1) == "a"), "term", "label"), "phrases")


@query("gazetteer_mentions", "with recursive " + GAZETTEER + """
select postid, cast(pos as int) as pos, cast(n as int) as n, phrase, label from found""")
def gazetteer_mentions(spark, sf):
    texts = model.spread(table(spark, sf, "documents", "doc_id", "text").withColumnRenamed("doc_id", "postid"), "postid")
    return gz.mentions(texts, "postid", "text", listed_phrases(spark, sf))


@query("gazetteer_classes", "with recursive " + GAZETTEER + """
select label, count(*) as mentions, count(distinct phrase) as phrases, count(distinct postid) as posts from found group by 1""")
def gazetteer_classes(spark, sf):
    """Mentions per class of the list."""
    texts = model.spread(table(spark, sf, "documents", "doc_id", "text").withColumnRenamed("doc_id", "postid"), "postid")
    return gz.mentions(texts, "postid", "text", listed_phrases(spark, sf)).groupBy("label").agg(
        F.count("*").alias("mentions"), F.count_distinct("phrase").alias("phrases"), F.count_distinct("postid").alias("posts"))
