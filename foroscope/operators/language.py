"""Language of texts from character n-grams that are learned from texts of known language."""

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foroscope.functions.ranking import top_n_per_key
from foroscope.session import stage


@dataclass
class Profiles:
    """Log-probability ``unseen`` of a new n-gram per language, and per n-gram what each language gains over that."""

    gains: DataFrame
    unseen: dict[str, float]
    n: int


def letters(text: Column) -> Column:
    """Lower-case letters of any script, all else as one blank, with a blank at either end."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))
    return F.concat(F.lit(" "), plain, F.lit(" "))


def grams(chars: str, n: int) -> Column:
    """All n-grams of a column of :func:`letters`, repeats included; none where there is no letter.

    One pass of a pattern that looks ahead by n characters and moves by one."""
    return F.when(F.length(chars) > 2, F.regexp_extract_all(F.col(chars), F.lit(f"(?=(.{{{n}}}))."), F.lit(1)))


def learn_profiles(texts: DataFrame, lang: str, text: str, n: int = 3) -> Profiles:
    """Add-one probabilities of the n-grams of each language, from all given texts.

    n-grams are counted where texts are read, so a language that holds most texts is no hot key. Languages are a short
    list; the profiles have a row for each n-gram of their alphabets, however many texts there are."""
    seen = texts.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), letters(F.col(text)).alias("chars"))
    # explode_outer: the filter that a plain explode implies would rewrite the text for every n-gram
    counts = stage(seen.select("lang", F.explode_outer(grams("chars", n)).alias("gram")).filter("gram is not null").groupBy(
        "lang", "gram").agg(F.count("*").alias("c")), "grams")
    known = counts.agg(F.count_distinct("gram")).first()[0]
    totals = {r["lang"]: r["c"] for r in counts.groupBy("lang").agg(F.sum("c").alias("c")).collect()}
    gain = F.log(F.col("c") + 1.0)  # log((c + 1) / (total + known)) - log(1 / (total + known))
    gains = counts.groupBy("gram").pivot("lang", sorted(totals)).agg(F.first(gain)).fillna(0.0)
    return Profiles(stage(gains, "profiles"), {k: -log(v + known) for k, v in sorted(totals.items())}, n)


def score_languages(texts: DataFrame, key: str, text: str, profiles: Profiles) -> DataFrame:
    """Mean log-probability of every text's n-grams in each language: key, language, score (6 digits).

    Texts without letters have no rows. n-grams meet the profiles and are summed per text before anything is shuffled, as
    long as the optimizer finds the profiles small; otherwise they are shuffled by n-gram."""
    names = list(profiles.unseen)
    if not names:
        return texts.select(key, F.lit("").alias("language"), F.lit(0.0).alias("score")).limit(0)
    rows = texts.select(F.col(key).alias("key"), letters(F.col(text)).alias("chars")).select(
        "key", F.explode_outer(grams("chars", profiles.n)).alias("gram")).filter("gram is not null")
    sums = rows.join(profiles.gains, "gram", "left").groupBy("key").agg(
        F.count("*").alias("n"), *[F.sum(F.coalesce(F.col(f"`{k}`"), F.lit(0.0))).alias(f"s{i}") for i, k in enumerate(names)])
    each = F.array(*[F.struct(F.lit(k).alias("language"), F.round(F.col(f"s{i}") / F.col("n") + profiles.unseen[k], 6)
                              .alias("score")) for i, k in enumerate(names)])
    return sums.select(F.col("key").alias(key), F.explode(each).alias("e")).select(key, "e.language", "e.score")


def detect(texts: DataFrame, key: str, text: str, profiles: Profiles, unknown: str = "unknown") -> DataFrame:
    """Language of highest score for every row (the first name on ties): key, language, score; ``unknown`` without letters.

    Keys are unique; null and blank texts are rows too."""
    scores = score_languages(texts, key, text, profiles)
    best = scores.groupBy(key).agg(F.max(F.struct("score")).alias("m")).select(key, F.col("m.score").alias("score"))
    named = scores.join(best, [key, "score"]).groupBy(key, "score").agg(F.min("language").alias("language"))
    return texts.select(key).join(named, key, "left").select(key, F.coalesce("language", F.lit(unknown)).alias("language"), "score")


def majority_route(detected: DataFrame, source: str, routes: list[str], default: str = "en") -> DataFrame:
    """Majority language per source with its share of all rows, and the pipeline that serves it."""
    counts = detected.groupBy(source, "language").agg(F.count("*").alias("n"))
    counts = counts.withColumn("total", F.sum("n").over(Window.partitionBy(source)))
    best = top_n_per_key(counts, [source], [F.desc("n"), "language"], 1)
    return best.select(source, "language", F.round(100 * F.col("n") / F.col("total"), 1).alias("pct"),
                       F.when(F.col("language").isin(routes), F.col("language")).otherwise(default).alias("route"))
