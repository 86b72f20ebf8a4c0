"""Counts, quality, retention and distribution reports."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foroscope.functions.ranking import prefix_totals, range_bucket, rank_in_groups, top_n_per_key
from foroscope.functions.stats import exact_quantiles, quantile_columns
from foroscope.functions.text import strip
from foroscope.session import stage


def source_summary(users: DataFrame, posts: DataFrame) -> DataFrame:
    """Users, posts, date range and posts per user of each source."""
    u = users.groupBy("forum").agg(F.count("*").alias("users"))
    p = posts.groupBy("forum").agg(F.count("*").alias("posts"), F.min("dateline").alias("first_post"),
                                   F.max("dateline").alias("last_post"))
    out = u.join(p, "forum", "full").fillna(0, ["users", "posts"])
    return out.withColumn("posts_per_user", F.round(F.col("posts") / F.greatest("users", F.lit(1)), 1))


def fill_rate(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percent of rows with a value that is neither NULL nor blank, per column, in one pass."""
    rates = df.agg(*[
        F.round(100 * F.avg(F.when(F.length(strip(F.col(c).cast("string"))) > 0, 1.0).otherwise(0.0)), 2).alias(c)
        for c in columns])
    return rates.unpivot([], columns, "column_name", "fill_pct")


def quality_report(posts: DataFrame, threads: DataFrame, key: str) -> DataFrame:
    """Epoch-zero dates, NULL dates, blank, very short and orphan posts per source."""
    known = threads.select(key).distinct().withColumn("known", F.lit(True))
    # only lengths and dates go through the join, never the texts
    slim = posts.select("forum", key, "dateline",
                        F.length(strip(F.coalesce("pagetext", F.lit("")))).alias("chars"))
    return slim.join(known, key, "left").groupBy("forum").agg(
        F.count("*").alias("posts"),
        F.count_if(F.year("dateline") < 2000).alias("epoch_zero"),
        F.count_if(F.col("dateline").isNull()).alias("null_date"),
        F.count_if(F.col("chars") == 0).alias("blank"),
        F.count_if(F.col("chars").between(1, 4)).alias("very_short"),
        F.count_if(F.col("known").isNull()).alias("orphans"))


def retention_report(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """Raw, clean and removed rows per source with the share kept."""
    r = raw.groupBy("forum").agg(F.count("*").alias("raw_rows"))
    c = clean.groupBy("forum").agg(F.count("*").alias("clean_rows"))
    out = r.join(c, "forum", "left").fillna(0, ["clean_rows"])
    return out.withColumns({
        "removed": F.col("raw_rows") - F.col("clean_rows"),
        "retained_pct": F.round(100 * F.col("clean_rows") / F.col("raw_rows"), 2)})


def count_check(actual: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Row counts against expected ones; fine between 85 and 115 percent."""
    ratio = F.col("rows") / F.col("expected")
    return expected.join(actual, key, "left").fillna(0, ["rows"]).select(
        key, "rows", "expected", F.round(100 * ratio, 2).alias("pct"), ratio.between(0.85, 1.15).alias("ok"))


def count_classes(df: DataFrame, actor: str) -> DataFrame:
    """How many actors have each row count. N rows allow at most sqrt(2N) distinct counts, so global
    rankings over this table stay small at any scale."""
    per_actor = df.filter(F.col(actor).isNotNull()).groupBy(actor).agg(F.count("*").alias("posts"))
    return per_actor.groupBy("posts").agg(F.count("*").alias("actors"))


def rank_size(df: DataFrame, actor: str) -> DataFrame:
    """Rank-size curve: rank range of the actors of each activity level, logs and the top 1 % marker."""
    run = Window.orderBy(F.desc("posts")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = count_classes(df, actor).withColumns({
        "last_rank": F.sum("actors").over(run),
        "n": F.sum("actors").over(Window.partitionBy())})
    first = F.col("last_rank") - F.col("actors") + 1
    return ranked.select(
        "posts", "actors", first.alias("first_rank"), "last_rank",
        F.round(F.log10(first.cast("double")), 6).alias("log_rank"),
        F.round(F.log10(F.col("posts").cast("double")), 6).alias("log_posts"),
        (first <= F.greatest(F.floor(F.col("n") * 0.01), F.lit(1))).alias("top_1pct"))


def concentration(df: DataFrame, actor: str, section: str) -> DataFrame:
    """Share of the most active 10 % of actors, share of the five largest sections, actors with 5+ rows."""
    run = Window.orderBy(F.desc("posts")).rowsBetween(Window.unboundedPreceding, -1)
    ranked = count_classes(df, actor).withColumns({
        "before": F.coalesce(F.sum("actors").over(run), F.lit(0)),
        "n": F.sum("actors").over(Window.partitionBy())})
    top = F.greatest(F.floor(F.col("n") * 0.1), F.lit(1))
    taken = F.greatest(F.least(F.col("actors"), top - F.col("before")), F.lit(0))
    share = ranked.agg(
        F.sum("actors").alias("actors"), F.sum(F.col("actors") * F.col("posts")).alias("posts"),
        F.round(100 * F.sum(taken * F.col("posts")) / F.sum(F.col("actors") * F.col("posts")), 4).alias("top10_pct"),
        F.sum(F.when(F.col("posts") >= 5, F.col("actors")).otherwise(0)).alias("actors_5plus"))
    sections = df.groupBy(section).agg(F.count("*").alias("c"))
    top5 = sections.orderBy(F.desc("c"), section).limit(5).agg(F.sum("c")).scalar()
    return share.withColumn("top5_sections_pct", F.round(100 * top5 / F.col("posts"), 4))


def dominant_label(df: DataFrame, actor: str, label: str) -> DataFrame:
    """Most frequent label per actor (ties to the lower label) with its count and share."""
    counts = df.dropna(subset=[actor, label]).groupBy(actor, label).agg(F.count("*").alias("n"))
    totals = counts.groupBy(actor).agg(F.sum("n").alias("total"))
    best = top_n_per_key(counts, [actor], [F.desc("n"), label], 1)
    return best.join(totals, actor).withColumn("share", F.round(F.col("n") / F.col("total"), 6))


def label_share(df: DataFrame, actor: str, label: str) -> DataFrame:
    """Share of each label within its actor and whether it is the dominant one."""
    counts = df.dropna(subset=[actor, label]).groupBy(actor, label).agg(F.count("*").alias("n"))
    w = Window.partitionBy(actor)
    return counts.select(
        actor, label, "n", F.round(F.col("n") / F.sum("n").over(w), 6).alias("share"),
        (F.row_number().over(w.orderBy(F.desc("n"), label)) == 1).alias("dominant"))


def label_leaders(df: DataFrame, actor: str, label: str, value: str, n: int) -> DataFrame:
    """Actors with most rows of one label."""
    return (df.filter(F.col(label) == value).groupBy(actor).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), actor).limit(n))


def crosstab(df: DataFrame, rows: str, cols: str, values: list) -> DataFrame:
    """Counts of rows x columns for the given column values, 0 where empty."""
    return df.groupBy(rows).pivot(cols, values).agg(F.count(F.lit(1))).fillna(0)


def section_stats(df: DataFrame, section: str, actor: str, value: str) -> DataFrame:
    """Posts, distinct actors, sum and mean per section."""
    per_actor = df.groupBy(section, actor).agg(F.count("*").alias("n"), F.sum(value).alias("s"))
    return per_actor.groupBy(section).agg(
        F.sum("n").alias("posts"), F.count("*").alias("actors"), F.round(F.sum("s"), 2).alias("total"),
        F.round(F.round(F.sum("s"), 2) / F.sum("n"), 4).alias("mean"))


def funnel(cases: DataFrame, activity: DataFrame, key: str) -> DataFrame:
    """Total, with activity, paid and done cases: independent counts of the base with percent of total."""
    seen = activity.select(F.col(key)).distinct().withColumn("seen", F.lit(True))
    counted = cases.join(seen, key, "left").agg(
        F.count("*").alias("total"), F.count_if("seen").alias("with_activity"), F.count_if("paid").alias("paid"),
        F.count_if("done").alias("done"))
    total = F.col("total")
    stages = ["total", "with_activity", "paid", "done"]
    return counted.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("step"), F.lit(s).alias("stage"), F.col(s).alias("cases"),
                 F.round(100 * F.col(s) / total, 1).alias("pct")) for i, s in enumerate(stages)])).alias("x")
    ).select("x.*")


def lifetime_days(df: DataFrame, first: str, last: str):
    """Days between two times, rows lacking one of them dropped."""
    days = (F.unix_timestamp(last) - F.unix_timestamp(first)) / 86400.0
    return df.filter(F.col(first).isNotNull() & F.col(last).isNotNull()).withColumn("days", F.round(days, 6))


def conversation_stats(messages: DataFrame, key: str, time: str, phase: str) -> DataFrame:
    """Messages, first, last, distinct phases and hours per conversation."""
    per_phase = messages.groupBy(key, phase).agg(
        F.count("*").alias("n"), F.min(time).alias("a"), F.max(time).alias("b"))
    hours = (F.unix_timestamp("last") - F.unix_timestamp("first")) / 3600.0
    return per_phase.groupBy(key).agg(
        F.sum("n").alias("messages"), F.min("a").alias("first"), F.max("b").alias("last"),
        F.count("*").alias("phases")).withColumn("hours", F.round(hours, 6))


def describe_group(df: DataFrame, keys: list[str], value: str, digits: int = 4, extra: tuple = ()) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum."""
    base = df.groupBy(*keys).agg(
        *extra,
        F.count(value).alias("count"), F.round(F.avg(value), digits).alias("mean"),
        F.round(F.stddev_samp(value), digits).alias("std"), F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"))
    q = quantile_columns(exact_quantiles(df, keys, value, [0.25, 0.5, 0.75]), keys,
                         {0.25: "q25", 0.5: "q50", 0.75: "q75"})
    for c in ("q25", "q50", "q75"):
        q = q.withColumn(c, F.round(c, digits))
    if keys:
        return base.join(q, keys, "left")
    quartiles = q.select(F.struct("q25", "q50", "q75")).scalar()
    return base.withColumn("q", quartiles).select("*", "q.*").drop("q")


def net_votes(votes: DataFrame, who: str) -> DataFrame:
    """Positive, negative, net and total votes per receiver or giver."""
    return votes.filter(F.col(who).isNotNull()).groupBy(who).agg(
        F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg"),
        F.count("*").alias("total")).withColumn("net", F.col("pos") - F.col("neg"))


def participation(posts: DataFrame) -> DataFrame:
    """Posts per (forum, actor, thread), ids prefixed by forum."""
    rows = posts.dropna(subset=["forum", "userid", "threadid"])
    return rows.groupBy("forum", "userid", "threadid").agg(F.count("*").alias("post_count")).select(
        "forum", F.concat_ws("_", "forum", "userid").alias("userid"),
        F.concat_ws("_", "forum", "threadid").alias("threadid"), "post_count")


def actor_corpus(posts: DataFrame, min_posts: int = 5, min_chars: int = 500, part_posts: int = 50,
                 max_chars: int | None = None) -> DataFrame:
    """All texts of an actor in id order, as parts of at most ``part_posts`` posts.

    Parts keep the corpus whole without building one unbounded string for a prolific actor. The optional
    ``max_chars`` keeps the posts that start before that many characters.
    """
    rows = posts.filter(F.length(strip("pagetext")) > 0)
    totals = rows.groupBy("userid").agg(F.count("*").alias("n"), F.sum(F.length("pagetext")).alias("chars"))
    keep = totals.filter((F.col("n") >= min_posts) & (F.col("chars") >= min_chars))
    rows = rows.join(keep, "userid", "left_semi")
    ranked = rank_in_groups(rows, ["userid"], ["postid"], range_bucket(rows, "postid"))
    if max_chars:
        ranked = prefix_totals(ranked, ["userid"], ["postid"], range_bucket(rows, "postid"),
                               F.length("pagetext") + 1, "start").filter(F.col("start") < max_chars)
    ranked = ranked.withColumn("part", F.floor(F.col("rank0") / part_posts))
    return ranked.groupBy("userid", "part").agg(
        F.count("*").alias("n_posts"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("postid", "pagetext"))),
                                 lambda p: p["pagetext"]), " ").alias("corpus"))


def activity_hist(df: DataFrame, actor: str, clip: int = 500, bins: int = 50) -> DataFrame:
    """Actors per bin of activity, activity clipped."""
    level = F.least(F.col("posts"), F.lit(clip))
    bin_ = F.least(F.floor(level * bins / clip), F.lit(bins - 1))
    return count_classes(df, actor).groupBy(bin_.alias("bin")).agg(F.sum("actors").alias("actors"))


def sampling_cost(df: DataFrame, actor: str, caps: list[int]) -> DataFrame:
    """Rows that remain when each actor keeps at most n rows."""
    classes = count_classes(df, actor)
    costs = classes.agg(F.sum(F.col("actors") * F.col("posts")).alias("all"), *[
        F.sum(F.col("actors") * F.least(F.col("posts"), F.lit(n))).alias(f"top_{n}") for n in caps])
    return costs.unpivot([], ["all"] + [f"top_{n}" for n in caps], "strategy", "rows")


def length_profile(df: DataFrame, text: str) -> DataFrame:
    """Distribution of text lengths with the shares below 5 and above 500 characters."""
    rows = stage(df.select(F.length(text).alias("chars")), "lengths")  # the texts are read once
    return describe_group(rows, [], "chars", extra=(
        F.round(F.avg((F.col("chars") < 5).cast("double")), 6).alias("share_short"),
        F.round(F.avg((F.col("chars") > 500).cast("double")), 6).alias("share_long")))


def threads_per_actor(posts: DataFrame) -> DataFrame:
    """Median and maximum number of distinct threads of an actor."""
    pairs = posts.select("userid", "threadid").dropna().distinct()
    per_actor = stage(pairs.groupBy("userid").agg(F.count("*").alias("threads")), "threads-per-actor")
    top = per_actor.agg(F.count("*").alias("actors"), F.max("threads").alias("max_threads"))
    median = exact_quantiles(per_actor, [], "threads", [0.5]).select("quantile").scalar()
    return top.withColumn("median_threads", median)


def top_actors(df: DataFrame, actor: str, attributes: DataFrame, n: int) -> DataFrame:
    """Most active actors with their attributes; only the top rows are joined."""
    best = df.filter(F.col(actor).isNotNull()).groupBy(actor).agg(F.count("*").alias("posts")).orderBy(F.desc("posts"), actor).limit(n)
    return best.join(attributes, actor, "left")


def snapshot_transitions(snapshots: DataFrame, time: str, handle: str) -> DataFrame:
    """Handles that persist, vanish or appear between consecutive snapshots and from first to last.

    One row per handle holds its set of snapshots, so every transition is counted in a single pass.
    """
    present = snapshots.groupBy(handle).agg(F.collect_set(time).alias("seen"))
    years = F.col("years")
    pairs = F.zip_with(F.slice(years, F.lit(1), F.size(years) - 1), F.slice(years, F.lit(2), F.size(years) - 1),
                       lambda a, b: F.struct(a.alias("a"), b.alias("b"), F.lit("consecutive").alias("kind")))
    ends = F.array(F.struct(F.try_element_at(years, F.lit(1)).alias("a"),
                            F.try_element_at(years, F.lit(-1)).alias("b"), F.lit("first_last").alias("kind")))
    # the distinct snapshots are few; their transitions reach every task as one scalar value
    wanted = (snapshots.agg(F.array_sort(F.collect_set(time)).alias("years"))
              .select(F.concat(pairs, ends)).scalar())
    rows = present.select("seen", F.explode(wanted).alias("p"))
    in_a, in_b = F.array_contains("seen", F.col("p.a")), F.array_contains("seen", F.col("p.b"))
    return rows.groupBy("p.kind", F.col("p.a").alias("from_year"), F.col("p.b").alias("to_year")).agg(
        F.count_if(in_a & in_b).alias("persist"), F.count_if(in_a & ~in_b).alias("vanish"),
        F.count_if(~in_a & in_b).alias("appear"))
