"""Cleaning, flags and scalar label functions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foroscope.functions.ranking import top_n_per_key
from foroscope.functions.text import strip

# Trusted period of post dates.
FIRST_DAY, LAST_DAY = "2000-01-01", "2025-12-31"


def clean_users(users: DataFrame) -> DataFrame:
    """Join dates before 2000 to NULL, handles and contacts normalised, original handle kept."""
    return users.select(
        "forum", "userid", F.col("username").alias("username_raw"),
        F.lower(strip("username")).alias("username"),
        F.when(F.col("joindate") >= F.lit(FIRST_DAY).cast("timestamp"), F.col("joindate")).alias("joindate"),
        F.nullif(F.lower(strip("contact")), F.lit("")).alias("contact"))


def flag_posts(posts: DataFrame) -> DataFrame:
    """Flags for a plausible date and for text of at least five characters."""
    day = F.to_date("dateline")
    return posts.withColumns({
        "dateline_valid": F.coalesce(
            day.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")), F.lit(False)),
        "text_valid": F.coalesce(F.length(strip("pagetext")) >= 5, F.lit(False))})


def dedup(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row per key in an explicit order; rows without a key are kept apart per NULL-safe key."""
    return top_n_per_key(df, keys, order, 1)


def clean_posts(posts: DataFrame, keys: list[str], order: list, min_length: int = 10) -> DataFrame:
    """Non-blank text, one row per key, dated 2000 or later, at least ``min_length`` characters."""
    kept = posts.filter(F.length(strip("pagetext")) > 0)
    # the length is taken before the shuffle, so a caller that only counts never moves the texts
    kept = dedup(kept.withColumn("__chars", F.length("pagetext")), keys, order)
    return kept.filter((F.year("dateline") >= 2000) & (F.col("__chars") >= min_length)).drop("__chars")


def clean_messages(messages: DataFrame) -> DataFrame:
    """Non-blank messages, exact repeats of (timestamp, username, message) removed."""
    return (messages.filter(F.length(strip("message")) > 0)
            .dropDuplicates(["timestamp", "username", "message"]))


def code_label(col, labels: dict, default: str) -> Column:
    """Code to label by a literal map, default for unmapped or NULL codes."""
    out = None
    for code, label in labels.items():
        out = F.when(F.col(col) == code, label) if out is None else out.when(F.col(col) == code, label)
    return out.otherwise(default)


def first_present(choices: dict[str, str], default: str = "N/A") -> Column:
    """Label of the first non-NULL column."""
    return F.coalesce(*[F.when(F.col(c).isNotNull(), F.lit(label)) for c, label in choices.items()], F.lit(default))


def json_array_size(col) -> Column:
    """Number of entries of a JSON array, 0 when NULL or invalid."""
    return F.coalesce(F.size(F.filter(F.from_json(col, "array<string>"), lambda x: F.lit(True))), F.lit(0))


# Allowed entity types and their synonyms.
ENTITY_TYPES = ["PERSON", "ORGANIZATION", "LOCATION", "EVENT", "IDEOLOGY"]
ENTITY_SYNONYMS = {"PER": "PERSON", "ORG": "ORGANIZATION", "GROUP": "ORGANIZATION", "LOC": "LOCATION",
                   "GPE": "LOCATION", "PLACE": "LOCATION"}


def entity_type(col) -> Column:
    """Upper-case part before ``|``, synonyms mapped, anything else OTHER."""
    raw = strip(F.upper(F.substring_index(col, "|", 1)))
    synonyms = F.create_map(*[F.lit(x) for kv in ENTITY_SYNONYMS.items() for x in kv])
    mapped = F.coalesce(F.try_element_at(synonyms, raw), raw)
    return F.when(mapped.isin(ENTITY_TYPES), mapped).otherwise("OTHER")


def normalize_entities(mentions: DataFrame) -> DataFrame:
    """Mentions and mean confidence per (entity, type), entity trimmed and lower-case."""
    rows = mentions.select(F.lower(strip("entity")).alias("entity"), entity_type("type").alias("type"), "confidence")
    return rows.filter("entity <> ''").groupBy("entity", "type").agg(
        F.count("*").alias("mentions"), F.round(F.avg("confidence"), 6).alias("confidence"))


def deny(entities: DataFrame, denied: list[str], kind: str) -> DataFrame:
    """Drop the listed entities of one type."""
    return entities.filter(~((F.col("type") == kind) & F.col("entity").isin(denied)))


def keyword_classes(df: DataFrame, text: str, classes: dict[str, list[str]]) -> DataFrame:
    """Texts containing any word of each class, one row per class."""
    low = F.lower(F.coalesce(text, F.lit("")))
    counted = df.agg(*[F.count_if(low.rlike("|".join(words))).alias(name) for name, words in classes.items()])
    return counted.unpivot([], list(classes), "category", "posts")


def canonical_label(col, allowed: list[str], anywhere: bool = False) -> Column:
    """First token without punctuation if allowed, else ``unknown``; or the first allowed token anywhere."""
    tokens = F.transform(F.split(F.lower(strip(col)), r"\s+"),
                         lambda t: F.regexp_replace(t, r"^[^a-z_]+|[^a-z_]+$", ""))
    if anywhere:
        hits = F.filter(tokens, lambda t: t.isin(allowed))
        return F.coalesce(F.try_element_at(hits, F.lit(1)), F.lit("unknown"))
    head = F.try_element_at(tokens, F.lit(1))
    return F.when(head.isin(allowed), head).otherwise("unknown")
