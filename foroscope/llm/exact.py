"""Exact dedup: local winners, winners of salted digest groups, global winners, whole texts compared at every stage.

Equal texts are grouped by (digest, salt, text) first. The map side of that aggregation keeps one row for each text
and salt of a task, and the salt, a hash of the id, spreads the copies of one text over ``SALTS`` reducers. Their
winners are grouped again by (digest, text). A group is always keyed by the whole text, so texts that share a digest
stay apart.

Results go back to the documents without their texts: ids are counted by (digest, salt) and joined with a copy of the
winner for each salt in use, so a group that holds a third of all rows is spread there too. Where a digest turns out to
have several texts, its documents are joined on the whole text instead. Only DataFrame functions are used.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foroscope.llm.common import id_text, row_key
from foroscope.session import stage

#: Reducers that share the copies of one text; the salts in use are one long's bits.
SALTS = 32
#: Rows that one element of an expanded array stands for, so no array grows with the number of repeated rows.
STRETCH = 1 << 16
SPACES = r"[\x20\x09-\x0D]+"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def keyed(docs: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    rows = docs.select(row_key(id_col).alias("id"), normalised(F.col(text_col)).alias("text"))
    return rows.select("id", "text", digest(F.col("text")).alias("digest"),
                       F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))


def text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """One row per distinct normalised text: digest, text, keep (smallest id, ``LAST_ID`` without one), group_size and
    the set of salts in use, as bits."""
    salted = keyed(docs, id_col, text_col, digest).groupBy("digest", "salt", "text").agg(
        F.min("id").alias("keep"), F.count("*").alias("n"))
    return salted.groupBy("digest", "text").agg(
        F.min("keep").alias("keep"), F.sum("n").alias("group_size"),
        F.expr("bit_or(shiftleft(1L, salt))").alias("salts"))


def join_back(rows: DataFrame, classes: DataFrame, on: list[str]) -> DataFrame:
    """Each (id, class) with its number of rows ``n`` and its winner; the winner is copied to every salt in use."""
    counted = rows.groupBy(*on, "salt", "id").agg(F.count("*").alias("n"))
    used = F.expr(f"filter(sequence(0, {SALTS - 1}), s -> (salts & shiftleft(1L, s)) != 0)")
    spread = classes.withColumn("salt", F.explode(used)).drop("salts")
    return counted.join(spread, [*on, "salt"])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """One row per document row: doc_id, keep_id (smallest id with an equal text), group_size, kept, text_sha256.

    Texts are equal when they are identical after each run of blanks became one space; null counts as empty. Rows
    without an id come after all others; a group that has no ids at all has a null keep_id. Of the rows that repeat
    both id and text exactly one is kept, and all of them count in group_size. An id that is repeated with another text
    is a row of that text's group. An empty table gives an empty result. Further columns are ignored. ``digest`` only
    deals texts into groups: a weak one costs time but changes no result.
    """
    classes = text_classes(docs, id_col, text_col, digest)
    slim = stage(classes.select("digest", "keep", "group_size", "salts", F.sha2("text", 256).alias("text_sha256")),
                 "exact-classes")
    shared = slim.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1").select("digest")
    rows = keyed(docs, id_col, text_col, digest)
    if shared.isEmpty():
        found = join_back(rows.drop("text"), slim, ["digest"])
    else:
        shared = stage(shared, "exact-shared")
        plain = join_back(rows.drop("text").join(shared, "digest", "left_anti"), slim.join(shared, "digest", "left_anti"),
                          ["digest"])
        several = join_back(rows.join(shared, "digest", "left_semi"), classes.join(shared, "digest", "left_semi")
                            .withColumn("text_sha256", F.sha2("text", 256)), ["digest", "text"])
        found = plain.unionByName(several.drop("text"))
    # rows that repeat id and text were counted together and are dealt out again, the first of them kept
    last = F.floor((F.col("n") - 1) / STRETCH)
    parts = found.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    size = F.least(F.lit(STRETCH).cast("long"), F.col("n") - F.col("part") * STRETCH)
    out = parts.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), size)))
    return out.select(
        id_text("id").alias("doc_id"), id_text("keep").alias("keep_id"), "group_size",
        ((F.col("id") == F.col("keep")) & (F.col("part") == 0) & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept texts: doc_id, normalised text, group_size; one row for each group of equal texts."""
    return text_classes(docs, id_col, text_col).select(id_text("keep").alias("doc_id"), "text", "group_size")


ORACLE = r"""
with rows as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents),
classes as (select body, min(doc_id) as keep_id, count(*) as group_size from rows group by body)
select r.doc_id, c.keep_id, c.group_size,
       r.doc_id = c.keep_id and row_number() over (partition by r.body order by r.doc_id) = 1 as kept,
       sha256(r.body) as text_sha256
from rows r join classes c on r.body = c.body
"""