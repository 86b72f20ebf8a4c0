"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 60-bit hash of its id. Words are summed by source and by the top bits of the hash; the running sum
over the (at most 4096) buckets of a source shows the one in which its budget ends. Only that bucket is split by the
next bits, until a single hash value is left. The result is one threshold for each source, and the mix is a filter on
the hash: nothing is sorted, no group is gathered, and a larger budget keeps all that a smaller one takes.
"""

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foroscope.llm.common import id_text, row_key, ship_by_value, texts_of, to_batch
from foroscope.session import stage

ship_by_value(__name__)

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # all targets together are 3/2 of all words
MOST = 2  # and no target is above this multiple of its source
BITS, LEVELS = 12, 5
SEED = 42
SIZES = pa.schema([("id", pa.int64()), ("source", pa.string()), ("size", pa.int64())])


def hash_of(doc: Column, seed: int = SEED) -> Column:
    """First 60 bits of the md5 of seed and id."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), doc.cast("string"))), 1, 15), 16, 10).cast("long")


def count_words(batches):
    for batch in batches:
        yield to_batch(SIZES, batch.column("id"), batch.column("source"), [len(t.split()) for t in texts_of(batch)])


def targets(sources: DataFrame, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, source_size) to (source, source_size, target), one row per source.

    Sources by code point, null last, weigh ``weights`` in turn. A target is weight times a common level, at most
    twice the source. The sources at that limit are those with the smallest size per weight: with these put first,
    the level that the others get is known at each place, and the first place that it does not overflow is right.
    Integers up to the last division, so results repeat exactly.
    """
    # one row per source: the list of sources is a setting of the mix, not data that grows with documents
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    ahead = by_room.rowsBetween(Window.unboundedPreceding, -1)
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1))
    num, den = SHARE
    out = sources.withColumn("weight", weight.cast("long"))
    every = Window.partitionBy()
    out = out.withColumns({
        "budget": num * F.sum("source_size").over(every) - den * MOST * F.coalesce(
            F.sum("source_size").over(ahead), F.lit(0)),
        "rest": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(ahead), F.lit(0)),
    })
    fits = F.col("weight") * F.col("budget") <= MOST * den * F.col("source_size") * F.col("rest")
    # the rest of the weights falls from place to place
    out = out.withColumn("level", F.max(F.when(fits, F.struct("rest", "budget"))).over(every))
    share = F.col("weight") * F.col("level.budget") / (den * F.col("level.rest"))
    target = F.least(share, (MOST * F.col("source_size")).cast("double"))
    return out.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def same_source(a: str, b: str):
    return F.col(a).eqNullSafe(F.col(b))


def thresholds(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, copies, edge): all documents are taken ``copies`` times, those with a hash below ``edge`` once more."""
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = stage(plan.withColumn("copies", copies.cast("int")).select(
        "source", "source_size", "target", "copies", (F.col("target") - F.col("copies") * F.col("source_size")).alias("room"),
        F.lit(0).cast("long").alias("before"), F.lit(0).cast("long").alias("prefix"),
        (F.col("target") > F.col("copies") * F.col("source_size")).alias("open")), "mix")
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        now = state.filter("open").select(F.col("source").alias("s"), F.col("prefix").alias("p"))
        inside = sizes.join(now, same_source("source", "s") & (
            F.shiftright("hash", shift + BITS) == F.col("p"))).select("source", "size", "hash")
        bins = inside.groupBy("source", F.shiftright("hash", shift).alias("bin")).agg(F.sum("size").alias("n"))
        order = Window.partitionBy("source").orderBy("bin")  # at most 4096 rows of a source
        bins = bins.withColumn("upto", F.sum("n").over(order)).select(F.col("source").alias("s"), "bin", "n", "upto")
        met = state.filter("open").join(bins, same_source("source", "s")).filter(
            F.col("before") + F.col("upto") >= F.col("room"))
        # the first bin that reaches the budget
        edge = met.groupBy("source").agg(F.min(F.struct("bin", "n", "upto")).alias("e")).withColumnRenamed("source", "s")
        joined = state.join(edge, same_source("source", "s") & F.col("open"), "left")
        low = F.col("before") + F.col("e.upto") - F.col("e.n")
        state = stage(joined.select(
            "source", "source_size", "target", "copies", "room", F.coalesce(low, F.col("before")).alias("before"),
            F.coalesce(F.col("e.bin"), F.col("prefix")).alias("prefix"), (F.col("open") & F.col("e").isNotNull()).alias(
                "open"), F.col("e.n").alias("last")), "mix")
    # one hash is left: it is taken if that comes nearer to the budget
    nearer = 2 * F.col("before") + F.col("last") < 2 * F.col("room")
    edge = F.when(F.col("open"), F.col("prefix") + F.when(nearer, 1).otherwise(0)).otherwise(F.lit(0))
    return state.select("source", "source_size", "target", "copies", edge.cast("long").alias("edge"))


def measure(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    rows = docs.select(row_key(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                       F.col(text_col).alias("text"))
    sizes = rows.mapInArrow(count_words, "id long, source string, size long")
    return stage(sizes.withColumn("hash", hash_of(F.col("id"), seed)), "sizes")


def copies_of(hashed: Column) -> Column:
    return (F.col("copies") + F.when(hashed < F.col("edge"), 1).otherwise(0)).cast("int")


def mix_plan(sizes: DataFrame, weights: tuple) -> DataFrame:
    plan = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    return thresholds(sizes, plan).withColumnRenamed("source", "__source")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = WEIGHTS, seed: int = SEED) -> DataFrame:
    """Mix all documents to the target words of their sources: (id, source, size, source_size, target, copies, taken).

    ``size`` counts runs of bytes other than blank and \\t to \\r. A document is taken 0, 1 or 2 times. ``taken`` of
    a source differs from its target by at most half of one document (of one hash) at the threshold.

    Null and empty texts have size 0 and take no words. Null is a source of its own, last in order. Rows that repeat
    an id share its hash, so they are taken together; rows without an id share one hash too. Runs with the same seed
    give the same mix. An empty table gives an empty result; further columns are ignored.
    """
    sizes = measure(docs, id_col, text_col, source_col, seed)
    rows = sizes.join(mix_plan(sizes, weights), same_source("source", "__source"))
    rows = rows.withColumn("copies", copies_of(F.col("hash")))
    return rows.select("id", "source", "size", "source_size", "target", "copies",
                       (F.col("size") * F.col("copies")).alias("taken"))


def source_mix(docs: DataFrame) -> DataFrame:
    """Digest of the mix over ``documents``."""
    return mix(docs).select(id_text("id").alias("doc_id"), "size", "source_size", "target", "taken")


def stage_mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the documents that the mix takes, with the number of ``copies``."""
    plan = mix_plan(measure(docs, "doc_id", "text", "source", SEED), WEIGHTS)
    plan = plan.select("__source", F.col("copies").alias("__copies"), F.col("edge").alias("__edge"))
    again = F.when(hash_of(row_key("doc_id")) < F.col("__edge"), 1).otherwise(0)
    rows = docs.join(plan, same_source("source", "__source")).withColumn(
        "__copies", (F.col("__copies") + again).cast("int")).filter("__copies > 0")
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns if c != "copies"), F.col("__copies").alias("copies"))


ORACLE = r"""
with sizes as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
         cast('0x' || substr(md5('42:' || cast(coalesce(doc_id, 9223372036854775807) as varchar)), 1, 15) as bigint) as h
  from documents),
sources as (
  select source, sum(size)::bigint as source_size,
         [5, 2, 1][1 + (row_number() over (order by source is null, source) - 1) % 3] as w
  from sizes group by source),
placed as (
  select *, 3 * sum(source_size) over () - 4 * coalesce(sum(source_size) over ahead, 0) as budget,
         sum(w) over () - coalesce(sum(w) over ahead, 0) as rest
  from sources window ahead as (order by source_size / w, source is null, source
                                rows between unbounded preceding and 1 preceding)),
level as (
  select budget, rest from placed where w * budget <= 4 * source_size * rest order by rest desc limit 1),
plan as (
  select source, source_size,
         coalesce(least((w * level.budget)::double / (2 * level.rest)::double, (2 * source_size)::double), 0) as target
  from placed left join level on true),
parts as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end as copies from plan),
ranked as (
  select s.doc_id, s.size, p.source_size, p.target, p.copies, p.target - p.copies * p.source_size as room,
         sum(s.size) over (partition by s.source order by s.h) as upto,
         sum(s.size) over (partition by s.source, s.h) as own
  from sizes s join parts p on s.source is not distinct from p.source)
select doc_id, size, source_size, target,
       (size * (copies + case when 2 * upto - own < 2 * room then 1 else 0 end))::bigint as taken
from ranked
"""
