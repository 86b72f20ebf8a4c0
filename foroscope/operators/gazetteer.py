"""Mentions of the terms of a large list in texts, longest match first."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foroscope.session import stage

TOKEN = r"[\p{L}\p{N}_]+"

# Bits for each phrase in the marks of a list, and all bits at most (32 MB). A row of marks has 4096 bits in 64 words; a hash
# sets three bits of a row.
BITS, MOST_BITS, ROW_BITS, PLACES = 16, 1 << 28, 4096, (28, 40, 52)


def tokens(text) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({TOKEN})"), F.lit(1))


def runs(words: Column, n: int) -> Column:
    """Every run of ``n`` words of an array of :func:`tokens`, joined by blanks, in one pass of a pattern that looks ahead
    by n words and moves by one."""
    ahead = " ".join(["[^ ]++"] * n)
    return F.regexp_extract_all(F.array_join(words, " "), F.lit(f"(?<![^ ])(?=({ahead}))[^ ]++"), F.lit(1))


def gazetteer(terms: DataFrame, term: str, label: str) -> DataFrame:
    """Terms as runs of lower-case words: n, hash, phrase, label. Of equal phrases the smallest label counts; terms
    without a word are none."""
    words = terms.select(tokens(F.col(term)).alias("t"), F.col(label).cast("string").alias("label")).filter("size(t) > 0")
    phrases = words.groupBy(F.array_join("t", " ").alias("phrase"), F.size("t").alias("n")).agg(F.min("label").alias("label"))
    return phrases.select("n", F.xxhash64("phrase").alias("hash"), "phrase", "label")


def bits_of(hashed: Column) -> list[tuple[Column, Column]]:
    """Word and bit of each of the places of a hash in its row of marks."""
    places = [F.shiftrightunsigned(hashed, p).bitwiseAND(F.lit(ROW_BITS - 1).cast("long")).cast("int") for p in PLACES]
    return [(F.shiftright(p, 6), p.bitwiseAND(F.lit(63))) for p in places]


def marks(listed: DataFrame) -> tuple[DataFrame, int]:
    """Rows (part, marks) of bits set by the hashes of a list, and their number, which does not grow beyond a limit."""
    parts, wanted = 1, BITS * listed.count()
    while parts * ROW_BITS < min(wanted, MOST_BITS):
        parts *= 2
    bits = F.explode(F.array(*[F.struct(w.alias("word"), b.alias("bit")) for w, b in bits_of(F.col("hash"))])).alias("b")
    words = listed.select(F.col("hash").bitwiseAND(F.lit(parts - 1).cast("long")).alias("part"), bits).groupBy(
        "part", F.col("b.word").alias("word")).agg(F.expr("bit_or(shiftleft(1L, b.bit))").alias("m"))
    found = words.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("word", "m"))).alias("found"))
    row = F.transform(F.sequence(F.lit(0), F.lit(ROW_BITS // 64 - 1)),
                      lambda w: F.coalesce(F.try_element_at("found", w), F.lit(0)))
    return stage(found.select("part", row.alias("marks")), "marks"), parts


def marked(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows whose hash may be in the list: all that are, and some others."""
    table, parts = marks(listed)
    met = rows.withColumn("part", F.col("hash").bitwiseAND(F.lit(parts - 1).cast("long"))).join(F.broadcast(table), "part")
    for word, bit in bits_of(F.col("hash")):
        met = met.filter(F.getbit(F.get("marks", word), bit) == 1)
    return met.select(*rows.columns)


def candidates(texts: DataFrame, key: str, text: str, listed: DataFrame) -> DataFrame:
    """Longest listed phrase at each word of each text: key, pos (from 0), n, phrase, label.

    Every run of words as long as some phrase becomes one row with its hash, which meets the list in an equi-join: the list
    is only broadcast where the optimizer finds it small. Equal hashes are compared as text. Only runs whose bit is set in
    the marks of the list, which are of bounded size and go to all tasks, are shuffled to it."""
    lengths = [r["n"] for r in listed.select("n").distinct().orderBy("n").collect()]  # word counts, a few numbers
    if not lengths:
        return texts.select(key, F.lit(0).alias("pos"), F.lit(0).alias("n"), F.lit("").alias("phrase"), F.lit("").alias("label")).limit(0)
    rows = texts.select(key, tokens(F.col(text)).alias("t"))
    # explode_outer: the filter that a plain explode implies would tokenise again for every run
    every = rows.select(key, F.size("t").alias("words"), F.posexplode_outer(
        F.concat(*[runs(F.col("t"), n) for n in lengths])).alias("at", "phrase")).filter("phrase is not null")
    # the runs of each length follow one another
    n, pos, before = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(0)
    for size in lengths:
        n = F.when((F.col("at") >= before) & (F.col("words") >= size), F.lit(size)).otherwise(n)
        pos = F.when((F.col("at") >= before) & (F.col("words") >= size), F.col("at") - before).otherwise(pos)
        before = before + F.greatest(F.col("words") - size + 1, F.lit(0))
    rows = every.select(key, pos.alias("pos"), n.alias("n"), "phrase", F.xxhash64("phrase").alias("hash"))
    # the hash leads, so that rows are sorted by a number
    met = marked(rows, listed).alias("a").join(
        listed.alias("b"), (F.col("a.hash") == F.col("b.hash")) & (F.col("a.phrase") == F.col("b.phrase")))
    best = Window.partitionBy(key, "pos").orderBy(F.desc("n"))
    # dealt by text, as mentions need them
    found = met.select(f"a.{key}", "a.pos", "a.n", "a.phrase", "b.label").repartition(key)
    return found.withColumn("r", F.row_number().over(best)).filter("r = 1").drop("r")


def mentions(texts: DataFrame, key: str, text: str, listed: DataFrame) -> DataFrame:
    """Leftmost longest mentions without overlap: key, pos, n, phrase, label. Keys of texts are unique.

    Candidates of a text fall into islands of overlapping ones; only inside an island, a few words long, one choice depends
    on the one before it."""
    rows = candidates(texts, key, text, listed)
    order = Window.partitionBy(key).orderBy("pos")
    reach = F.max(F.col("pos") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = rows.withColumn("opens", F.coalesce(reach <= F.col("pos"), F.lit(True)).cast("int"))
    islands = opened.withColumn("island", F.sum("opens").over(order)).groupBy(key, "island").agg(
        F.sort_array(F.collect_list(F.struct("pos", "n", "phrase", "label"))).alias("m"))
    start = F.struct(F.lit(0).alias("end"), F.filter("m", lambda x: F.lit(False)).alias("kept"))
    walk = F.aggregate("m", start, lambda s, x: F.when(x["pos"] >= s["end"], F.struct(
        (x["pos"] + x["n"]).alias("end"), F.concat(s["kept"], F.array(x)).alias("kept"))).otherwise(s))
    return islands.select(key, F.explode(walk["kept"]).alias("m")).select(key, "m.*")
