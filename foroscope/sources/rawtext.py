"""Raw exports to rows: SQL dumps, concatenated JSON, room JSON, key-value blocks, delimited files."""

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foroscope.functions.text import local_part, strip
from foroscope.session import ship_by_value, stage

ship_by_value(__name__)


def fragments(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """Splittable read: text between separators with its place in the file."""
    return (spark.read.option("lineSep", separator).text(path)
            .select("value", F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("at")))


def _running(df: DataFrame, value: str, out: str, inclusive: bool) -> DataFrame:
    """Running sum along a file: inside each block, plus the totals of the blocks before it."""
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    ahead = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy("file", "block").agg(F.sum(value).alias("__s")).select(
        "file", "block", F.coalesce(F.sum("__s").over(ahead), F.lit(0)).alias("__off"))
    return (df.withColumn("__in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(totals, ["file", "block"])
            .withColumn(out, F.col("__in") + F.col("__off")).drop("__in", "__off"))


def joined_statements(frags: DataFrame, separator: str, quote: str) -> DataFrame:
    """Undo splits that fell inside a quoted string.

    A statement ends where the number of unescaped quotes since the start of the file is even. Counts are
    summed per file block first, so long files keep their parallelism. Quotes in comments ahead of a
    statement do not count.
    """
    bare = F.regexp_replace(F.regexp_replace("value", AHEAD, ""), r"(?s)\\.", "")
    odd = (F.length(bare) - F.length(F.replace(bare, F.lit(quote), F.lit("")))) % 2
    run = _running(frags.withColumn("odd", odd), "odd", "quotes", inclusive=True)
    run = run.withColumn("closed", F.when(F.col("quotes") % 2 == 0, 1).otherwise(0))
    run = _running(run, "closed", "statement", inclusive=False)
    return run.groupBy("file", "statement").agg(
        F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("parts")
    ).select("file", "statement",
             F.array_join(F.transform("parts", lambda p: p["value"]), separator).alias("text"))


# Comment lines and blocks ahead of a statement.
AHEAD = r"^(\s*(--[^\n]*\n|#[^\n]*\n|(?s:/\*(?!!).*?\*/);?))+"
# The backslash escapes of SQL dumps.
ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "0": "\0"}
_HEAD = re.compile(r"(?is)\binsert\s+(?:ignore\s+)?into\s+[`\"]?(\w+)[`\"]?\s*(?:\(([^)]*)\))?\s*values\s*")
_FIELD = re.compile(r"'([^'\\]*(?:(?:\\.|'')[^'\\]*)*)'|([(),])|([^\s(),'][^(),']*)", re.S)
_ESCAPE = re.compile(r"\\(.)|''", re.S)


def _unquote(text: str) -> str:
    return _ESCAPE.sub(lambda m: "'" if m.group(1) is None else ESCAPES.get(m.group(1), m.group(1)), text)


def _bare(text: str) -> str | None:
    text = text.strip()
    if text.upper() == "NULL":
        return None
    if re.fullmatch(r"0x(?:[0-9A-Fa-f]{2})+", text):
        return bytes.fromhex(text[2:]).decode("utf-8", "replace")
    return text


def _tuples(text: str, start: int) -> Iterator[list]:
    row, depth, value, seen = [], 0, None, False
    for m in _FIELD.finditer(text, start):
        quoted, mark, plain = m.groups()
        if mark == "(":
            depth += 1
            if depth == 1:
                row, value, seen = [], None, False
        elif mark == ")":
            depth -= 1
            if depth == 0:
                if seen or row:
                    row.append(value)
                yield row
        elif mark == ",":
            if depth == 1:
                row.append(value)
                value, seen = None, True
        elif depth:
            value, seen = (_unquote(quoted) if quoted is not None else _bare(plain)), True


def _insert_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for file, text in zip(pdf["file"], pdf["text"], strict=True):
            head = _HEAD.search(text)
            if head:
                names = [c.strip(" `\"\n") for c in head.group(2).split(",")] if head.group(2) else None
                out += [(file, head.group(1).removeprefix("vb_"), names, row) for row in _tuples(text, head.end())]
        yield pd.DataFrame(out, columns=["file", "table", "names", "row"])


def read_sql_dump(spark: SparkSession, path: str) -> DataFrame:
    """All inserted rows of one or more dumps: ``forum, table, fields`` with fields as map from column name to text.

    ``forum`` is the file name without its extension. An explicit column list of the INSERT wins over the CREATE TABLE of
    the same file; parts of a dump without one use the first of their folder. Rows of a table that is never created
    keep their place as name (``column_1`` and so on). Short rows are padded with NULL and long ones cut.
    """
    statements = joined_statements(fragments(spark, path, ";\n"), ";\n", "'").select("file", "text")
    statements = statements.withColumn("text", F.regexp_replace("text", AHEAD, ""))
    created = statements.filter(F.col("text").rlike(r"(?is)^\s*create\s+table")).select(
        "file", F.regexp_extract("text", r"(?is)create\s+table\s+(?:if\s+not\s+exists\s+)?[`\"]?(?:vb_)?(\w+)", 1)
        .alias("table"),
        F.regexp_extract_all("text", F.lit(r"(?m)^\s*[`\"](\w+)[`\"]\s+\w"), F.lit(1)).alias("created"))
    own = created.groupBy("file", "table").agg(F.min("created").alias("own"))
    folder = F.regexp_replace("file", r"[^/]*$", "")
    shared = own.groupBy(folder.alias("folder"), "table").agg(F.min_by("own", "file").alias("shared"))
    inserted = statements.filter(F.col("text").rlike(r"(?i)insert\s+(ignore\s+)?into")).mapInPandas(
        _insert_rows, "file string, table string, names array<string>, row array<string>")
    places = F.transform(F.sequence(F.lit(1), F.greatest(F.size("row"), F.lit(1))), lambda i: F.concat(F.lit("column_"), i))
    names = F.coalesce("names", "own", "shared", places)
    width = F.size(names)
    padded = F.slice(F.concat("row", F.array_repeat(F.lit(None).cast("string"), width)), F.lit(1), width)
    rows = inserted.join(own, ["file", "table"], "left").withColumn("folder", folder).join(
        shared, ["folder", "table"], "left")
    return rows.select(file_stem("file").alias("forum"), "table", F.map_from_arrays(names, padded).alias("fields"))


def dump_table(rows: DataFrame, table: str, columns: list[str], forum: bool = False) -> DataFrame:
    """Wanted columns of one dumped table, all text, and the dump they come from if asked for."""
    return rows.filter(F.col("table") == table).select(
        *["forum"] * forum, *[F.try_element_at("fields", F.lit(c)).alias(c) for c in columns])


def balanced_objects(frags: DataFrame) -> DataFrame:
    """Outermost ``{..}`` objects of fragments split at ``}``.

    Each fragment is a step of a state machine whose state is (inside a string, open braces). Its effect on the first part
    is its parity of unescaped quotes, on the second the braces outside of strings, so the states before each fragment
    are running sums, taken per file block first. An object ends where a fragment leaves no brace open.
    """
    def count(text, mark):
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    bare = F.regexp_replace("value", r"(?s)\\.", "")
    run = _running(frags.withColumn("quotes", count(bare, '"')), "quotes", "before", inclusive=False)
    outside = F.regexp_replace(F.concat(F.when(F.col("before") % 2 == 1, '"').otherwise(""), bare), r'"[^"]*("|$)', "")
    closes = F.when((F.col("before") + F.col("quotes")) % 2 == 0, 1).otherwise(0)
    run = _running(run.withColumn("closes", closes).withColumn("step", count(outside, "{") - closes), "step", "depth",
                   inclusive=True)
    run = run.withColumn("closed", F.when(F.col("depth") == 0, F.col("closes")).otherwise(0))
    run = _running(run, "closed", "object", inclusive=False)
    parts = run.groupBy("file", "object").agg(F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("parts"))
    return parts.select("file", F.concat(F.array_join(F.transform("parts", lambda p: p["value"]), "}"),
                                         F.lit("}")).alias("text"))


def read_concatenated_json(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Chat objects ``{..}{..}`` without separators; fields ts, from, to, body.

    Objects may hold further fields and nested objects; what does not parse is dropped."""
    objects = balanced_objects(fragments(spark, path, "}"))
    parsed = F.from_json(strip("text"), "ts string, `from` string, `to` string, body string, broken string",
                         {"columnNameOfCorruptRecord": "broken"})
    rows = objects.filter(F.col("text").contains("{")).select("file", parsed.alias("o")).filter("o.broken is null")
    rows = rows.select("file", "o.ts", F.col("o.from").alias("sender"), F.col("o.to").alias("receiver"), "o.body")
    return rows.select(
        F.expr("try_to_timestamp(ts)").alias("timestamp"),
        F.coalesce(F.substring_index("sender", "@", 1), F.lit("")).alias("username"),
        F.coalesce(F.substring_index("receiver", "@", 1), F.lit("")).alias("to_user"),
        F.coalesce("body", F.lit("")).alias("message"),
        F.lit(source).alias("source"), file_stem("file").alias("channel"))


def file_stem(col: str):
    """File name without its extension."""
    return F.regexp_replace(F.element_at(F.split(F.url_decode(col), "/"), -1), r"\.[^.]*$", "")


ROOM_SCHEMA = ("messages array<struct<ts:string, rid:string, msg:string, t:string, "
               "u:struct<username:string>>>, _corrupt_record string")


def read_room_json(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Room exports ``{"messages": [..]}``, one file per room and day; system events and broken files skipped."""
    files = (spark.read.schema(ROOM_SCHEMA).option("multiLine", "true").option("mode", "PERMISSIVE")
             .option("recursiveFileLookup", "true").json(path)
             .select("messages", F.col("_metadata.file_path").alias("file")))
    stem = file_stem("file")
    dated = F.regexp_extract(stem, r"^[^-]*-[^-]*-[^-]*-(.*)$", 1)
    rows = files.select("file", F.explode("messages").alias("m")).filter(F.coalesce("m.t", F.lit("")) == "")
    return rows.select(
        F.expr("try_to_timestamp(m.ts)").alias("timestamp"),
        F.coalesce("m.u.username", F.lit("")).alias("username"),
        F.coalesce("m.rid", F.lit("")).alias("to_user"), F.coalesce("m.msg", F.lit("")).alias("message"),
        F.lit(source).alias("source"), F.when(dated != "", dated).otherwise(stem).alias("channel"))


def read_kv_blocks(spark: SparkSession, path: str, source: str) -> DataFrame:
    """Blocks ``{ timestamp: .., chat_id: .., sender_alias: .., message: .. }`` with unquoted keys.

    A block holds no braces, so a read split at ``}`` is exact. Blocks lacking a field are dropped.
    """
    block = F.regexp_extract("value", r"(?s)\{([^{}]*)$", 1)
    raw = fragments(spark, path, "}").filter(F.col("value").contains("{")).select(block.alias("b"))

    def field(name):  # a value ends at the comma that closes its line
        return F.regexp_extract("b", rf"{name}:\s*(.+?),\s*\n", 1)

    rows = raw.filter(F.col("b").contains("message:")).select(
        strip(field("timestamp")).alias("ts"), strip(field("sender_alias")).alias("alias"),
        strip(field("chat_id")).alias("chat"),
        strip(F.regexp_extract("b", r"(?s)message:\s*(.*)", 1)).alias("message"))
    rows = rows.filter("ts <> '' and alias <> '' and chat <> ''")
    return rows.select(
        F.expr("try_to_timestamp(ts)").alias("timestamp"), local_part("alias").alias("username"),
        local_part("chat").alias("channel"), "message", F.lit(source).alias("source"))


# Delimiters tried in this order.
DELIMITERS = [":", "|", "\t", ";", ","]


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """Delimited user files, each with its own header line and delimiter: the first known one found in its header.

    The columns are those of all headers together, in lower case; a file without one of them has NULL there. Short rows
    are padded with NULL, surplus fields cut, blank lines skipped. A folder without lines gives no rows and no columns.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("at")).filter(F.trim("value") != "")
    place = F.struct("block", "at")
    first = lines.filter("block = 0").groupBy("file").agg(F.min_by("value", place).alias("header"), F.min(place).alias("top"))
    sep = F.lit(DELIMITERS[0])
    for d in reversed(DELIMITERS):
        sep = F.when(F.contains("header", F.lit(d)), F.lit(d)).otherwise(sep)
    first = stage(first.withColumn("sep", sep), "headers")  # one row a file
    width = first.agg(F.max(F.size(F.split("header", F.concat(F.lit("\\Q"), "sep", F.lit("\\E")))))).first()[0]
    if not width:
        return spark.createDataFrame([], "").select()
    schema = ", ".join(f"c{i} string" for i in range(width))

    def cells(line):
        """Fields of a line by the delimiter of its file."""
        out = F.lit(None).cast(f"struct<{schema.replace(' string', ':string')}>")
        for d in DELIMITERS:
            out = F.when(F.col("sep") == d, F.from_csv(line, schema, {"sep": d, "quote": '"', "escape": '"'})).otherwise(out)
        return out

    named = stage(first.withColumn("c", cells(F.col("header"))).select(
        "file", "top", "sep", F.transform(F.array(*[f"c.c{i}" for i in range(width)]), lambda x: F.lower(F.trim(x)))
        .alias("names")), "header-names")
    names = [r[0] for r in named.select(F.explode("names").alias("n")).filter("n is not null and n <> ''").groupBy("n")
             .agg(F.min(F.lit(1))).orderBy("n").collect()]  # the columns of the result
    rows = lines.join(named, "file").filter(place > F.col("top")).withColumn("c", cells(F.col("value")))
    rows = rows.select("names", F.array(*[f"c.c{i}" for i in range(width)]).alias("cells"))
    return rows.select(*[F.get("cells", F.array_position("names", F.lit(n)).cast("int") - 1).alias(n) for n in names])
