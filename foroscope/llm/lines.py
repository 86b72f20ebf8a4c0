"""Line dedup: hashed lines in range partitions, first occurrences streamed, keep bitmaps per document.

Lines travel as two 64-bit hashes with document and position. They are range-partitioned by (hash, document), so a
line that a third of all documents hold is spread over many partitions, sorted inside each, and read as a stream that
remembers the first document of the current hash. Only the first hash of a partition may have begun in an earlier
partition; its rows stay open until the first documents that all partitions report for their outermost hashes (two
rows for each partition) have been put together.
"""

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foroscope.llm.common import LOWER, row_key, ship_by_value, texts_of, to_batch
from foroscope.session import stage

ship_by_value(__name__)

SPACE = b" \t\n\x0b\x0c\r"
LINES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("id", pa.int64()), ("version", pa.int64()),
                   ("pos", pa.int32())])
FOUND = pa.schema([("kind", pa.int8()), *LINES])
DROP, OPEN, HEAD = 0, 1, 2


def line_keys(text: bytes) -> list[bytes]:
    return [line.strip(SPACE) for line in text.translate(LOWER).split(b"\n")]


def code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "replace"))


def hash_lines(min_chars: int):
    def run(batches):
        for batch in batches:
            hashes, ids, versions, places = [], [], [], []
            texts = texts_of(batch)
            for text, doc, version in zip(texts, batch.column("id").to_pylist(), batch.column("version").to_pylist(),
                                          strict=True):
                for pos, key in enumerate(line_keys(text)):
                    if len(key) >= min_chars and code_points(key) >= min_chars:
                        hashes.append(xxhash.xxh3_128_digest(key))
                        ids.append(doc)
                        versions.append(version)
                        places.append(pos)
            both = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            yield to_batch(LINES, both[:, 0], both[:, 1], ids, versions, places)
    return run


def stream_first(batches):
    """Rows of one partition in order of hash, document and position: what is dropped, open or reported."""
    last, first, leading = None, None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc = (batch.column(c).to_numpy() for c in ("h1", "h2", "id"))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        goes_on = last == (h1[0], h2[0])
        new[0] = not goes_on
        group = np.cumsum(new)  # 0: goes on from the batch before
        heads = np.concatenate([[first if goes_on else 0], doc[new]])
        firsts = heads[group]
        kind = np.full(len(h1), -1, np.int8)
        kind[doc > firsts] = DROP
        if leading:
            started = 0 if last is not None else 1
            ends = np.flatnonzero(group > started)
            stop = ends[0] if len(ends) else len(h1)
            kind[:stop] = OPEN
            if len(ends):  # the leading hash ends here
                yield head(*(last if stop == 0 else (h1[0], h2[0])), firsts[stop - 1] if stop else first)
                leading = False
        last, first = (h1[-1], h2[-1]), firsts[-1]
        rows = np.flatnonzero(kind >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(kind[rows]), *(c.take(pa.array(rows)) for c in batch.columns)],
                                         schema=FOUND)
    if last is not None:
        yield head(*last, first)


def head(h1, h2, first) -> pa.RecordBatch:
    return to_batch(FOUND, [HEAD], [h1], [h2], [first], [0], [0])


def with_version(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id, text and its hash: rows that share an id but not the text have their own bitmaps."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(row_key(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("version"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """(id, version, pos) of each line whose key is found in a document with a smaller id."""
    hashed = with_version(docs, id_col, text_col).mapInArrow(hash_lines(min_chars), LINES_SQL)
    ordered = hashed.repartitionByRange("h1", "h2", "id").sortWithinPartitions("h1", "h2", "id", "version", "pos")
    found = stage(ordered.mapInArrow(stream_first, FOUND_SQL), "lines")
    heads = found.filter(F.col("kind") == HEAD).groupBy("h1", "h2").agg(F.min("id").alias("first"))
    late = found.filter(F.col("kind") == OPEN).join(F.broadcast(heads), ["h1", "h2"]).filter("id > first")
    return found.filter(F.col("kind") == DROP).select("id", "version", "pos").unionByName(
        late.select("id", "version", "pos"))


LINES_SQL = "h1 long, h2 long, id long, version long, pos int"
FOUND_SQL = "kind byte, " + LINES_SQL


def pack(batches):
    out = pa.schema([("id", pa.int64()), ("version", pa.int64()), ("keep", pa.binary())])
    for batch in batches:
        maps = []
        for places in batch.column("places").to_pylist():
            bits = np.ones(max(places) + 1, np.uint8)
            bits[places] = 0
            maps.append(zlib.compress(len(bits).to_bytes(8, "little") + np.packbits(bits).tobytes()))
        yield to_batch(out, batch.column("id"), batch.column("version"), maps)


def unpack(keep: bytes | None, n: int) -> np.ndarray:
    """Keep flags of ``n`` lines; lines beyond the map are kept."""
    flags = np.ones(n, bool)
    if keep is not None:
        raw = zlib.decompress(keep)
        size = int.from_bytes(raw[:8], "little")
        flags[:size] = np.unpackbits(np.frombuffer(raw, np.uint8, offset=8))[:size]
    return flags


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """Line dedup of whole documents: (id, version, keep), one row for each document that loses lines.

    The key of a line is its text without blanks at both ends and with A-Z in lower case. Keys of at least
    ``min_chars`` code points found in several documents lose all lines but those of the smallest id that holds them.
    ``keep`` is a compressed bitmap up to the last dropped line; ``version`` is the hash of the document's text.

    Null and empty texts have one empty line, which stays. Rows without an id count as one document behind all
    others. Rows that repeat an id count as one document: a line repeated among them stays. An empty table gives an
    empty result; further columns are ignored.
    """
    gone = dropped_lines(docs, id_col, text_col, min_chars).distinct()
    return gone.groupBy("id", "version").agg(F.collect_list("pos").alias("places")).mapInArrow(
        pack, "id long, version long, keep binary")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The given rows with dropped lines taken out of their text, plus ``n_lines`` and ``n_dropped``."""
    kind = "n_lines long, n_dropped long, kept string"
    rows = docs.withColumn("__id", row_key(id_col)).withColumn("__text", F.coalesce(F.col(text_col), F.lit("")))
    rows = rows.withColumn("__version", F.xxhash64("__text"))
    maps = bitmaps.toDF("__id", "__version", "__keep")
    joined = rows.join(maps, ["__id", "__version"], "left")
    done = F.pandas_udf(keep_lines, kind)(F.col("__text"), F.col("__keep"))
    return joined.withColumn("__done", done).withColumns({
        text_col: F.when(F.col("__done.n_dropped") > 0, F.col("__done.kept")).otherwise(F.col(text_col)),
        "n_lines": F.col("__done.n_lines"), "n_dropped": F.col("__done.n_dropped"),
    }).drop("__id", "__version", "__keep", "__done", "__text")


def keep_lines(text, keep):
    import pandas as pd

    counts, dropped, kept = [], [], []
    for t, k in zip(text, keep, strict=True):
        if k is None:
            counts.append(t.count("\n") + 1)
            dropped.append(0)
            kept.append(None)  # unchanged
            continue
        lines = t.split("\n")
        flags = unpack(k, len(lines))
        counts.append(len(lines))
        dropped.append(int((~flags).sum()))
        kept.append("\n".join(line for line, stays in zip(lines, flags, strict=True) if stays))
    return pd.DataFrame({"n_lines": counts, "n_dropped": dropped, "kept": kept}).astype(
        {"n_lines": "int64", "n_dropped": "int64", "kept": "object"})


def line_dedup(docs: DataFrame) -> DataFrame:
    """Digest of line dedup over ``documents``: doc_id, n_lines, n_dropped, kept_sha256."""
    slim = docs.select("doc_id", "text")
    cleaned = apply_bitmaps(slim, keep_bitmaps(slim))
    return cleaned.select("doc_id", "n_lines", "n_dropped",
                          F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def stage_lines(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated lines leave the texts; documents stay, empty if all their lines were repeats."""
    return apply_bitmaps(docs, keep_bitmaps(docs)).select(*docs.columns)


ORACLE = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
firsts as (select key, min(doc_id) as first_doc, count(distinct doc_id) as n from keyed
           where length(key) >= 10 group by key),
marked as (select k.*, coalesce(f.n >= 2 and k.doc_id > f.first_doc, false) as gone
           from keyed k left join firsts f on k.key = f.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""
