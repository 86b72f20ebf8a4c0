"""Benchmark decontamination: suffix arrays of training shards, searched for every benchmark suffix.

A shard is a run of consecutive documents inside one task. Words that no benchmark item holds end every match, so only
positions that begin a long enough run of benchmark words enter the shard's suffix array. It is sorted to the depth of
one window, and a binary search for each distinct benchmark window (a suffix cut at the window's length) gives the
range of its occurrences. Documents are never shuffled. The benchmark is read in blocks of bounded size, each its own
broadcast; every shard is searched for all blocks.
"""

import hashlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foroscope.llm.common import id_text, row_key, ship_by_value, texts_of, to_batch

ship_by_value(__name__)

#: Word bytes stay (letters in lower case, digits, everything beyond ASCII), all others become blanks.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                   for b in range(256))
WINDOW = 13
BLOCK_BYTES = 8 << 20
SHARD_WORDS = 1 << 20
BITS = 21  # a word number; a block of 8 MB has fewer than 2 ** 21 distinct words after word 0
PER_KEY = 3  # word numbers packed in one 64-bit key
RESULT = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                    ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("longest", pa.int64()),
                    ("longest_at", pa.int64()), ("items", pa.list_(pa.string()))])
RESULT_SQL = ("id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
              "longest long, longest_at long, items array<string>")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Block:
    """Distinct windows of some benchmark items, by length, and the items each belongs to."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names = [item for item, _ in items]
        self.window = window
        windows: dict[int, list] = {}
        for owner, (_, text) in enumerate(items):
            numbers = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)], np.int64)
            if len(numbers):
                n = min(len(numbers), window)
                own = pack(np.lib.stride_tricks.sliding_window_view(numbers, n), n)
                windows.setdefault(n, []).append((own, np.full(len(own), owner)))
        if len(self.vocabulary) >= 1 << BITS:
            raise ValueError("a benchmark block has too many distinct words: lower block_bytes")
        self.by_length = {}
        for n, parts in sorted(windows.items()):
            keys, owners = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((owners, *keys.T[::-1]))
            keys, owners = keys[order], owners[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
            again = np.concatenate([[False], ~new[1:] & (owners[1:] == owners[:-1])])
            keys, owners, new = keys[~again], owners[~again], new[~again]
            starts = np.append(np.flatnonzero(new), len(new))
            self.by_length[n] = keys[starts[:-1]], starts, owners

    def items_of(self, n: int, window: int) -> list:
        _, starts, owners = self.by_length[n]
        return [self.names[i] for i in owners[starts[window]:starts[window + 1]].tolist()]

    def search(self, texts_words: list[list[bytes]]):
        """For each window length: (positions in the shard, window numbers) of all occurrences."""
        get = self.vocabulary.get
        total = sum(map(len, texts_words)) + len(texts_words)
        shard = np.zeros(total + self.window, np.int64)  # a 0 behind each document: no match goes on
        at = 0
        for words in texts_words:
            shard[at:at + len(words)] = np.fromiter(map(get, words, repeat(0)), np.int64, len(words))
            at += len(words) + 1
        stops = np.flatnonzero(shard == 0)
        places = np.flatnonzero(shard)
        run = stops[np.searchsorted(stops, places)] - places
        for n, (wanted, *_) in self.by_length.items():
            # suffixes of at least n benchmark words, in order of their first n
            suffixes = places[run >= n]
            keys = pack(shard[suffixes[:, None] + np.arange(n)], n) if len(suffixes) else np.zeros((0, 1), np.int64)
            order = np.lexsort(keys.T[::-1])
            suffixes, keys = suffixes[order], keys[order]
            low, high = bounds(keys, wanted) if len(suffixes) else (np.zeros(len(wanted), np.int64),) * 2
            count = high - low
            rank = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            yield n, suffixes[rank], np.repeat(np.arange(len(wanted)), count)


def pack(numbers: np.ndarray, n: int) -> np.ndarray:
    """Rows of word numbers as rows of 64-bit keys in the same order."""
    keys = []
    for i in range(0, n, PER_KEY):
        key = np.zeros(len(numbers), np.int64)
        for j in range(i, min(i + PER_KEY, n)):
            key = key << BITS | numbers[:, j]
        keys.append(key)
    return np.stack(keys, 1)


def bounds(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of all wanted rows at once: first suffix not below, first suffix above."""
    found = []
    for above in (False, True):
        low, high = np.zeros(len(wanted), np.int64), np.full(len(wanted), len(keys))
        while (open_ := low < high).any():
            middle = (low + high) // 2
            row = keys[np.minimum(middle, len(keys) - 1)]
            less, same = np.zeros(len(wanted), bool), np.ones(len(wanted), bool)
            for c in range(keys.shape[1]):
                less |= same & (row[:, c] < wanted[:, c])
                same &= row[:, c] == wanted[:, c]
            right = less | same if above else less
            low = np.where(open_ & right, middle + 1, low)
            high = np.where(open_ & ~right, middle, high)
        found.append(low)
    return found[0], found[1]


def search_shard(texts_words: list[list[bytes]], blocks) -> list[tuple]:
    """Per document: words, hit words, items, longest verbatim stretch and where it begins."""
    sizes = np.array([len(w) for w in texts_words], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    total = int((sizes + 1).sum())
    edges, starts = np.zeros(total + 1, np.int64), np.zeros(total, np.int64)
    items: list[set] = [set() for _ in texts_words]
    for block in blocks:
        for n, places, windows in block.search(texts_words):
            if not len(places):
                continue
            np.add.at(edges, places, 1)
            np.add.at(edges, places + n, -1)
            np.maximum.at(starts, places, n)
            docs = np.searchsorted(begins, places, "right") - 1
            pairs = np.unique(np.stack([docs, windows], 1), axis=0)
            for doc, w in pairs.tolist():
                items[doc].update(block.items_of(n, w))
    hit = np.cumsum(edges[:-1]) > 0
    sums = np.concatenate([[0], np.cumsum(hit)])
    # a stretch: windows that begin word after word
    begin = np.flatnonzero(starts)
    first = begin[np.concatenate([[True], np.diff(begin) > 1])] if len(begin) else begin
    last = begin[np.concatenate([np.diff(begin) > 1, [True]])] if len(begin) else begin
    best: dict[int, tuple[int, int]] = {}
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        doc = int(np.searchsorted(begins, a, "right") - 1)
        best[doc] = max(best.get(doc, (0, 0)), (b + int(starts[b]) - a, int(begins[doc]) - a))
    out = []
    for i, n in enumerate(sizes.tolist()):
        found = int(sums[begins[i] + n] - sums[begins[i]])
        longest, at = best.get(i, (0, None))
        names = sorted({x for x in items[i] if x is not None})
        out.append((n, found, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                    found > 0 and 20 * found >= n, longest, None if at is None else -at, names))
    return out


def run_shards(blocks):
    def run(batches):
        for batch in batches:
            ids, texts, done = batch.column("id"), texts_of(batch), []
            shard, size = [], 0
            for text in texts:
                shard.append(words_of(text))
                size += len(shard[-1])
                if size >= SHARD_WORDS:
                    done += search_shard(shard, (b.value for b in blocks))
                    shard, size = [], 0
            if shard:
                done += search_shard(shard, (b.value for b in blocks))
            yield to_batch(RESULT, ids, *(list(c) for c in zip(*done, strict=True))) if done else pa.RecordBatch.from_pylist(
                [], RESULT)
    return run


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int) -> list:
    """The benchmark in broadcasts of at most about ``block_bytes`` of text, dealt by a hash; larger items stay whole."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"),
                             F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes)
    spark = benchmark.sparkSession
    blocks = []
    for i in range(n):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i).collect()
        blocks.append(spark.sparkContext.broadcast(Block([(r.item, r.text.encode()) for r in part], window)))
    return blocks


def search_benchmark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row: what the benchmark shares with its whole text.

    A window is ``window`` consecutive words of an item, or all words of a shorter item. A document word inside an
    occurrence of any window is hit. ``longest`` is the longest verbatim stretch in words (windows that begin word
    after word), ``longest_at`` the word where the first such begins (null without hits).

    Null and empty texts have no words and no hits; an item without words has no window. Items with a null id count
    for hits but are not listed. Repeated rows get repeated results; an empty benchmark finds nothing, an empty table
    gives an empty result. Further columns are ignored.
    """
    blocks = benchmark_blocks(benchmark, item_col, item_text_col, window, block_bytes)
    rows = docs.select(row_key(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run_shards(blocks), RESULT_SQL)


def benchmark_overlap(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest of the search over ``documents``."""
    found = search_benchmark(docs, benchmark)
    return found.select(id_text("id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
                        "longest", "longest_at")


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text is not contaminated, unchanged."""
    blocks = benchmark_blocks(benchmark, "item_id", "text", WINDOW, BLOCK_BYTES)

    def keep(texts):
        import pandas as pd

        shards = run_shards(blocks)
        batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(len(texts), np.int64)), pa.array(texts, pa.string())],
                                           names=["id", "text"])
        return pd.Series([x for out in shards([batch]) for x in out.column("contaminated").to_pylist()], dtype=bool)

    return docs.filter(~F.pandas_udf(keep, "boolean")("text"))


def stage_decontaminate(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: contaminated documents go."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item_words as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (
  select distinct item_id, least(len(w), 13) as n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') as win
  from (select item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) as i from item_words where len(w) > 0)),
lengths as (select distinct n from windows),
places as (
  select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as i from words, lengths where len(w) >= n),
hits as (
  select p.doc_id, p.i, p.n, x.item_id from places p join windows x
  on p.n = x.n and array_to_string(p.w[p.i:p.i + p.n - 1], ' ') = x.win),
covered as (
  select doc_id, count(distinct j) as n_hit from (
    select doc_id, unnest(generate_series(i, i + n - 1)) as j from hits) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (
    select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id),
starts as (
  select doc_id, i, max(n) as n, i - row_number() over (partition by doc_id order by i) as run
  from hits group by doc_id, i),
runs as (select doc_id, min(i) as a, max(i) + arg_max(n, i) - min(i) as size from starts group by doc_id, run),
longest as (select doc_id, max(size) as longest, arg_min(a, (-size, a)) - 1 as longest_at from runs group by doc_id)
select w.doc_id, len(w.w) as n_words, coalesce(c.n_hit, 0) as n_hit, coalesce(m.n_items, 0) as n_items,
       sha256(coalesce(m.items, '')) as items_sha256,
       coalesce(c.n_hit, 0) > 0 and 20 * coalesce(c.n_hit, 0) >= len(w.w) as contaminated,
       coalesce(l.longest, 0) as longest, l.longest_at
from words w left join covered c using (doc_id) left join named m using (doc_id) left join longest l using (doc_id)
"""
