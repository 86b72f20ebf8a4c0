"""Ranked lexical search of many queries at once, with common subexpressions evaluated once.

Query items are dealt into blocks of bounded size; each block passes over the documents by itself. Inside a block, terms
that occur in exactly the same items are one *atom*, and neighbouring atoms or sums that several items share are paired
again and again, the most shared ones first, until no pair is left that two items have. That gives a DAG: atoms at the
bottom, sums of two nodes above, and for each item the few nodes that add up to it.

Documents are tokenised where they are read and shrink to the counts of the block's terms, which are written once.
Corpus statistics come from that table. Then every task takes its documents in chunks, fills one accumulator for each
atom, adds up each shared sum once, lets the items combine them, and keeps the ten best documents of each item. Only
these meet in a shuffle, so a term that all documents hold is no hot key.
"""

from collections import Counter
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foroscope.llm.common import Memo, group_starts, id_text, row_key, ship_by_value, texts_of, to_batch
from foroscope.session import drop_stage, stage

ship_by_value(__name__)

#: Query text of one block, about; a single larger item is a block of its own.
BLOCK_BYTES = 4 << 20
#: Accumulator cells of one chunk of documents.
CELLS = 1 << 22
#: Words counted together.
WORDS = 1 << 21
#: Letters, digits and everything beyond ASCII stay, A-Z become a-z, the rest parts terms.
TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
PLAN_SQL = ("block int, items array<string>, terms array<binary>, atoms array<int>, sums array<int>, starts array<int>, "
            "nodes array<int>")
PLAN = pa.schema([("block", pa.int32()), ("items", pa.list_(pa.string())), ("terms", pa.list_(pa.binary())),
                  ("atoms", pa.list_(pa.int32())), ("sums", pa.list_(pa.int32())), ("starts", pa.list_(pa.int32())),
                  ("nodes", pa.list_(pa.int32()))])
COUNTS_SQL = "id long, n long, terms array<int>, counts array<int>"
COUNTS = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())),
                    ("counts", pa.list_(pa.int32()))])
HITS_SQL = "item int, id long, score long"
HITS = pa.schema([("item", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERMS).split()


def share(lists: list[list[int]], atoms: int) -> tuple[list[list[int]], list[tuple[int, int]]]:
    """Pair neighbours that at least two lists have until none is left: the shorter lists and the sums made.

    A pair that fewer than two lists end up using, because its neighbours went into more shared pairs, is not made."""
    sums: list[tuple[int, int]] = []
    while True:
        common = Counter(p for nodes in lists for p in pairwise(nodes))
        order = {p: (-n, p) for p, n in common.items() if n > 1}
        chosen, used = [], Counter()
        for nodes in lists:
            best = sorted((order[p], i) for i, p in enumerate(pairwise(nodes)) if p in order)
            taken: set[int] = set()
            for _, i in best:
                if i not in taken and i + 1 not in taken:
                    taken |= {i, i + 1}
                    used[nodes[i], nodes[i + 1]] += 1
            chosen.append(best)
        made = {p: atoms + len(sums) + k for k, p in enumerate(sorted(p for p, n in used.items() if n > 1))}
        if not made:
            return lists, sums
        sums += sorted(made)
        out = []
        for nodes, best in zip(lists, chosen, strict=True):
            starts: set[int] = set()
            taken = set()
            for _, i in best:
                if i not in taken and i + 1 not in taken:
                    taken |= {i, i + 1}
                    if (nodes[i], nodes[i + 1]) in made:
                        starts.add(i)
            inner = {i + 1 for i in starts}
            out.append([made[nodes[i], nodes[i + 1]] if i in starts else n for i, n in enumerate(nodes) if i not in inner])
        lists = out


def mine(table: pa.Table) -> pa.Table:
    """The shared-sum DAG of one block of items."""
    names, texts = table.column("item").to_pylist(), table.column("text").cast(pa.binary()).to_pylist()
    holders: dict[bytes, list[int]] = {}
    for i, text in enumerate(texts):
        for term in sorted(set(terms_of(text))):
            holders.setdefault(term, []).append(i)
    groups: dict[tuple, list[bytes]] = {}
    for term, where in holders.items():
        groups.setdefault(tuple(where), []).append(term)
    ranked = sorted(groups, key=lambda where: (-len(where), where))
    lists: list[list[int]] = [[] for _ in names]
    terms, atom_of = [], []
    for atom, where in enumerate(ranked):
        terms += groups[where]
        atom_of += [atom] * len(groups[where])
        for i in where:
            lists[i].append(atom)
    lists, sums = share(lists, len(ranked))
    starts = np.cumsum([0, *map(len, lists)]).tolist()
    row = {"block": table.column("block")[0].as_py(), "items": names, "terms": terms, "atoms": atom_of,
           "sums": [n for pair in sums for n in pair], "starts": starts, "nodes": [n for nodes in lists for n in nodes]}
    return pa.Table.from_pylist([row], PLAN)


def number_terms(block) -> dict[bytes, int]:
    return {term: i for i, term in enumerate(block.value["terms"])}


def count_terms(block):
    """Per document with at least one term: its number of terms and the counts of the block's terms."""
    numbers = Memo(number_terms)

    def run(batches):
        get = numbers(block).get
        for batch in batches:
            ids, n, found = [], [], []

            def flush(ids=ids, n=n, found=found):
                sizes = np.array([len(f) for f in found], np.int64)
                doc, term = np.repeat(np.arange(len(found)), sizes), np.concatenate([np.zeros(0, np.int32), *found])
                doc, term = doc[term >= 0], term[term >= 0]
                order = np.lexsort((term, doc))
                doc, term = doc[order], term[order]
                starts = group_starts([doc, term])
                counts = np.diff(np.append(starts, len(doc)))
                offsets = np.searchsorted(doc[starts], np.arange(len(found) + 1)).astype(np.int32)
                return pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(term[starts].astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32)))], schema=COUNTS)

            words = 0
            for doc, text in zip(batch.column("id").to_pylist(), texts_of(batch), strict=True):
                terms = terms_of(text)
                if not terms:
                    continue
                ids.append(doc)
                n.append(len(terms))
                found.append(np.fromiter(map(get, terms, repeat(-1)), np.int32, len(terms)))
                words += len(terms)
                if words > WORDS:
                    yield flush()
                    ids.clear(), n.clear(), found.clear()
                    words = 0
            yield flush()
    return run


class Best:
    """The ``k`` best documents of each item so far: highest score, then smallest id."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.ones(items, np.int64)
        self.ids = [np.zeros(0, np.int64)] * items
        self.scores = [np.zeros(0, np.int64)] * items

    def add(self, item: int, ids: np.ndarray, scores: np.ndarray) -> None:
        keep = scores >= self.floor[item]
        if not keep.any():
            return
        ids, scores = ids[keep], scores[keep]
        if len(scores) > self.k:
            edge = np.partition(scores, -self.k)[-self.k]
            ids, scores = ids[scores >= edge], scores[scores >= edge]
        ids, scores = np.concatenate([self.ids[item], ids]), np.concatenate([self.scores[item], scores])
        order = np.lexsort((ids, -scores))[:self.k]
        self.ids[item], self.scores[item] = ids[order], scores[order]
        if len(order) == self.k:
            self.floor[item] = self.scores[item][-1]

    def batch(self) -> pa.RecordBatch:
        items = np.repeat(np.arange(len(self.ids)), [len(x) for x in self.ids])
        return to_batch(HITS, items, np.concatenate([np.zeros(0, np.int64), *self.ids]),
                        np.concatenate([np.zeros(0, np.int64), *self.scores]))


def score_chunk(plan: dict, batch: pa.RecordBatch, best: Best) -> None:
    """Accumulate one chunk of documents along the DAG."""
    docs = batch.num_rows
    n, total = batch.column("n").to_numpy(), np.int64(plan["total"])
    m = 10 + 90 * n * np.int64(plan["documents"]) // total
    lists = batch.column("terms")
    term, tf = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(docs), lists.value_lengths().to_numpy())
    part = plan["weights"][term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
    ids = batch.column("id").to_numpy()
    atom = plan["atoms"][term]
    # only nodes that occur in the chunk have a vector
    seen, row = np.unique(atom, return_inverse=True)
    cells = np.zeros((len(seen), docs), np.int64)
    np.add.at(cells.reshape(-1), row * docs + doc, part)
    vectors: list = [None] * (plan["n_atoms"] + len(plan["sums"]))
    for i, a in enumerate(seen.tolist()):
        vectors[a] = cells[i]
    for i, (left, right) in enumerate(plan["sums"].tolist(), plan["n_atoms"]):
        a, b = vectors[left], vectors[right]
        vectors[i] = b if a is None else a if b is None else a + b
    for item, nodes in enumerate(plan["nodes"]):
        parts = [vectors[i] for i in nodes if vectors[i] is not None]
        if parts:
            best.add(item, ids, parts[0] if len(parts) == 1 else np.sum(parts, axis=0))


def rank_documents(block, k: int):
    def run(batches):
        plan = block.value
        best = Best(len(plan["nodes"]), k)
        chunk = max(16, min(4096, CELLS // (plan["n_atoms"] + len(plan["sums"]) + 1)))
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                score_chunk(plan, batch.slice(at, chunk), best)
        yield best.batch()
    return run


def deal_items(items: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """Items with the number of their block; no block of several items has more than twice ``block_bytes`` of text."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)).cast("int"))
        worst = dealt.groupBy("block").agg(F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("n")).filter(
            "n > 1").agg(F.max("size")).first()[0] or 0
        if worst <= 2 * block_bytes:
            return dealt, n
        n *= 2


def search_block(plan, rows: DataFrame, k: int) -> DataFrame:
    """Best documents of one block's items: item, id, score, rank."""
    spark = rows.sparkSession
    names = spark.sparkContext.broadcast({"terms": [bytes(t) for t in plan.terms]})
    counted = stage(rows.mapInArrow(count_terms(names), COUNTS_SQL), "search-counts")
    names.unpersist()
    stats = counted.agg(F.count("*").alias("documents"), F.sum("n").alias("total")).first()
    held = np.zeros(len(plan.terms), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        held[r["term"]] = r["count"]
    weights = np.floor(1000 * np.log((2 * stats.documents + 2) / (2 * held + 1))).astype(np.int64)
    dag = spark.sparkContext.broadcast({
        "weights": weights, "atoms": np.array(plan.atoms, np.int64), "n_atoms": max(plan.atoms) + 1,
        "sums": np.array(plan.sums, np.int64).reshape(-1, 2),
        "nodes": [plan.nodes[a:b] for a, b in pairwise(plan.starts)], "documents": stats.documents, "total": stats.total or 1})
    hits = stage(counted.mapInArrow(rank_documents(dag, k), HITS_SQL), "search-hits")
    dag.unpersist()
    drop_stage(counted)
    order = W.partitionBy("item").orderBy(F.desc("score"), "id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    labels = spark.createDataFrame(list(enumerate(plan.items)), "item int, name string")
    return ranked.join(labels, "item").select(F.col("name").alias("item"), "rank", "id", "score")


def search_documents(docs: DataFrame, benchmark: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                     item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` best documents of every item: item, rank, id, score.

    A document without terms, null or empty, is not counted and never found; an item without terms finds nothing. Every
    document row is a document, also when rows repeat; equal scores go by ascending id, rows without an id last. Items
    that repeat both id and text are one item; an id with several texts is ranked once for each text; a null id is an
    id. Empty tables give an empty result. Further columns are ignored.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             F.coalesce(F.col(item_text_col), F.lit("")).alias("text")).filter("text <> ''").distinct()
    dealt, n = deal_items(stage(items, "search-items"), block_bytes)
    plans = stage(dealt.groupBy("block").applyInArrow(mine, PLAN_SQL), "search-plans")
    rows = docs.select(row_key(id_col).alias("id"), F.col(text_col).alias("text"))
    out = docs.sparkSession.createDataFrame([], "item string, rank int, id long, score long")
    for block in range(n):
        plan = plans.filter(F.col("block") == block).first()  # one block's terms, bounded by block_bytes
        if plan is not None and plan.terms:
            out = out.unionByName(search_block(plan, rows, k))
    return out


def ranked_search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest of the search: item_id, rank, doc_id, score."""
    found = search_documents(docs, benchmark)
    return found.select(F.col("item").cast(benchmark.schema["item_id"].dataType).alias("item_id"), "rank",
                        id_text("id").alias("doc_id"), "score")


ORACLE = r"""
with terms as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
sizes as (select doc_id, count(*) as n from terms group by doc_id),
stats as (select count(*) as documents, cast(sum(n) as bigint) as total from sizes),
tfs as (select doc_id, term, count(*) as tf from terms group by doc_id, term),
wanted as (
  select distinct item_id, term from (
    select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)),
weights as (
  select term, cast(floor(1000 * ln((2 * any_value(documents) + 2) / cast(2 * count(*) + 1 as double))) as bigint) as w
  from tfs, stats group by term),
lengths as (select doc_id, 10 + (90 * n * documents) // total as m from sizes, stats),
scores as (
  select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
  from wanted join tfs using (term) join weights using (term) join lengths using (doc_id) group by item_id, doc_id),
ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 10
"""
