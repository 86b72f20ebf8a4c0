"""Merkle manifest of a dataset, with octopus multiproofs.

Each row is a leaf, each source a tree whose runs of three consecutive nodes are hashed together level by level, and
the roots of the sources, in order, are the leaves of one more tree. Leaves are range-partitioned by source and id; a
partition's leaves of one source are a run of consecutive positions, a *span*. Only digests travel, texts are hashed
where they are read.

The tree is built in aligned blocks of ``3 ** DEPTH`` nodes, so a task holds one block at a time. Proofs are not looked
up node by node: from the spans alone, each leaf partition computes the minimal union of node coordinates that it needs
and cannot derive (at most two on each side of a span at each level), fetches each of them once with one join, derives
all shared interior nodes upwards, and reads the proof of each of its leaves from these.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foroscope.llm.common import id_text, row_key, ship_by_value, to_batch, whole_groups
from foroscope.session import stage

ship_by_value(__name__)

#: Consecutive nodes under one parent.
ARITY = 3
#: Levels that one block builds; a block starts from 3 ** 8 = 6,561 nodes.
DEPTH = 8
#: Leaves of one range partition, about.
SPAN_ROWS = 100_000
#: Number of the tree over the sources; the trees of sources count from 0.
TOP = -1
LEAVES_SQL = "part int, place long, source string, id long, leaf string, forged string"
LEAVES = pa.schema([("part", pa.int32()), ("place", pa.int64()), ("source", pa.string()), ("id", pa.int64()),
                    ("leaf", pa.string()), ("forged", pa.string())])
NODES_SQL = "tree long, level int, idx long, size long, digest string"
NODES = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("size", pa.int64()),
                   ("digest", pa.string())])
WANTED_SQL = "part int, tree long, level int, idx long"
WANTED = pa.schema([("part", pa.int32()), ("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64())])
PROOFS_SQL = ("id long, leaf string, subroot string, root string, proof array<string>, proof_sha256 string, "
              "folded_root string, verified boolean")
PROOFS = pa.schema([("id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                    ("proof", pa.list_(pa.string())), ("proof_sha256", pa.string()), ("folded_root", pa.string()),
                    ("verified", pa.bool_())])


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column, others: list[str]) -> Column:
    return F.sha2(F.concat(*[field(F.col(c)) for c in others], field(text)), 256)


def digest_of(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def parents(nodes: list[str]) -> list[str]:
    return [digest_of(nodes[i:i + ARITY]) for i in range(0, len(nodes), ARITY)]


def number_rows(batches):
    """Partition number and place of each row among the partition's rows of its source; batches come sorted."""
    from pyspark import TaskContext

    part, known, count = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        sources, places = batch.column("source").to_pylist(), []
        for source in sources:
            if (source,) != known:
                known, count = (source,), 0
            places.append(count)
            count += 1
        yield to_batch(LEAVES, np.full(len(sources), part), places, sources, batch.column("id"), batch.column("leaf"),
                       batch.column("forged"))


def ordered_leaves(docs: DataFrame, forged_text: Column | None) -> DataFrame:
    """Leaves in range partitions by (source, id), numbered inside their partition."""
    others = ["doc_id", "source", "lang", "n_chars"]
    leaf = leaf_digest(F.col("text"), others)
    forged = leaf if forged_text is None else F.when(forged_text.eqNullSafe(F.col("text")), leaf).otherwise(
        leaf_digest(forged_text, others))
    rows = docs.select(F.col("source").cast("string").alias("source"), row_key("doc_id").alias("id"), leaf.alias("leaf"),
                       forged.alias("forged"))
    n = max(-(-docs.count() // SPAN_ROWS), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # equal rows are told apart by where they were read, so that a hot row does not fill one partition
    rows = rows.withColumn("read", F.monotonically_increasing_id())
    order = [F.col("source").asc_nulls_first(), "id", "leaf", "read"]
    sorted_rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return stage(sorted_rows.drop("read").mapInArrow(number_rows, LEAVES_SQL), "merkle-leaves")


def spans_of(leaves: DataFrame) -> DataFrame:
    """Per partition and source: tree number, first position, rows, leaves of the tree, number of trees.

    The windows go over rows per (partition, source), not over documents; trees are numbered by partition, as the
    partitions are in the order of the sources.
    """
    from pyspark.sql import Window as W

    counts = stage(leaves.groupBy("part", "source").agg(F.count("*").alias("n")), "merkle-counts")
    by_source = counts.select("*", F.struct("source").alias("s"))
    inside = W.partitionBy("s").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    spans = by_source.select("part", "source", "n", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("first"),
                             F.sum("n").over(W.partitionBy("s")).alias("size"),
                             (F.row_number().over(W.partitionBy("s").orderBy("part")) == 1).alias("opens"))
    spans = stage(spans, "merkle-spans")
    opened = spans.filter("opens").groupBy("part").agg(F.count("*").alias("opened"))
    # one row for each range partition
    before = opened.select("part", (F.sum("opened").over(W.orderBy("part")) - F.col("opened")).alias("before"))
    rank = F.row_number().over(W.partitionBy("part").orderBy(F.col("source").asc_nulls_first()))
    trees = spans.filter("opens").join(before, "part").select(
        "source", (F.col("before") + rank - 1).cast("long").alias("tree"))
    total = opened.agg(F.sum("opened").alias("trees"))
    numbered = spans.join(trees, spans["source"].eqNullSafe(trees["source"])).drop(trees["source"])
    return stage(numbered.join(F.broadcast(total)).select("part", "source", "tree", "first", "n", "size", "trees"),
                 "merkle-numbered")


def build_blocks(depth: int):
    """From nodes of one level, sorted by (tree, block, idx): all nodes above them, ``depth`` levels or up to the root."""
    def run(batches):
        for table, starts in whole_groups(batches, ["tree", "block"]):
            ends = np.append(starts[1:], table.num_rows)
            trees, sizes = table.column("tree").to_numpy(), table.column("size").to_numpy()
            levels, idx = table.column("level").to_numpy(), table.column("idx").to_numpy()
            digests = table.column("digest").to_pylist()
            out = [[], [], [], [], []]
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                nodes, size, level, first = digests[a:b], int(sizes[a]), int(levels[a]), int(idx[a])
                for _ in range(depth):
                    if size == 1:
                        break
                    nodes, size, level, first = parents(nodes), -(-size // ARITY), level + 1, first // ARITY
                    for column, values in zip(out, ([int(trees[a])] * len(nodes), [level] * len(nodes),
                                                    range(first, first + len(nodes)), [size] * len(nodes), nodes),
                                              strict=True):
                        column.extend(values)
            yield to_batch(NODES, *out)
    return run


def build_trees(bottom: DataFrame, largest: int, depth: int, name: str) -> DataFrame:
    """All nodes above the lowest ones (tree, level, idx, size of the level, digest) of trees up to ``largest`` leaves."""
    made, level, lowest = [], 0, bottom
    while largest > 1:
        blocks = lowest.withColumn("block", F.expr(f"idx div {ARITY ** depth}"))
        # every tree has its own blocks, so only a block must be whole in a task
        rows = blocks.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")
        nodes = stage(rows.mapInArrow(build_blocks(depth), NODES_SQL), name)
        made.append(nodes)
        level, largest = level + depth, -(-largest // ARITY ** depth)
        lowest = nodes.filter(f"level = {level} and size > 1")
    out = bottom.select("tree", "level", "idx", "size", "digest")
    for nodes in made:
        out = out.unionByName(nodes)
    return out


def missing(first: int, end: int, size: int):
    """Level by level for the known positions [first, end) of a level of ``size`` nodes: that range and the positions
    beside it that complete its outer runs."""
    level = 0
    while size > 1:
        left, right = first - first % ARITY, min(end + -end % ARITY, size)
        yield level, first, end, [*range(left, first), *range(end, right)]
        level, first, end, size = level + 1, left // ARITY, -(-right // ARITY), -(-size // ARITY)


def wanted(batches):
    """Coordinates that a partition must fetch for its spans."""
    for batch in batches:
        out = [[], [], [], []]
        for row in batch.to_pylist():
            for level, _, _, places in missing(row["first"], row["first"] + row["n"], row["size"]):
                for place in places:
                    for column, value in zip(out, (row["part"], row["tree"], level, place), strict=True):
                        column.append(value)
        yield to_batch(WANTED, *out)


def derive(digests: list[str], first: int, size: int, fetched: dict) -> list[tuple[int, list[str]]]:
    """For each level up to the root: position of the first known node and the known nodes, whole runs of them."""
    out = []
    for level, start, end, places in missing(first, first + len(digests), size):
        left = [fetched[level, p] for p in places if p < start]
        nodes = left + digests + [fetched[level, p] for p in places if p >= end]
        out.append((start - len(left), nodes))
        digests = parents(nodes)
    out.append((0, digests))
    return out


def paths(levels: list[tuple[int, list[str]]], place: int):
    """For each level below the root: the run of the path's node and its place in the run."""
    for first, nodes in levels[:-1]:
        run = place - place % ARITY
        yield nodes[run - first:run - first + ARITY], place - run
        place //= ARITY


def expand(leaves: pa.Table, spans: pa.Table, nodes: pa.Table) -> pa.Table:
    """Proofs of one partition's leaves from its spans and the nodes that it fetched."""
    fetched: dict = {}
    for row in nodes.to_pylist():
        fetched.setdefault(row["tree"], {})[row["level"], row["idx"]] = row["digest"]
    order = sorted(spans.to_pylist(), key=lambda s: s["tree"])
    by_source: dict = {}
    for row in leaves.sort_by("place").to_pylist():
        by_source.setdefault(row["source"], []).append(row)
    trees = [derive([r["leaf"] for r in by_source[s["source"]]], s["first"], s["size"], fetched.get(s["tree"], {}))
             for s in order]
    top = derive([t[-1][1][0] for t in trees], order[0]["tree"], order[0]["trees"], fetched.get(TOP, {}))
    root = top[-1][1][0]
    out = [[] for _ in PROOFS]
    for span, levels in zip(order, trees, strict=True):
        upper = list(paths(top, span["tree"]))
        for i, row in enumerate(by_source[span["source"]]):
            proof, node = [], row["forged"]
            for run, at in [*paths(levels, span["first"] + i), *upper]:
                left, right = run[:at], run[at + 1:]
                proof += left + right
                node = digest_of([*left, node, *right])
            for column, value in zip(out, (row["id"], row["leaf"], levels[-1][1][0], root, proof, digest_of(proof), node,
                                           node == root), strict=True):
                column.append(value)
    return pa.table([pa.array(c, f.type) for c, f in zip(out, PROOFS, strict=True)], schema=PROOFS)


def manifest(docs: DataFrame, forged_text: Column | None = None, depth: int = DEPTH) -> dict[str, DataFrame]:
    """The manifest as tables: ``nodes`` (tree, level, idx, size, digest), ``spans``, and ``proofs`` with one row per
    document row (id, leaf, subroot, root, proof as a list of digests, proof_sha256, folded_root, verified).

    A leaf hashes doc_id, source, lang, n_chars and text; a null field is ``-``, an empty text ``0:``. Rows of a source
    are ordered by id, rows without an id last and in the order of their leaves, as are rows that repeat an id; repeated
    rows are leaves of their own. Rows without a source are the first tree. ``forged_text`` replaces the text in
    ``folded_root`` only. An empty table has no nodes and no proofs; further columns are not part of a leaf.
    """
    leaves = ordered_leaves(docs, forged_text)
    spans = spans_of(leaves)
    placed = leaves.alias("l").join(
        spans.alias("s"), (F.col("l.part") == F.col("s.part")) & F.col("l.source").eqNullSafe(F.col("s.source"))).select(
        "tree", F.lit(0).alias("level"), (F.col("first") + F.col("place")).alias("idx"), "size",
        F.col("leaf").alias("digest"))
    most = spans.agg(F.max("size").alias("size"), F.max("trees").alias("trees")).first()
    trees = build_trees(placed, most.size or 0, depth, "merkle-nodes")
    subroots = trees.filter("size = 1").select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"),
                                               F.col("tree").alias("idx"), F.lit(most.trees or 0).cast("long").alias("size"),
                                               "digest")
    nodes = trees.unionByName(build_trees(stage(subroots, "merkle-subroots"), most.trees or 0, depth, "merkle-top"))
    whole = spans.select("part", "tree", "first", "n", "size").unionByName(
        spans.groupBy("part").agg(F.lit(TOP).cast("long").alias("tree"), F.min("tree").alias("first"),
                                  F.count("*").alias("n"), F.max("trees").alias("size")))
    coordinates = whole.mapInArrow(wanted, WANTED_SQL)
    fetched = coordinates.join(nodes, ["tree", "level", "idx"]).select("part", "tree", "level", "idx", "digest")

    def prove(key, left, right):
        # spans and fetched nodes come in one table, told apart by ``size``
        mine = right.filter(pc.is_valid(right["size"]))
        return expand(left, mine, right.filter(pc.is_null(right["size"])))

    extra = spans.select("part", "tree", F.lit(None).cast("int").alias("level"), F.lit(None).cast("long").alias("idx"),
                         F.lit(None).cast("string").alias("digest"), "source", "first", "n", "size", "trees").unionByName(
        fetched.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("source", "string"), ("first", "long"), ("n", "long"), ("size", "long"), ("trees", "long"))]))
    proofs = leaves.groupBy("part").cogroup(extra.groupBy("part")).applyInArrow(prove, PROOFS_SQL)
    return {"nodes": nodes, "spans": spans, "proofs": proofs}


def without_newlines() -> Column:
    """The tampering of the query: rows whose id has an even CRC-32 lose the line breaks of their text."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text"))


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """Digest of the manifest over ``documents``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    proofs = manifest(docs, without_newlines())["proofs"]
    return proofs.select(id_text("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                         "verified")


ORACLE = r"""
with recursive
bits as (
  select *, list_reduce(
    list_prepend(cast(4294967295 as bigint), list_transform(string_split(cast(doc_id as varchar), ''),
                                                            lambda x: cast(ascii(x) as bigint))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                             lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))) as raw from documents),
forged as (
  select *, case when raw & 1 = 1 then replace(text, chr(10), '') else text end as forged_text from bits),
rows as (
  select doc_id, source, row_number() over (partition by source order by doc_id) - 1 as idx,
         count(*) over (partition by source) as size,
         coalesce(octet_length(encode(cast(doc_id as varchar))) || ':' || doc_id, '-')
         || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
         || coalesce(octet_length(encode(cast(n_chars as varchar))) || ':' || n_chars, '-') as head,
         coalesce(octet_length(encode(text)) || ':' || text, '-') as body,
         coalesce(octet_length(encode(forged_text)) || ':' || forged_text, '-') as forged_body from forged),
leaves as (select *, sha256(head || body) as leaf, sha256(head || forged_body) as forged_leaf from rows),
trees as (
  select source, row_number() over (order by encode(source) nulls first) - 1 as tree from (
    select distinct source from documents)),
nodes as (
  select t.tree, 0 as level, l.idx, l.size, l.leaf as digest from leaves l join trees t
  on l.source is not distinct from t.source
  union all
  select tree, level + 1, idx // 3, (size + 2) // 3, sha256(string_agg(digest, '' order by idx)) from nodes
  where size > 1 group by tree, level, idx // 3, size),
tops as (
  select 0 as level, tree as idx, (select count(*) from trees) as size, digest from nodes where size = 1
  union all
  select level + 1, idx // 3, (size + 2) // 3, sha256(string_agg(digest, '' order by idx)) from tops
  where size > 1 group by level, idx // 3, size),
all_nodes as (select * from nodes union all select -1, * from tops),
beside as (
  select tree, level, idx, size, digest,
         coalesce(string_agg(digest, '') over (run rows between unbounded preceding and 1 preceding), '') as before,
         coalesce(string_agg(digest, '') over (run rows between 1 following and unbounded following), '') as after
  from all_nodes window run as (partition by tree, level, idx // 3 order by idx)),
folds as (
  select l.doc_id, t.tree as home, t.tree, 0 as level, l.idx, l.size, l.forged_leaf as node, '' as proof
  from leaves l join trees t on l.source is not distinct from t.source
  union all
  select f.doc_id, f.home, case when f.size > 1 then f.tree else -1 end,
         case when f.size > 1 then f.level + 1 else 0 end,
         case when f.size > 1 then f.idx // 3 else f.home end,
         case when f.size > 1 then (f.size + 2) // 3 else (select count(*) from trees) end,
         case when f.size > 1 then sha256(b.before || f.node || b.after) else f.node end,
         case when f.size > 1 then f.proof || b.before || b.after else f.proof end
  from folds f join beside b on f.tree = b.tree and f.level = b.level and f.idx = b.idx
  where f.size > 1 or f.tree >= 0),
ends as (select doc_id, node, proof from folds where tree = -1 and size = 1)
select l.doc_id, l.leaf, s.digest as subroot, r.digest as root, sha256(e.proof) as proof_sha256, e.node as folded_root,
       e.node = r.digest as verified
from leaves l join trees t on l.source is not distinct from t.source
join nodes s on s.tree = t.tree and s.size = 1
join (select digest from tops where size = 1) r on true
join ends e on e.doc_id = l.doc_id
"""
