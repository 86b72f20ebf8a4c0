"""Exact similarity search over unit vectors, pruned by cells.

Centres are vectors of the table in hash order, as many as the square root of its rows up to a setting. Every vector is at
home in the cell of its nearest centre. Angles obey the triangle inequality, so a vector within ``reach`` of a member of
another cell is no further than that cell's radius plus ``reach`` from its centre, and no further than twice ``reach``
beyond the distance to its own centre; it visits only the cells that pass both tests. Cells that mostly the same vectors
visit are packed into one bin, to which a vector is sent once, so where the bounds prune little the rows sent are as many as
the bins, not the cells. In a cell or bin, members are dealt into parts of bounded size, and members and visitors stream past
each part, so no task holds a large cell and no row is made for a pair that is not asked for. The bounds lose nothing: results
equal a comparison of all pairs.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foroscope.functions.ranking import top_n_per_key
from foroscope.functions.vectors import norm, unit
from foroscope.operators.graph import components
from foroscope.session import ship_by_value, stage

ship_by_value(__name__)

#: Centres at most; each vector is compared with all of them.
CELLS = 1024
#: Members of one part of a bin, about, and members that cells are packed up to.
PART = 16384
#: Rows of a stream that are compared with a part at once.
STEP = 256
#: Comparisons that packing cells may add, as a share of those of the cells alone.
EXTRA = 0.1
#: Angles are compared with this slack, so rounding prunes nothing.
SLACK = 1e-7
MEMBER, INSIDE, VISITOR = 0, 1, 2


@dataclass
class Cells:
    """Vectors at home in their cells (key, vec, cell, angle and further columns), and what bounds them."""

    home: DataFrame
    centres: np.ndarray
    radius: np.ndarray
    members: np.ndarray

    @property
    def parts(self) -> np.ndarray:
        return np.maximum(1, -(-self.members // PART))


def angles(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ centres.T, -1.0, 1.0))


def matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def settle(centres: np.ndarray):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                away = angles(matrix(batch.column("vec")), centres)
                cell = away.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away[np.arange(len(cell)), cell])],
                    names=[*batch.schema.names, "cell", "angle"])
    return run


def usable(df: DataFrame, key: str, vec: str) -> DataFrame:
    """Keys and unit vectors, without null keys and without null, zero or infinite vectors."""
    fine = F.col(key).isNotNull() & F.col(vec).isNotNull() & (norm(vec) > 0) & (norm(vec) < float("inf"))
    return df.filter(fine).select(F.col(key).alias("key"), unit(vec).alias("vec"))


def place(rows: DataFrame, cells: int = CELLS) -> Cells | None:
    """Cells of (key, vec) rows with unit vectors; None if there are none. ``rows`` should be a written table."""
    n = rows.count()
    if not n:
        return None
    chosen = rows.select("vec", F.xxhash64(F.col("key").cast("string")).alias("h")).orderBy("h", "vec").limit(
        min(cells, max(1, int(n ** 0.5))))
    centres = np.array([r["vec"] for r in chosen.collect()])  # a bounded number of rows
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    home = stage(rows.mapInArrow(settle(centres), f"{columns}, cell int, angle double"), "cells")
    radius, members = np.full(len(centres), -1.0), np.zeros(len(centres), np.int64)
    for r in home.groupBy("cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n")).collect():
        radius[r["cell"]], members[r["cell"]] = r["radius"], r["n"]
    return Cells(home, centres, radius, members)


def visited(away: np.ndarray, own: np.ndarray, reach: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Which cells may hold a member within ``reach`` of each vector, its own angle to its home given."""
    reach = np.asarray(reach).reshape(-1, 1) + SLACK
    return (radius >= 0) & (away <= radius + reach) & (away <= own.reshape(-1, 1) + 2 * reach)


def packed(cells: Cells, reach: float) -> np.ndarray:
    """The bin of each cell: cells of together at most ``PART`` members whose visitors are mostly the same.

    The centres, a sample of the vectors, stand for the visitors. A cell joins the bin of a near one unless the comparisons
    of the bin would exceed those of its cells alone by more than ``EXTRA``."""
    away = angles(cells.centres, cells.centres)
    goes = visited(away, np.maximum(cells.radius, 0), np.full(len(away), reach), cells.radius)
    bins = np.full(len(away), -1)
    for first in range(len(away)):
        if bins[first] >= 0:
            continue
        bins[first], n, seen = first, cells.members[first], goes[:, first]
        alone = n * seen.sum()
        for c in np.argsort(away[first], kind="stable"):
            if bins[c] >= 0 or n + cells.members[c] > PART:
                continue
            both, apart = seen | goes[:, c], alone + cells.members[c] * goes[:, c].sum()
            if (n + cells.members[c]) * both.sum() <= (1 + EXTRA) * apart:
                bins[c], n, seen, alone = first, n + cells.members[c], both, apart
    return np.unique(bins, return_inverse=True)[1]


def deal(cells: Cells, reach: float):
    """Members to their parts; members and later visitors to every part of each bin they must be compared with."""
    centres, radius, bins = cells.centres, cells.radius, packed(cells, reach)
    parts = np.maximum(1, -(-np.bincount(bins, cells.members).astype(np.int64) // PART))
    order = np.argsort(bins, kind="stable")
    starts = np.searchsorted(bins[order], np.arange(len(parts)))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, home = matrix(batch.column("vec")), batch.column("cell").to_numpy()
            away, cell = angles(vectors, centres), bins[home]
            goes = visited(away, away[np.arange(len(home)), home], reach, radius)
            goes = np.logical_or.reduceat(goes[:, order], starts, axis=1)
            goes &= np.arange(len(parts)) > cell[:, None]  # each pair of bins once
            row, to = np.nonzero(goes)
            row, to = np.concatenate([np.arange(len(cell)), row]), np.concatenate([cell, to])
            kind = np.where(to == cell[row], INSIDE, VISITOR)
            times = parts[to]
            row, to, kind = np.repeat(row, times), np.repeat(to, times), np.repeat(kind, times)
            part = np.arange(len(to)) - np.repeat(np.cumsum(times) - times, times)
            own = np.arange(len(cell))
            for r, t, p, k in ((own, cell, batch.column("deal").to_numpy() % parts[cell], np.full(len(cell), MEMBER)),
                               (row, to, part, kind)):
                for a in range(0, len(r), 8192):
                    at = slice(a, a + 8192)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(t[at].astype(np.int32)), pa.array(p[at].astype(np.int32)), pa.array(k[at].astype(np.int8)),
                         *(batch.column(c).take(pa.array(r[at])) for c in ("key", "mark", "vec"))],
                        names=["cell", "part", "kind", "key", "mark", "vec"])
    return run


def dealt(cells: Cells, rows: DataFrame, reach: float) -> DataFrame:
    """Rows (key, mark, vec, cell) sorted by part, members first."""
    sent = rows.withColumn("deal", F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(1 << 30))).mapInArrow(
        deal(cells, reach), f"cell int, part int, kind byte, key {rows.schema['key'].dataType.simpleString()}, mark long, vec array<double>")
    return sent.repartition("cell", "part").sortWithinPartitions("cell", "part", "kind")


def meetings(batches):
    """For each part its members, then pieces of the rows that are compared with it: (new part, members, piece)."""
    now, held, members = None, [], None
    for batch in batches:
        cell, part, kind = (batch.column(c).to_numpy() for c in ("cell", "part", "kind"))
        code = cell.astype(np.int64) << 32 | part
        edges = [0, *(np.flatnonzero((np.diff(code) != 0) | ((kind[1:] == MEMBER) != (kind[:-1] == MEMBER))) + 1).tolist(),
                 len(code)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            if code[a] != now:
                now, held, members = code[a], [], None
            if kind[a] == MEMBER:
                held.append(batch.slice(a, b - a))
                continue
            fresh = members is None
            if fresh:
                members = pa.Table.from_batches(held, batch.schema) if held else pa.Table.from_batches([], batch.schema)
                held = []
            if members.num_rows:
                for at in range(a, b, STEP):
                    yield fresh and at == a, members, batch.slice(at, min(STEP, b - at))


def close_pairs(batches, least: float):
    """(new part, members, piece, place in members, place in piece, cosine) of pairs at ``least`` or more, each once."""
    vectors = keys = None
    for fresh, members, piece in meetings(batches):
        if fresh:
            vectors, keys = matrix(members.column("vec")), members.column("key").to_numpy()
        dots = matrix(piece.column("vec")) @ vectors.T
        p, m = np.nonzero(dots >= least)
        own = piece.column("key").to_numpy(zero_copy_only=False)
        once = (piece.column("kind").to_numpy()[p] == VISITOR) | (own[p] > keys[m])
        yield fresh, members, piece, m[once], p[once], dots[p[once], m[once]]


def listed(least: float):
    def run(batches):
        for _, members, piece, m, p, cos in close_pairs(batches, least):
            if len(m):
                yield pa.RecordBatch.from_arrays([members.column("key").take(pa.array(m)).combine_chunks(),
                                                  piece.column("key").take(pa.array(p)), pa.array(cos)],
                                                 names=["a", "b", "similarity"])
    return run


def similar_pairs(df: DataFrame, key: str, threshold: float, vec: str = "vec", cells: int = CELLS) -> DataFrame:
    """All pairs (user_a < user_b) with a cosine of ``threshold`` or more, rounded to 6 digits.

    Rows without a key, and null, zero or infinite vectors have no pairs; keys are taken as unique."""
    kind = df.schema[key].dataType.simpleString()
    found = place(stage(usable(df, key, vec), "vectors"), cells)
    if found is None:
        return df.sparkSession.createDataFrame([], f"user_a {kind}, user_b {kind}, similarity double")
    rows = found.home.select("key", F.lit(0).cast("long").alias("mark"), "vec", "cell")
    pairs = dealt(found, rows, float(np.arccos(threshold))).mapInArrow(
        listed(threshold), f"a {kind}, b {kind}, similarity double")
    return pairs.select(F.least("a", "b").alias("user_a"), F.greatest("a", "b").alias("user_b"),
                        F.round("similarity", 6).alias("similarity"))


def counted(least: float):
    """Weight (``mark``) of the neighbours of each row, one partial sum for each part and piece."""
    def run(batches):
        members, sums = None, None

        def flush():
            return pa.RecordBatch.from_arrays([members.column("key").combine_chunks(), pa.array(sums.astype(np.int64))],
                                              names=["key", "n"])

        for fresh, now, piece, m, p, _ in close_pairs(batches, least):
            if fresh:
                if members is not None:
                    yield flush()
                members, sums, weight = now, np.zeros(now.num_rows), now.column("mark").to_numpy()
            sums += np.bincount(m, piece.column("mark").to_numpy()[p], len(sums))
            own = np.bincount(p, weight[m], piece.num_rows)
            yield pa.RecordBatch.from_arrays([piece.column("key"), pa.array(own.astype(np.int64))], names=["key", "n"])
        if members is not None:
            yield flush()
    return run


def one_chunk(column):
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def linked(least: float):
    """Of cores (mark 1) the links that connect a part's members and what streams past, without repeats; for each other
    row its nearest core in the part."""
    def rows(a, b, at, bt, cos, dense):
        return pa.RecordBatch.from_arrays(
            [one_chunk(a.column("key").take(pa.array(at))), one_chunk(b.column("key").take(pa.array(bt))),
             pa.array(np.round(cos, 6)), pa.array(np.full(len(at), dense))], names=["a", "b", "similarity", "dense"])

    def run(batches):
        group = marks = None
        for fresh, members, piece, m, p, cos in close_pairs(batches, least):
            if fresh:
                group, marks = np.arange(members.num_rows), members.column("mark").to_numpy()
            mine = piece.column("mark").to_numpy()
            both = np.flatnonzero((marks[m] == 1) & (mine[p] == 1))
            both = both[np.argsort(p[both], kind="stable")]
            edges = np.append(np.flatnonzero(np.diff(p[both], prepend=-1)), len(both))
            keep = [np.zeros(0, np.int64)]
            for i, j in zip(edges, edges[1:], strict=False):
                own, at = np.unique(group[m[both[i:j]]], return_index=True)
                keep.append(both[i + at])  # one link to each group that the row connects
                if len(own) > 1:
                    group[np.isin(group, own)] = own[0]
            keep = np.concatenate(keep)
            yield rows(members, piece, m[keep], p[keep], cos[keep], True)
            for near, far, i, j, ours, theirs in ((piece, members, p, m, mine, marks), (members, piece, m, p, marks, mine)):
                some = np.flatnonzero((ours[i] == 0) & (theirs[j] == 1))
                if len(some):
                    name = np.unique(one_chunk(far.column("key")).to_numpy(zero_copy_only=False)[j[some]],
                                     return_inverse=True)[1]
                    order = some[np.lexsort((name, -np.round(cos[some], 6), i[some]))]
                    best = order[np.append(True, np.diff(i[order]) != 0)]
                    yield rows(near, far, i[best], j[best], cos[best], False)
    return run


def density_clusters(df: DataFrame, key: str, threshold: float, min_points: int, vec: str = "vec",
                     cells: int = CELLS) -> DataFrame:
    """Density clusters with noise: key, neighbours, role, cluster.

    Neighbours are the rows with a cosine of ``threshold`` or more, the row itself included. Rows with ``min_points`` of
    them are cores; cores that are neighbours are one cluster, named by its smallest core. Other rows with a core among
    their neighbours are border rows of the cluster of their nearest one (by 6 digits, the smallest key on ties); the
    rest, unusable vectors included, is noise, -1. Keys are whole numbers and unique.

    Equal vectors are counted as one row of their number. Counts and links are sums and forests per part of a cell, never
    a row for each pair."""
    reach = float(np.arccos(threshold))
    rows = stage(usable(df, key, vec), "vectors")
    distinct = stage(rows.groupBy("vec").agg(F.min("key").alias("key"), F.count("*").alias("mark")), "distinct-vectors")
    found = place(distinct, cells)
    everyone = df.select(F.col(key).alias("key"))
    if found is None:
        return everyone.select(F.col("key").alias(key), F.lit(0).cast("long").alias("neighbours"),
                               F.lit("noise").alias("role"), F.lit(-1).cast("long").alias("cluster"))
    kind = df.schema[key].dataType.simpleString()
    sums = dealt(found, found.home.select("key", "mark", "vec", "cell"), reach).mapInArrow(
        counted(threshold), f"key {kind}, n long").groupBy("key").agg(F.sum("n").alias("n"))
    sums = stage(found.home.join(sums, "key", "left").select(
        "key", (F.coalesce("n", F.lit(0)) + F.col("mark")).alias("neighbours")), "neighbours")
    marked = found.home.drop("mark").join(sums, "key").select(
        "key", (F.col("neighbours") >= min_points).cast("long").alias("mark"), "vec", "cell")
    links = stage(dealt(found, marked, reach).mapInArrow(linked(threshold), f"a {kind}, b {kind}, similarity double, "
                                                                            "dense boolean"), "density-links")
    cores = sums.filter(F.col("neighbours") >= min_points).select(F.col("key").alias("node"))
    grouped = stage(components(links.filter("dense").select(F.col("a").alias("user_a"), F.col("b").alias("user_b")), cores),
                    "density-groups")
    border = top_n_per_key(links.filter("not dense"), ["a"], [F.desc("similarity"), "b"], 1).select(
        F.col("a").alias("first"), F.col("b").alias("node"))
    named = grouped.select(F.col("node").alias("first"), F.lit("core").alias("role"), "component").unionByName(
        border.join(grouped, "node").select("first", F.lit("border").alias("role"), "component"))
    same = rows.join(distinct.select("vec", F.col("key").alias("first")), "vec").select("key", "first")
    placed = same.join(sums.withColumnRenamed("key", "first"), "first").join(named, "first", "left")
    return everyone.join(placed, "key", "left").select(
        F.col("key").alias(key), F.coalesce("neighbours", F.lit(0)).cast("long").alias("neighbours"),
        F.coalesce("role", F.lit("noise")).alias("role"), F.coalesce("component", F.lit(-1)).cast("long").alias("cluster"))


def best_in_part(k: int):
    """The ``k`` best members of each part for every query that streams past."""
    def run(batches):
        vectors = keys = None
        for fresh, members, piece in meetings(batches):
            if fresh:
                vectors, keys = matrix(members.column("vec")), members.column("key")
                names = np.unique(keys.to_numpy(), return_inverse=True)[1]
            dots = np.round(matrix(piece.column("vec")) @ vectors.T, 6)
            order = np.lexsort((np.broadcast_to(names, dots.shape), -dots), axis=1)[:, :k]
            row = np.repeat(np.arange(len(dots)), order.shape[1])
            yield pa.RecordBatch.from_arrays(
                [piece.column("key").take(pa.array(row)), keys.take(pa.array(order.ravel())).combine_chunks(),
                 pa.array(dots[row, order.ravel()])], names=["query", "key", "similarity"])
    return run


def ask(cells: Cells, first: int):
    """Queries to the ``first`` cells of smallest bound, or, with a known ``reach``, to all others that may beat it."""
    centres, radius, parts = cells.centres, cells.radius, cells.parts

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            away = angles(matrix(batch.column("vec")), centres)
            bound = np.where(radius >= 0, away - radius, np.inf)
            rank = np.argsort(np.argsort(bound, axis=1, kind="stable"), axis=1)
            goes = (rank < first) & np.isfinite(bound)
            if "reach" in batch.schema.names:
                goes = ~goes & (bound <= batch.column("reach").to_numpy()[:, None] + SLACK) & np.isfinite(bound)
            row, to = np.nonzero(goes)
            times = parts[to]
            row, to = np.repeat(row, times), np.repeat(to, times)
            part = np.arange(len(to)) - np.repeat(np.cumsum(times) - times, times)
            for a in range(0, len(row), 8192):
                at = slice(a, a + 8192)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to[at].astype(np.int32)), pa.array(part[at].astype(np.int32)),
                     pa.array(np.full(len(row[at]), VISITOR, np.int8)), batch.column("key").take(pa.array(row[at])),
                     batch.column("vec").take(pa.array(row[at]))], names=["cell", "part", "kind", "key", "vec"])
    return run


def nearest_rows(df: DataFrame, key: str, queries: DataFrame, k: int = 10, vec: str = "vec", cells: int = CELLS,
                 first: int = 2) -> DataFrame:
    """The ``k`` rows of highest cosine (6 digits) for many queries at once: query, key, similarity, rank.

    A query looks into the ``first`` cells of smallest bound, which gives it a k-th best similarity, then into the others
    whose bound allows a better or equal one. A row that is a query finds itself too; equal similarities go by key.
    Queries with an unusable vector find nothing."""
    kind, asker = df.schema[key].dataType.simpleString(), queries.schema[key].dataType.simpleString()
    found = place(stage(usable(df, key, vec), "vectors"), cells)
    if found is None:
        return df.sparkSession.createDataFrame([], f"query {asker}, key {kind}, similarity double, rank int")
    if kind != asker:
        raise ValueError(f"keys of queries and rows differ in type: {asker}, {kind}")
    wanted = stage(usable(queries, key, vec), "queries")
    sql = f"cell int, part int, kind byte, key {kind}, vec array<double>"
    own = found.home.select("cell", F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(1 << 30)).alias("deal"), "key", "vec")
    counts = found.parts.tolist()
    part = (F.col("deal") % F.get(F.array(*[F.lit(int(x)) for x in counts]), F.col("cell"))).cast("int")
    members = own.select("cell", part.alias("part"), F.lit(MEMBER).cast("byte").alias("kind"), "key", "vec")

    def meet(asked: DataFrame) -> DataFrame:
        # only parts that somebody asks are read
        used = asked.select("cell", "part").distinct()
        both = asked.unionByName(members.join(used, ["cell", "part"], "left_semi"))
        hits = both.repartition("cell", "part").sortWithinPartitions("cell", "part", "kind").mapInArrow(
            best_in_part(k), f"query {kind}, key {kind}, similarity double")
        return stage(top_n_per_key(hits, ["query"], [F.desc("similarity"), "key"], k), "hits")

    near = meet(wanted.mapInArrow(ask(found, first), sql))
    last = near.groupBy(F.col("query").alias("key")).agg(F.min("similarity").alias("s"), F.count("*").alias("n"))
    reach = F.when(F.col("n") >= k, F.acos(F.greatest(F.lit(-1.0), F.col("s") - 1e-6))).otherwise(F.lit(4.0))
    more = meet(wanted.join(last, "key", "left").select("key", "vec", F.coalesce(reach, F.lit(4.0)).alias("reach")).mapInArrow(
        ask(found, first), sql))
    ranked = top_n_per_key(near.unionByName(more), ["query"], [F.desc("similarity"), "key"], k, rank="rank")
    return ranked.select("query", "key", "similarity", F.col("rank").cast("int").alias("rank"))
