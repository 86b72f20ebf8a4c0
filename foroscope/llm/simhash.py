"""SimHash near-dedup with bit-sliced comparison.

Distinct fingerprints are joined in blocks of equal keys. For a small radius the keys are exact: fingerprints of 64 bits
that differ in at most ``radius`` of them agree in at least ``intact`` of ``radius + intact`` bit blocks, so every choice
of ``intact`` blocks is a key (radius 4, 3 intact: 35 keys of 27 bits). For a wide radius the keys are random samples of
bits, as many as the wanted recall needs.

Inside the blocks, bits are stored as vertical planes, 64 fingerprints to a word. One plane after the other is added to
carry-save counters, and words in which every counter has overflowed the radius are given up. Short blocks, one behind
the other, are compared with themselves shifted; in a long block each query is compared with all planes. Blocks above
a size are dealt into pairs of parts. A block returns a spanning forest of its links, not all pairs.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foroscope.llm.common import (LOWER, block_pairs, group_starts, id_text, row_key, ship_by_value, texts_of, to_batch,
                                   whole_groups)
from foroscope.operators.graph import components
from foroscope.session import drop_stage, restage, stage

ship_by_value(__name__)

FULL = np.uint64(2**64 - 1)
PRINTS = pa.schema([("id", pa.int64()), ("fp", pa.list_(pa.int64()))])
EDGES = pa.schema([("user_a", pa.int64()), ("user_b", pa.int64())])
SETS_SQL = "id long, version long, node long, size long, fp array<long>"
SETS = pa.schema([("id", pa.int64()), ("version", pa.int64()), ("node", pa.int64()), ("size", pa.int64()),
                  ("fp", pa.list_(pa.int64()))])
BLOCK = 4096
SHORT = 64
CHUNK = 1 << 16
#: The pipeline's stage: five words, 256 bits. A pair of similarity 0.8 differs in 15 % of its bits (39); sampling noise
#: is 6 bits, so the radius is four of them wider. Unrelated texts differ in about 128.
WIDE = {"width": 5, "words": 4, "radius": 64, "tables": 96, "sampled": 14}
#: Share of pairs of similarity 0.8 that one more sampled bit keeps.
KEPT = 0.849
#: Buckets whose counts bound the shingles that two sets have in common.
BUCKETS = 256
#: Forests of a round for each one of the round before.
MORE = 8
#: Copies of a hot node's shingles at most.
SALTS = 64


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 (seed 42) of all runs of ``width`` words, repeats included; of the whole sequence if there are fewer."""
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-width]]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], 42) for a, b in zip(starts, (ends[width - 1:] - 1).tolist(), strict=True)],
                    np.uint64)


def mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """Further 64 bits of a hash (multiply and shift); word 0 is the hash itself."""
    if not word:
        return hashes
    x = (hashes ^ np.uint64(0x9E3779B97F4A7C15 * word % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(hashes: np.ndarray, words: int = 1) -> list[int]:
    """Bits set in more than half of the hashes, as signed 64-bit words."""
    out = []
    for word in range(words):
        counts = np.zeros(64, np.int64)
        for i in range(0, len(hashes), CHUNK):
            bits = np.unpackbits(mixed(hashes[i:i + CHUNK], word).view(np.uint8).reshape(-1, 8), axis=1,
                                 bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0]))
    return out


def make_prints(width: int, words: int):
    def run(batches):
        for batch in batches:
            yield to_batch(PRINTS, batch.column("id"),
                           [fingerprint(shingle_hashes(t, width), words) for t in texts_of(batch)])
    return run


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int, words: int) -> DataFrame:
    return docs.select(row_key(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        make_prints(width, words), "id long, fp array<long>")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def exact_masks(radius: int, intact: int) -> list[list[int]]:
    """One mask for each choice of ``intact`` among ``radius + intact`` blocks of 64 bits."""
    n = radius + intact
    cuts = [64 * i // n for i in range(n + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [[signed(sum(chosen))] for chosen in combinations(parts, intact)]


def sampled_masks(words: int, tables: int, sampled: int) -> list[list[int]]:
    """Masks of ``sampled`` random bits each, the same in every run."""
    draw = np.random.default_rng(42)
    masks = []
    for _ in range(tables):
        bits = draw.choice(64 * words, sampled, replace=False).tolist()
        masks.append([signed(sum(1 << b % 64 for b in bits if b // 64 == w)) for w in range(words)])
    return masks


def planes_of(prints: np.ndarray) -> np.ndarray:
    """(n, words) fingerprints to vertical planes: row b has bit b of all fingerprints, 64 to a word."""
    n, words = prints.shape
    width = -(-n // 64) * 64
    bits = np.zeros((64 * words, width), np.uint8)
    bits[:, :n] = np.unpackbits(np.ascontiguousarray(prints).view(np.uint8), axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64)


def pack_bits(flags: np.ndarray) -> np.ndarray:
    width = -(-len(flags) // 64) * 64
    return np.packbits(np.pad(flags.astype(np.uint8), (0, width - len(flags))), bitorder="little").view(np.uint64)


def set_bits(words: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


class Counters:
    """Carry-save counters for many distances, one bit column each, that overflow beyond the radius."""

    def __init__(self, closed: np.ndarray, radius: int):
        bits = radius.bit_length()
        start = (1 << bits) - 1 - radius
        self.over = closed.copy()
        self.bits = [np.full(closed.shape, FULL if start >> i & 1 else 0, np.uint64) for i in range(bits)]

    def add(self, differing: np.ndarray) -> None:
        for c in self.bits:
            carry = differing & c
            c ^= differing
            differing = carry
        self.over |= differing

    def keep(self, rows: np.ndarray) -> None:
        self.over = self.over[rows]
        self.bits = [c[rows] for c in self.bits]


def near_neighbours(prints: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the radius in short groups that stand one behind the other."""
    planes = planes_of(prints)
    first, second = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for d in range(1, SHORT):
        same = np.zeros(len(group), bool)
        same[:-d or None] = group[d:] == group[:-d] if d < len(group) else False
        if not same.any():
            break
        open_ = pack_bits(same)
        words = np.flatnonzero(open_)
        counters = Counters(~open_[words], radius)
        skip, s = divmod(d, 64)
        for b in range(len(planes)):
            plane = planes[b]
            after = np.append(plane[1:], np.uint64(0))
            other = (plane[words] >> np.uint64(s)) | (after[words] << np.uint64(64 - s))
            counters.add(plane[words] ^ other)
            if b % 16 == 15:
                alive = counters.over != FULL
                if alive.sum() < 0.7 * len(words) or not alive.any():
                    words = words[alive]
                    counters.keep(alive)
                    if not len(words):
                        break
        if len(words):
            found = np.zeros(planes.shape[1], np.uint64)
            found[words] = ~counters.over
            i = set_bits(found)
            first.append(i)
            second.append(i + d)
    return np.concatenate(first), np.concatenate(second)


def near_queries(planes: np.ndarray, valid: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Words of bits: which fingerprints of the block are within the radius of each query."""
    found = np.zeros((len(queries), planes.shape[1]), np.uint64)
    active = np.arange(len(queries))
    counters = Counters(np.broadcast_to(~valid, found.shape), radius)
    for b in range(len(planes)):
        ones = np.where(queries[active, b // 64] >> np.uint64(b % 64) & np.uint64(1), FULL, np.uint64(0))
        counters.add(planes[b][None, :] ^ ones[:, None])
        if b % 16 == 15:
            alive = (counters.over != FULL).any(axis=1)
            if not alive.all():
                active = active[alive]
                counters.keep(alive)
                if not len(active):
                    return found
    found[active] = ~counters.over
    return found


def forest(prints: np.ndarray, radius: int) -> np.ndarray:
    """Links (first member of the component, other member) of one long block."""
    planes, valid = planes_of(prints), pack_bits(np.ones(len(prints), bool))
    open_, links, near = valid.copy(), [], {}
    for root in range(len(prints)):
        bit = np.uint64(1) << np.uint64(root & 63)
        if not open_[root >> 6] & bit:
            continue
        open_[root >> 6] &= ~bit
        queue = [root]
        while queue:
            if queue[-1] not in near:  # the next ones are compared together
                ahead = [q for q in queue[-128:] if q not in near]
                ahead += [q for q in range(root + 1, min(root + 129 - len(ahead), len(prints)))
                          if q not in near and q not in ahead and len(queue) == 1]
                near.update(zip(ahead, near_queries(planes, valid, prints[ahead], radius), strict=True))
            fresh = near.pop(queue.pop()) & open_
            open_ &= ~fresh
            members = set_bits(fresh).tolist()
            links += [(root, m) for m in members]
            queue += members
    return np.array(links, np.int64).reshape(-1, 2)


def stars(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Pairs to links from the first member of each component to the others."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    members = np.flatnonzero(label != np.arange(n))
    return np.stack([label[members], members], 1)


def link_blocks(radius: int):
    def run(batches):
        for table, starts in whole_groups(batches, ["key", "lo", "hi"]):
            nodes = table.column("node").to_numpy()
            prints = table.column("fp").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(nodes), -1)
            sizes = np.diff(np.append(starts, len(nodes)))
            group = np.repeat(np.arange(len(starts)), sizes)
            some = np.flatnonzero((sizes > 1)[group] & (sizes <= SHORT)[group])
            links = []
            if len(some):
                pairs = near_neighbours(prints[some], group[some], radius)
                links.append(some[stars(*pairs, len(some))])
            for g in np.flatnonzero(sizes > SHORT):
                links.append(starts[g] + forest(prints[starts[g]:starts[g] + sizes[g]], radius))
            links = np.concatenate(links) if links else np.zeros((0, 2), np.int64)
            yield to_batch(EDGES, nodes[links[:, 0]], nodes[links[:, 1]])
    return run


def keyed_blocks(classes: DataFrame, masks: list[list[int]], block: int = BLOCK) -> DataFrame:
    """Each node once for every mask, sorted by blocks of equal key."""
    keys = F.array(*[F.xxhash64(F.lit(i), *[F.col("fp")[w].bitwiseAND(F.lit(m)) for w, m in enumerate(mask) if m])
                     for i, mask in enumerate(masks)])
    rows = block_pairs(classes.withColumn("key", F.explode(keys)), "key", "node", block, inside=False)
    return rows.select("key", "lo", "hi", *classes.columns).repartition("key", "lo", "hi").sortWithinPartitions(
        "key", "lo", "hi", "node")


def linked_prints(classes: DataFrame, masks: list[list[int]], radius: int, block: int = BLOCK) -> DataFrame:
    """Links between the nodes of distinct fingerprints that make up all components within the radius."""
    ordered = keyed_blocks(classes.select("node", "fp"), masks, block)
    return ordered.mapInArrow(link_blocks(radius), "user_a long, user_b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, words: int = 1,
                    radius: int = 4, intact: int = 3, tables: int = 0, sampled: int = 0) -> DataFrame:
    """(id, fp, component_id) for every row: the smallest id that is reachable over fingerprints within the radius.

    Whole texts in lower case (A-Z), words split at ASCII blanks, shingles of ``width`` words. A fingerprint bit is 1
    if it is set in over half of the shingle hashes. One word of 64 bits is searched exactly; more ``words`` by
    ``tables`` keys of ``sampled`` bits, each of which finds a pair that differs in a share p of its bits with
    probability (1 - p) ** sampled.

    Null, empty and blank texts have fingerprint 0 and are linked like any other. Rows without an id come behind all
    others. Repeated rows get repeated results. An empty table gives an empty result; further columns are ignored.
    """
    rows = stage(fingerprints(docs, id_col, text_col, width, words), "prints")
    node = F.col("fp")[0] if words == 1 else F.xxhash64("fp")
    classes = stage(rows.groupBy("fp").agg(F.min("id").alias("first")).withColumn("node", node), "classes")
    masks = sampled_masks(words, tables, sampled) if tables else exact_masks(radius, intact)
    found = components(linked_prints(classes, masks, radius))
    linked = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    named = linked.join(first, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("id", "fp", "component_id")


def distinct_shingles(text: bytes, width: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, width))


def make_sets(width: int, words: int):
    """Name, size and fingerprint of the set of distinct shingles of each text."""
    def run(batches):
        for batch in batches:
            sets = [distinct_shingles(t, width) for t in texts_of(batch)]
            yield to_batch(SETS, batch.column("id"), batch.column("version"),
                           [signed(xxhash.xxh3_64_intdigest(s.tobytes())) for s in sets], [len(s) for s in sets],
                           [fingerprint(s, words) for s in sets])
    return run


def list_sets(width: int):
    schema = pa.schema([("node", pa.int64()), ("set", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            yield to_batch(schema, batch.column("node"), [distinct_shingles(t, width).view(np.int64) for t in texts_of(batch)])
    return run


def distances(prints: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints[a] ^ prints[b]).sum(axis=1, dtype=np.int64)


def shortest_forest(a: np.ndarray, b: np.ndarray, weight: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Places of the pairs that make up a minimum spanning forest over ``label``, by merging along shortest pairs."""
    order = np.lexsort((b, a, weight))
    label, out = label.copy(), []
    while len(order):
        order = order[label[a[order]] != label[b[order]]]
        if not len(order):
            break
        best = np.full(len(label), len(order))
        rank = np.arange(len(order))
        np.minimum.at(best, label[a[order]], rank)
        np.minimum.at(best, label[b[order]], rank)
        chosen = order[np.unique(best[best < len(order)])]
        out.append(chosen)
        low, high = np.minimum(label[a[chosen]], label[b[chosen]]), np.maximum(label[a[chosen]], label[b[chosen]])
        parent = np.arange(len(label))
        while True:  # the chosen pairs' components get their smallest label
            before = parent.copy()
            least = np.minimum(parent[low], parent[high])
            np.minimum.at(parent, low, least)
            np.minimum.at(parent, high, least)
            parent = parent[parent]
            if (parent == before).all():
                break
        label = parent[label]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def grow_forest(prints: np.ndarray, near: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Minimum spanning forest of one long block over ``label``, node by node along the shortest link."""
    n, far = len(prints), 1 << 30
    best, via = np.full(n, far), np.full(n, -1)
    open_, links = np.ones(n, bool), []
    for start in range(n):
        node, steps = start, 0
        if not open_[start]:
            continue
        while True:
            open_[node] = False
            if steps and best[node] >= 0:
                links.append((int(via[node]), node))
            members = set_bits(near[node])
            members = members[open_[members]]
            d = distances(prints, np.full(len(members), node), members)
            closer = d < best[members]
            best[members[closer]], via[members[closer]] = d[closer], node
            best[open_ & (label == label[node])] = -1  # joined already
            steps += 1
            waiting = np.where(open_, best, far)
            node = int(waiting.argmin())
            if waiting[node] == far:
                break
    return links


def bucket_counts(batches):
    """Per set the number of shingles in each of ``BUCKETS`` buckets; nothing for a set with more than 255 in one."""
    schema = pa.schema([("node", pa.int64()), ("counts", pa.binary())])
    for batch in batches:
        out = []
        for hashes in batch.column("set"):
            own = np.bincount(hashes.values.to_numpy() % BUCKETS, minlength=BUCKETS)
            out.append(own.astype(np.uint8).tobytes() if own.max(initial=0) < 256 else None)
        yield to_batch(schema, batch.column("node"), out)


def may_be_alike(counts: np.ndarray, known: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the buckets allow a similarity of 0.8: common shingles are at most the sum of the smaller counts."""
    out = np.ones(len(a), bool)
    for i in range(0, len(a), CHUNK):
        at = slice(i, i + CHUNK)
        common = np.minimum(counts[a[at]], counts[b[at]]).sum(axis=1, dtype=np.int64)
        out[at] = (9 * common >= 4 * (sizes[a[at]] + sizes[b[at]])) | ~known[a[at]] | ~known[b[at]]
    return out


def compatible(sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sets of these sizes can be alike to 0.8 at all."""
    return 5 * np.minimum(sizes[a], sizes[b]) >= 4 * np.maximum(sizes[a], sizes[b])


def propose(radius: int, forests: int):
    """Per block: ``forests`` minimum spanning forests without common links over its labels, of pairs within the radius
    whose sizes fit and that have not failed before."""
    def long_block(prints, sizes, label, failed, counts, known):
        n = len(prints)
        planes, valid = planes_of(prints), pack_bits(np.ones(n, bool))
        near = np.concatenate([near_queries(planes, valid, prints[q:q + 128], radius) for q in range(0, n, 128)])
        for i in range(n):
            fits = compatible(sizes, np.full(n, i), np.arange(n))
            fits[failed[i]] = False
            fits &= label != label[i]
            near[i] &= pack_bits(fits)
            if counts is not None:
                members = set_bits(near[i])
                fits[members] &= may_be_alike(counts, known, sizes, np.full(len(members), i), members)
                near[i] &= pack_bits(fits)
        for _ in range(forests):
            links = grow_forest(prints, near, label)
            yield from links
            if not links:
                break
            for a, b in links:
                near[a, b >> 6] &= ~(np.uint64(1) << np.uint64(b & 63))
                near[b, a >> 6] &= ~(np.uint64(1) << np.uint64(a & 63))

    def run(batches):
        for table, starts in whole_groups(batches, ["key", "lo", "hi"]):
            nodes, sizes = table.column("node").to_numpy(), table.column("size").to_numpy()
            prints = table.column("fp").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(nodes), -1)
            counts = np.diff(np.append(starts, len(nodes)))
            group = np.repeat(np.arange(len(starts)), counts)
            label, lists, buckets, known = np.arange(len(nodes)), [], None, None  # in the first round every node is alone
            if "label" in table.schema.names:
                lists, named = table.column("failed").to_pylist(), table.column("label").to_numpy()
                order = np.lexsort((named, group))
                found = table.column("counts").to_pylist()
                known = np.array([c is not None for c in found], bool)
                buckets = np.frombuffer(b"".join(c or bytes(BUCKETS) for c in found), np.uint8).reshape(-1, BUCKETS)
                label[order] = np.cumsum(np.isin(label, group_starts([group[order], named[order]]))) - 1
            out = [np.zeros((0, 2), np.int64)]
            some = np.flatnonzero((counts > 1)[group] & (counts <= SHORT)[group])
            if len(some):
                a, b = (some[x] for x in near_neighbours(prints[some], group[some], radius))
                fits = compatible(sizes, a, b)
                a, b = a[fits], b[fits]
                if buckets is not None:
                    fits = (label[a] != label[b]) & may_be_alike(buckets, known, sizes, a, b)
                    a, b = a[fits], b[fits]
                if any(lists):
                    bad = np.fromiter((nodes[j] in lists[i] if lists[i] else False for i, j in zip(a, b, strict=True)), bool,
                                      len(a))
                    a, b = a[~bad], b[~bad]
                weight = distances(prints, a, b)
                for _ in range(forests):
                    chosen = shortest_forest(a, b, weight, label)
                    if not len(chosen):
                        break
                    out.append(np.stack([a[chosen], b[chosen]], 1))
                    rest = np.ones(len(a), bool)
                    rest[chosen] = False
                    a, b, weight = a[rest], b[rest], weight[rest]
            for g in np.flatnonzero(counts > SHORT):
                at = slice(starts[g], starts[g] + counts[g])
                if (label[at] == label[starts[g]]).all():
                    continue
                place = {n: i for i, n in enumerate(nodes[at].tolist())}
                failed = [[place[x] for x in found or () if x in place] for found in lists[at]] or [[]] * len(place)
                links = list(long_block(prints[at], sizes[at], label[at], failed, None if buckets is None else buckets[at],
                                        None if known is None else known[at]))
                out.append(starts[g] + np.array(links, np.int64).reshape(-1, 2))
            links = nodes[np.concatenate(out)]
            yield to_batch(EDGES, links.min(axis=1), links.max(axis=1))
    return run


def alike_sets(docs: DataFrame, id_col: str, text_col: str, width: int, words: int, radius: int, tables: int,
               sampled: int) -> DataFrame:
    """(id, version, first, first_version) of every row: its id and text hash, and those of the first row of its group.

    Groups are components over pairs whose distinct shingles have a Jaccard similarity of 0.8; the first row has the
    smallest id, then the smallest text hash. Fingerprints of the distinct shingles only propose pairs: in each block
    those of a minimum spanning forest, shortest distance first. They are verified, verified links merge labels, and
    blocks with several labels propose again among what has not failed, until they have nothing left to propose. From then
    on the counts of shingles by bucket leave out pairs that cannot reach 0.8, so few proposals fail. So a failed link hides no good one, and a block never returns all its pairs at once.

    Keys have ``sampled`` bits up to 4 million documents' sets and about one more for each doubling beyond, with more
    tables for the same recall, so blocks of unrelated texts do not grow with the corpus.
    """
    texts = docs.select(row_key(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("version"))
    rows = stage(texts.mapInArrow(make_sets(width, words), SETS_SQL), "prints")
    classes = stage(rows.groupBy("node").agg(F.min(F.struct("id", "version")).alias("first"), F.min("size").alias("size"),
                                             F.min("fp").alias("fp")), "classes")
    more_bits = max(0, int(classes.count()).bit_length() - 22)
    masks = sampled_masks(words, int(np.ceil(tables / KEPT ** more_bits)), sampled + more_bits)

    def proposed(active: DataFrame, forests: int) -> DataFrame:
        blocks = keyed_blocks(active, masks)
        return stage(blocks.mapInArrow(propose(radius, forests), "user_a long, user_b long").distinct(), "links")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs with a flag: common shingles are at least 0.8 of all. A hot node's set is copied to some salts."""
        salted = pairs.withColumn("salt", F.pmod(F.xxhash64("user_b"), F.lit(SALTS)))
        a = salted.select("user_a", "salt").distinct().join(sets.select(F.col("node").alias("user_a"), F.col("set").alias("a")),
                                                            "user_a")
        with_a = salted.join(a, ["user_a", "salt"])
        turned = with_a.withColumn("salt", F.pmod(F.xxhash64("user_a"), F.lit(SALTS)))
        b = salted.select("user_b", F.pmod(F.xxhash64("user_a"), F.lit(SALTS)).alias("salt")).distinct()
        b = b.join(sets.select(F.col("node").alias("user_b"), F.col("set").alias("b")), "user_b")
        common = F.size(F.array_intersect("a", "b"))
        return stage(turned.join(b, ["user_b", "salt"]).select(
            "user_a", "user_b", (5 * common >= 4 * (F.size("a") + F.size("b") - common)).alias("alike")), "verified")

    def between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs of different labels."""
        ends = [labels.select(F.col("node").alias(f"user_{e}"), F.col("label").alias(e)) for e in "ab"]
        return pairs.join(ends[0], "user_a").join(ends[1], "user_b").filter("a <> b").select(
            F.col("a").alias("user_a"), F.col("b").alias("user_b"))

    plain = classes.select("node", "size", "fp")
    links = proposed(plain, 1)
    nodes = links.select(F.explode(F.array("user_a", "user_b")).alias("node")).distinct()
    reps = classes.join(nodes, "node", "left_semi").select("node", "first.id", "first.version")
    sets = stage(texts.join(reps, ["id", "version"]).select("node", "text").mapInArrow(
        list_sets(width), "node long, set array<long>").dropDuplicates(["node"]), "sets")
    judged = verified(links)
    found = components(judged.filter("alike").select("user_a", "user_b"), nodes)
    labels = stage(found.select("node", F.col("component").alias("label")), "labels")
    drop_stage(links)
    # labels that failed links join, closely enough to be looked at again
    wide = components(between(judged.filter("not alike"), labels))
    active = labels.join(wide.select(F.col("node").alias("label"), F.col("component").alias("wide")), "label")
    active, forests = stage(active.select("node", "label", "wide"), "active"), 1
    counts = stage(sets.join(active.select("node"), "node", "left_semi").mapInArrow(
        bucket_counts, "node long, counts binary"), "buckets")
    while True:
        split = active.groupBy("wide").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a <> b")
        bad = judged.filter("not alike")
        failed = bad.select(F.col("user_a").alias("node"), F.col("user_b").alias("other")).unionByName(
            bad.select(F.col("user_b").alias("node"), F.col("user_a").alias("other"))).groupBy("node").agg(
            F.collect_list("other").alias("failed"))
        open_ = stage(plain.join(active.join(split, "wide", "left_semi").select("node", "label"), "node").join(
            failed, "node", "left").join(counts, "node"), "open")
        links = proposed(open_, forests)
        drop_stage(open_)
        if links.isEmpty():
            break
        forests *= MORE
        fresh = verified(links)
        drop_stage(links)
        merged = components(between(fresh.filter("alike"), active)).select(
            F.col("node").alias("label"), F.col("component").alias("to"))
        judged = restage(judged.unionByName(fresh), "judged", judged)
        drop_stage(fresh)
        active = restage(active.join(merged, "label", "left").select("node", F.coalesce("to", "label").alias("label"), "wide"),
                         "active", active)
    for table in (links, sets, counts, judged):
        drop_stage(table)
    found = labels.join(active.select("node", F.col("label").alias("last")), "node", "left").select(
        "node", F.coalesce("last", "label").alias("component"))
    linked = classes.select("node", "first").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    first = linked.groupBy("component").agg(F.min("first").alias("best"))
    named = linked.join(first, "component").select("node", "best")
    return rows.select("id", "version", "node").join(named, "node").select(
        "id", "version", F.col("best.id").alias("first"), F.col("best.version").alias("first_version"))


def simhash_groups(docs: DataFrame) -> DataFrame:
    """Digest of the near-dedup over ``documents``."""
    return near_duplicates(docs).select(
        id_text("id").alias("doc_id"), F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0")).alias("fingerprint"),
        id_text("component_id").alias("component_id"))


def stage_simhash(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of documents whose five-word shingles are alike to 0.8 or more, the smallest id stays.

    Similarity is the exact share of common among all distinct shingles; 256-bit fingerprints propose the pairs. Null
    texts, texts without words and rows without an id have nothing alike and stay. An id that is repeated with another
    text is decided for each text by itself; of alike texts under one id, the one with the smallest hash stays. Rows that
    repeat both id and text stay or go together. An empty table stays empty, further columns are kept as they are.
    """
    kept = F.length(F.trim(F.translate(F.coalesce("text", F.lit("")), "\t\n\x0b\x0c\r", "     "))) > 0
    found = alike_sets(docs.filter(kept & F.col("doc_id").isNotNull()), "doc_id", "text", **WIDE)
    late = found.filter("id <> first or version <> first_version").select(
        F.col("id").alias("__late"), F.col("version").alias("__text")).distinct()
    return docs.join(late, (F.col("doc_id") == F.col("__late")) & (F.xxhash64("text") == F.col("__text")), "left_anti")
