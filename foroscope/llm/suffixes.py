"""Suffix-array dedup of repeated byte strings with a distributed difference-cover algorithm.

Suffixes that share 50 bytes share every choice that depends on these bytes alone. So each position is sent to the shard
of its anchor, the smallest hash among the 20-byte strings inside its 50 bytes: suffixes that could be adjacent with a
common prefix of 50 bytes always meet in one shard. Positions of one anchor are consecutive and travel as one context,
named by its hash. Contexts with the same name have the same suffixes: all but those of the smallest document are
repeats. Where an anchor has differently named contexts in several documents, the contexts themselves go to the shard;
those that agree with none of another document in the 15 bytes on one side of the anchor cannot share 50 and are left out.
Strings of 20 bytes seldom meet by chance however large the table is; of shorter ones a growing share does.
An anchor with more than ``HOT`` open contexts (the edge of a very common line) is not sorted in one task: its 50-byte
strings are compared one by one, by name, those that repeat in a batch only once.
In a shard the suffix array is built by the difference cover modulo 3 (sorted triples at two thirds of the positions are named,
the names are sorted by recursion, the remaining suffixes are sorted by them and merged), and adjacent suffixes are
compared in their first 50 bytes.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foroscope.llm.common import group_starts, id_text, row_key, ship_by_value, texts_of, to_batch, whole_groups
from foroscope.session import stage

ship_by_value(__name__)

LENGTH = 50
GRAM = 20
WINDOW = LENGTH - GRAM + 1  # 20-byte strings inside 50 bytes
PIECE = 1 << 22  # bytes that are hashed at once; positions in a piece fit in 24 bits
SHARD = 1 << 20  # bytes of contexts sorted at once
#: Contexts of one anchor that would not fit a shard are compared string by string, each string in a group of its own.
HOT = SHARD // (LENGTH + GRAM)
LOW24 = np.uint64((1 << 24) - 1)
COUNT_BITS = 6
#: Of the 30 bytes of a shared string beside its anchor, so many are on one side.
SIDE = (LENGTH - GRAM) // 2
ROWS = pa.schema([("kind", pa.int8()), ("key", pa.int64()), ("name", pa.int64()), ("id", pa.int64()),
                  ("version", pa.int64()), ("place", pa.int64())])
ROWS_SQL = "kind byte, key long, name long, id long, version long, place long"
FOUND = pa.schema([("kind", pa.int8()), ("key", pa.int64()), ("id", pa.int64()), ("version", pa.int64()),
                   ("place", pa.int64())])
FOUND_SQL = "kind byte, key long, id long, version long, place long"
CONTEXT = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("version", pa.int64()), ("place", pa.int64()),
                     ("context", pa.binary())])
GONE, ASK = 0, 1

def gram_hashes(text: np.ndarray) -> np.ndarray:
    """64-bit hash of each 20-byte string."""
    n = len(text) - GRAM + 1
    a, b, c = (np.ndarray((n,), "<u8", text, k, (1,)) for k in (0, 8, GRAM - 8))
    h = a * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += b * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h += c * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))

def contexts(text: bytes):
    """(first position, number of positions, anchor hash) of each run of positions with the same anchor."""
    data = np.frombuffer(text, np.uint8)
    firsts, counts, keys = [], [], []
    for begin in range(0, len(data) - LENGTH + 1, PIECE):
        part = np.ascontiguousarray(data[begin:begin + PIECE + LENGTH - 1])
        hashes = gram_hashes(part)
        least = hashes & ~LOW24 | np.arange(len(hashes), dtype=np.uint64)  # ties go to the left
        have = 1
        while have < WINDOW:
            step = min(have, WINDOW - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        anchor = (least & LOW24).astype(np.int64)
        first = group_starts([anchor])
        firsts.append(first + begin)
        counts.append(np.diff(np.append(first, len(anchor))))
        keys.append(hashes[anchor[first]])
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(keys)

def pack(first, count):
    return first << COUNT_BITS | count

def unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return place >> COUNT_BITS, place & ((1 << COUNT_BITS) - 1)

def first_of_batch(key, name, doc, version, place) -> pa.RecordBatch:
    """Of rows with one name only those of the smallest document go on; the others are gone already."""
    order = np.lexsort((doc, name, key))
    start = group_starts([key[order], name[order]])
    smallest = np.repeat(doc[order][start], np.diff(np.append(start, len(order))))
    kind = np.full(len(order), ASK, np.int8)
    kind[order] = np.where(doc[order] > smallest, GONE, ASK)
    return to_batch(ROWS, kind, key, name, doc, version, place)

def name_contexts(batches):
    """Contexts of whole texts."""
    for batch in batches:
        key, name, doc, versions, place = [], [], [], [], []
        for i, version, text in zip(batch.column("id").to_pylist(), batch.column("version").to_pylist(), texts_of(batch),
                                    strict=True):
            first, count, hashes = contexts(text)
            if not len(first):
                continue
            view, digest = memoryview(text), xxhash.xxh3_64_intdigest
            ends = first + count + LENGTH - 1
            name.append(np.array([digest(view[a:b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)],
                                 np.uint64))
            key.append(hashes)
            doc.append(np.full(len(first), i))
            versions.append(np.full(len(first), version))
            place.append(pack(first, count))
        if key:
            key, name = (np.concatenate(x).view(np.int64) for x in (key, name))
            yield first_of_batch(key, name, np.concatenate(doc), np.concatenate(versions), np.concatenate(place))

def name_strings(batches):
    """The 50-byte strings of the contexts of hot anchors, one by one."""
    for batch in batches:
        name, doc, versions, place = [], [], [], []
        for i, version, text, asked in zip(batch.column("id").to_pylist(), batch.column("version").to_pylist(),
                                           texts_of(batch), batch.column("asked").to_pylist(), strict=True):
            view, digest = memoryview(text), xxhash.xxh3_64_intdigest
            for x in asked:
                first, count = unpack(x["place"])
                name += [digest(view[p:p + LENGTH]) for p in range(first, first + count)]
                place += [pack(p, 1) for p in range(first, first + count)]
                doc += [i] * count
                versions += [version] * count
        if name:
            name = np.array(name, np.uint64).view(np.int64)
            yield first_of_batch(name, name, np.array(doc), np.array(versions), np.array(place))

def compare_names(batches):
    """By anchor: contexts that a smaller document has too are gone, others that may share a part are asked about.

    Rows come sorted by anchor, name and document, decided ones anywhere, and are read as a stream. Of an anchor whose
    contexts have one name, or come from one document, the open ones are held back; once it has more, they pass."""
    last, held, several = None, None, False
    for batch in batches:
        kind, key, name, doc, version, place = (batch.column(c).to_numpy() for c in ROWS.names)
        gone = kind == GONE
        if gone.any():
            yield batch.filter(pa.array(gone)).select(FOUND.names)
            key, name, doc, version, place = (c[~gone] for c in (key, name, doc, version, place))
        if not len(key):
            continue
        starts = group_starts([key, name])
        first = np.repeat(doc[starts], np.diff(np.append(starts, len(key))))
        if last and last[:2] == (key[0], name[0]):
            first[:len(key) if len(starts) == 1 else starts[1]] = last[2]
        late = doc > first
        yield to_batch(FOUND, np.full(int(late.sum()), GONE, np.int8), *(c[late] for c in (key, doc, version, place)))
        if not (last and last[0] == key[0]):
            held, several = None, False
        last = (key[-1], name[-1], first[-1])
        rows = [c[~late] for c in (key, name, doc, version, place)]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        held = None
        if not len(rows[0]):
            continue
        starts = group_starts(rows[:1])
        sizes = np.diff(np.append(starts, len(rows[0])))
        names = np.zeros(len(rows[0]), np.int64)
        names[group_starts(rows[:2])] = 1
        many = (np.add.reduceat(names, starts) > 1) & (np.maximum.reduceat(rows[2], starts) >
                                                       np.minimum.reduceat(rows[2], starts))
        if several and rows[0][0] == key[0]:
            many[0] = True
        if rows[0][-1] == key[-1]:  # else the anchor that goes on had nothing open here
            several = bool(many[-1])
            if not several:
                held = [c[starts[-1]:] for c in rows]
        asked = np.repeat(many, sizes)
        yield to_batch(FOUND, np.full(int(asked.sum()), ASK, np.int8), *(rows[i][asked] for i in (0, 2, 3, 4)))

def one_key(*columns: np.ndarray) -> np.ndarray:
    """Rows of names as single numbers in the same order."""
    out, room = columns[0], 63 - int(columns[0].max(initial=0)).bit_length()
    for c in columns[1:]:
        bits = int(c.max(initial=0)).bit_length()
        if bits > room:  # names of what has been joined so far
            out = np.unique(out, return_inverse=True)[1].astype(np.int64)
            room = 63 - int(out.max(initial=0)).bit_length()
        out = out << bits | c
        room -= bits
    return out

def suffix_order(s: np.ndarray) -> np.ndarray:
    """Suffix array of names of 1 and more by the difference cover modulo 3."""
    n = len(s)
    if n < 4:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    padded = np.concatenate([s, np.zeros(4, np.int64)])
    # positions 1 and 2 modulo 3; one more behind the end keeps the halves apart in the recursion
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    triple = one_key(padded[sample], padded[sample + 1], padded[sample + 2])
    order = np.argsort(triple, kind="stable")
    new = np.ones(len(order), np.int64)
    new[1:] = triple[order][1:] != triple[order][:-1]
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(new)
    if names.max() < len(names):
        order = suffix_order(names)
    rank = np.zeros(n + 4, np.int64)
    rank[sample[order]] = np.arange(1, len(order) + 1)
    sampled = sample[order]
    sampled = sampled[sampled < n]
    # the remaining suffixes: by first name, then by the sampled suffix behind it
    zeros = np.arange(0, n, 3)
    zeros = zeros[np.argsort(one_key(padded[zeros], rank[zeros + 1]), kind="stable")]
    # merge: against ones by (name, rank), against twos by (name, name, rank)
    before = np.zeros(len(zeros), np.int64)
    for k in (1, 2):
        other = sampled[sampled % 3 == k]
        both = np.concatenate([other, zeros])
        keys = one_key(*(padded[both + i] for i in range(k)), rank[both + k])
        before += np.searchsorted(keys[:len(other)], keys[len(other):])
    out = np.empty(n, np.int64)
    at = before + np.arange(len(zeros))
    out[at] = zeros
    rest = np.ones(n, bool)
    rest[at] = False
    out[rest] = sampled
    return out

def repeated_positions(pieces: list[bytes], docs: np.ndarray) -> np.ndarray:
    """Flags over the joined pieces (each followed by one separator): its 50 bytes also begin in a smaller document."""
    lengths = np.array([len(p) + 1 for p in pieces])
    ends = np.cumsum(lengths) - 1
    data = np.frombuffer(b"\0".join(pieces) + bytes(9), np.uint8)
    size = int(lengths.sum())
    text = data[:size].astype(np.int64) + len(pieces) + 1
    text[ends] = np.arange(1, len(pieces) + 1)  # separators are all different
    piece = np.repeat(np.arange(len(pieces)), lengths)
    order = suffix_order(text)
    order = order[ends[piece[order]] - order >= LENGTH]
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        word = np.ndarray((size,), "<u8", data, 0, (1,))[np.minimum(order + k, size - 1)]
        same &= word[1:] == word[:-1]
    flags = np.zeros(size, bool)
    if len(order):
        start = np.flatnonzero(np.append(True, ~same))
        doc = docs[piece[order]]
        smallest = np.repeat(np.minimum.reduceat(doc, start), np.diff(np.append(start, len(order))))
        flags[order] = doc > smallest
    return flags

def side_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the ``SIDE`` bytes from each place on."""
    def word(offset):
        return np.ndarray((len(data) - 8,), "<u8", data, 0, (1,))[at + offset]

    h = word(0) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(31)) ^ word(SIDE - 8)) * np.uint64(0xC2B2AE3D27D4EB4F)

def may_share(pieces: list[bytes], keys: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Contexts that agree with one of another document in the 15 bytes on one side of their common anchor.

    Contexts of one anchor that share 50 bytes share them around the anchor's 20, so 15 or more on one side."""
    lengths = np.array([len(p) for p in pieces])
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(pieces) + bytes(2 * SIDE + GRAM), np.uint8)
    piece = np.repeat(np.arange(len(pieces)), lengths)
    at = np.flatnonzero(gram_hashes(data)[:len(piece)].view(np.int64) == keys[piece])
    at = at[at + GRAM <= ends[piece[at]]]
    left = at[at - SIDE >= (ends - lengths)[piece[at]]]
    right = at[at + GRAM + SIDE <= ends[piece[at]]]
    kept = np.zeros(len(pieces), bool)
    for places, start in ((left, left - SIDE), (right, right + GRAM)):
        if len(places):
            own = piece[places]
            sides = side_hashes(data, start)
            order = np.lexsort((docs[own], sides, keys[own]))
            own = own[order]
            begin = group_starts([keys[own], sides[order]])
            several = np.minimum.reduceat(docs[own], begin) < np.maximum.reduceat(docs[own], begin)
            kept[own[np.repeat(several, np.diff(np.append(begin, len(own))))]] = True
    return kept

def sort_shards(batches):
    """Suffix arrays of whole anchors, some anchors to a shard; repeated positions as runs."""
    for table, starts in whole_groups(batches, ["key"]):
        pieces = table.column("context").to_pylist()
        keys, ids, versions, places = (table.column(c).to_numpy() for c in ("key", "id", "version", "place"))
        kept = np.flatnonzero(may_share(pieces, keys, ids))
        if not len(kept):
            continue
        pieces, keys, ids, versions, places = [pieces[i] for i in kept], keys[kept], ids[kept], versions[kept], places[kept]
        sizes = np.cumsum([len(p) + 1 for p in pieces])
        ends = np.append(group_starts([keys])[1:], len(pieces))
        at = 0
        while at < len(pieces):  # whole anchors up to the size of a shard, one at least
            room = ends[np.searchsorted(ends, at, "right"):]
            fits = room[sizes[room - 1] - (sizes[at - 1] if at else 0) <= SHARD]
            stop = int(fits[-1] if len(fits) else room[0])
            flags = repeated_positions(pieces[at:stop], ids[at:stop])
            edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
            begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            offset = sizes[at:stop] - (sizes[at - 1] if at else 0)
            piece = np.searchsorted(offset, begin, "right")
            first, _ = unpack(places[at:stop][piece])
            inside = begin - np.append(0, offset)[piece]
            yield to_batch(FOUND, np.full(len(begin), GONE, np.int8), np.zeros(len(begin), np.int64),
                           ids[at:stop][piece], versions[at:stop][piece], pack(first + inside, end - begin))
            at = stop

def cut_contexts(batches):
    for batch in batches:
        keys, ids, versions, places, cut = [], [], [], [], []
        for i, version, text, asked in zip(batch.column("id").to_pylist(), batch.column("version").to_pylist(),
                                           texts_of(batch), batch.column("asked").to_pylist(), strict=True):
            for x in asked:
                first, count = unpack(x["place"])
                keys.append(x["key"])
                ids.append(i)
                versions.append(version)
                places.append(x["place"])
                cut.append(text[first:first + count + LENGTH - 1])
        yield to_batch(CONTEXT, keys, ids, versions, places, cut)

def met_names(rows: DataFrame) -> DataFrame:
    """Names of one anchor in one task; decided rows go anywhere."""
    shard = F.when(F.col("kind") == ASK, F.col("key")).otherwise(F.xxhash64("id", "place"))
    # what rows of a document have in common stands together and is compressed well; sorted by anchor first, since sorting
    # compares the first column at once and the others only where it is equal
    met = rows.select("key", "name", "place", "id", "version", "kind").repartition(shard).sortWithinPartitions("key", "name", "id", "version", "place")
    return met.mapInArrow(compare_names, FOUND_SQL)

def repeated_runs(docs: DataFrame) -> DataFrame:
    """(id, version, places) of (id, version, text) rows: runs of positions whose 50 bytes begin in a smaller document."""
    found = stage(met_names(docs.mapInArrow(name_contexts, ROWS_SQL)), "contexts")
    open_ = found.filter(F.col("kind") == ASK)
    hot = stage(open_.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("key"), "hot-anchors")

    def with_texts(asked: DataFrame) -> DataFrame:  # in one query with its result, so that the texts move once
        lists = asked.groupBy("id", "version").agg(F.collect_list(F.struct("key", "place")).alias("asked"))
        return docs.join(lists, ["id", "version"]).select("id", "version", "text", "asked")

    cut = with_texts(open_.join(hot, "key", "left_anti")).mapInArrow(
        cut_contexts, "key long, id long, version long, place long, context binary")
    shards = cut.repartition("key").sortWithinPartitions("key", "id", "version", "place")
    gone = found.filter(F.col("kind") == GONE).unionByName(shards.mapInArrow(sort_shards, FOUND_SQL))
    if not hot.isEmpty():
        strings = with_texts(open_.join(hot, "key", "left_semi")).mapInArrow(name_strings, ROWS_SQL)
        gone = gone.unionByName(met_names(strings).filter(F.col("kind") == GONE))
    return gone.groupBy("id", "version").agg(F.collect_list("place").alias("places"))

def kept_bytes(text: bytes, places: np.ndarray) -> tuple[bytes, int]:
    """The text without the bytes that the runs cover, and the number of maximal removed stretches."""
    first, count = unpack(places)
    edges = np.zeros(len(text) + 1, np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, first + count + LENGTH - 1, -1)
    gone = np.cumsum(edges[:-1]) > 0
    spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1))
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), spans

def cut_repeats(batches):
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept", pa.binary())])
    for batch in batches:
        out = []
        for text, places in zip(texts_of(batch), batch.column("places").to_pylist(), strict=True):
            kept, spans = kept_bytes(text, np.array(places, np.int64)) if places else (text, 0)
            out.append((len(text), len(text) - len(kept), spans, kept))
        yield to_batch(schema, batch.column("id"), *(list(c) for c in zip(*out, strict=True))) if out else to_batch(
            schema, [], [], [], [], [])

def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) for every row.

    Each byte goes that is covered by a 50-byte string of the whole UTF-8 text which also starts in a document of a
    smaller id; strings are judged on the input. ``kept`` has the remaining bytes, ``n_spans`` counts maximal removed
    stretches.

    Null texts are empty. Texts of less than 50 bytes lose nothing. Rows without an id count as one document behind all
    others, and rows that repeat an id as one document: they take nothing from each other (a 64-bit hash of the text, 0
    where an id has one row only, tells such rows apart). An empty table gives an empty result; further columns are
    ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(row_key(id_col).alias("id"), text.alias("text"))
    shared = stage(rows.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id"), "shared-ids")
    version = F.when(F.col("known"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    rows = rows.join(shared.withColumn("known", F.lit(True)), "id", "left").select("id", version.alias("version"), "text")
    joined = rows.join(repeated_runs(rows), ["id", "version"], "left").select("id", "text", "places")
    return joined.mapInArrow(cut_repeats, "id long, n_bytes long, n_removed long, n_spans long, kept binary")

def repeated_bytes(docs: DataFrame) -> DataFrame:
    """Digest of the dedup over ``documents``."""
    return suffix_dedup(docs).select(id_text("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                                     F.sha2("kept", 256).alias("kept_sha256"))
