import hashlib
import random

import numpy as np
from conftest import SF

from foroscope.llm import suffixes
from foroscope.llm.suffixes import repeated_bytes, repeated_positions, suffix_order

from .conftest import ODD

LAST = 2**63 - 1


def brute(rows):
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - 49):
            w = data[p:p + 50]
            first[w] = min(first.get(w, LAST), LAST if doc is None else doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 49):
            if first[data[p:p + 50]] < (LAST if doc is None else doc):
                gone[p:p + 50] = True
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        out.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_order():
    random.seed(3)
    for _ in range(300):
        s = np.array([random.randint(1, random.choice([1, 2, 3, 2**40])) for _ in range(random.randint(1, 50))], np.int64)
        assert suffix_order(s).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())


def test_adjacent_prefixes():
    a, b = b"x" * 20 + b"abcdefghij" * 6, b"abcdefghij" * 6 + b"\0y"
    flags = repeated_positions([a, b], np.array([2, 1]))
    want = [p < len(a) - 49 and a[p:p + 50] in b for p in range(len(a) + 1)] + [False] * (len(b) + 1)
    assert flags.tolist() == want


def test_brute_force(spark, frame):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(repeated_bytes(frame(rows))) == brute(rows)


def test_odd_rows(frame):
    long = "The same passage of more than fifty bytes, é and ü included. " * 3
    rows = [*ODD, (20, long), (21, long), (20, long), (20, "other " + long), (None, long), (None, "x" + long), (22, long[:49]),
            (23, long[:50]), (24, "z" * 300), (25, "z" * 200 + "\0" + "z" * 60)]
    assert result(repeated_bytes(frame(rows))) == brute(rows)
    assert result(repeated_bytes(frame([]))) == []


def test_pieces_and_shards(frame, monkeypatch):
    random.seed(5)
    base = "".join(random.choice("ab cd") for _ in range(900))
    rows = [(i, "".join(random.choice("xyz ") if random.random() < 0.01 else c for c in base[i * 7:])) for i in range(25)]
    monkeypatch.setattr(suffixes, "PIECE", 128)
    monkeypatch.setattr(suffixes, "SHARD", 500)
    assert result(repeated_bytes(frame(rows))) == brute(rows)


def test_thousands_of_rows_without_an_id(frame):
    """Each has its own text around one passage; they are one document, so only the copy behind id 1 loses something."""
    passage = "A common passage of more than fifty bytes that all of these rows hold somewhere. "
    rows = [(None, f"own start {i} " * (i % 5) + passage + f"own end {i}") for i in range(4000)]
    rows += [(1, passage), (2, passage), (2, "x" + passage)] + [(7, f"text {i} " + passage * (i % 3)) for i in range(50)]
    assert result(repeated_bytes(frame(rows))) == brute(rows)


def test_hot_anchors_are_compared_by_strings(frame, monkeypatch):
    """A line that all documents hold, with other bytes around it in each."""
    random.seed(9)
    line = "This line of some seventy bytes stands in every document of the whole table."
    rows = [(i, "".join(random.choices("abcdef ", k=40)) + line + "".join(random.choices("ghijk ", k=40)))
            for i in range(400)]
    rows += [(1000 + i, rows[i][1][10:100]) for i in range(0, 400, 7)]
    want = brute(rows)
    for hot in (16000, 50, 3):
        monkeypatch.setattr(suffixes, "HOT", hot)
        assert result(repeated_bytes(frame(rows).repartition(6))) == want


def test_names_are_read_as_a_stream():
    import pyarrow as pa

    random.seed(2)
    rows = sorted((random.choice([0, 1, 1, 1]), random.randint(0, 6), random.randint(0, 3), random.randint(0, 5), 0, p)
                  for p in range(120))
    rows = [r if r[0] else (0, *r[1:]) for r in rows]
    table = pa.Table.from_pylist([dict(zip(suffixes.ROWS.names, r, strict=True)) for r in rows], suffixes.ROWS)

    def found(size):
        return sorted(tuple(r.values()) for b in suffixes.compare_names(table.to_batches(max_chunksize=size))
                      for r in b.to_pylist())

    whole = found(1000)
    assert all(found(size) == whole for size in (1, 2, 3, 7, 50))
    asked = [r for r in rows if r[0] == 1]
    want = [(0, r[1], r[3], r[4], r[5]) for r in rows if r[0] == 0]
    for r in asked:
        same = [q for q in asked if q[1:3] == r[1:3]]
        first = {n: min(q[3] for q in asked if q[1] == r[1] and q[2] == n) for n in {q[2] for q in asked if q[1] == r[1]}}
        if r[3] > min(q[3] for q in same):
            want.append((0, r[1], r[3], r[4], r[5]))
        elif len(first) > 1 and len(set(first.values())) > 1:
            want.append((1, r[1], r[3], r[4], r[5]))
    assert whole == sorted(want)


def test_side_filter_loses_nothing():
    """Contexts that it leaves out share no 50 bytes with another document's."""
    random.seed(4)
    for _ in range(40):
        base = bytes(random.choice(b"abcd") for _ in range(120))
        texts = [bytes(random.choice(b"xyz") if random.random() < 0.02 else c for c in base) for _ in range(8)]
        pieces, keys, docs = [], [], []
        for d, t in enumerate(texts):
            for first, count, key in zip(*suffixes.contexts(t), strict=True):
                pieces.append(t[first:first + count + 49])
                keys.append(key)
                docs.append(d)
        order = np.argsort(np.array(keys, np.uint64).view(np.int64), kind="stable")
        pieces, docs = [pieces[i] for i in order], np.array(docs)[order]
        keys = np.array(keys, np.uint64).view(np.int64)[order]
        kept = suffixes.may_share(pieces, keys, docs)
        for i in np.flatnonzero(~kept):
            own = {pieces[i][a:a + 50] for a in range(len(pieces[i]) - 49)}
            others = [pieces[j] for j in range(len(pieces)) if docs[j] != docs[i] and keys[j] == keys[i]]
            assert not any(w in o for w in own for o in others)


def test_texts_move_once_with_hot_anchors(spark, frame, monkeypatch):
    """The strings of hot anchors are cut in the query of the result, which shuffles the texts once for all its joins."""
    rows = [(i, f"own start {i} of this row " + "A passage of more than fifty bytes that every row holds. " + f"own end {i}")
            for i in range(60)]
    staged = []
    monkeypatch.setattr(suffixes, "HOT", 3)
    monkeypatch.setattr(suffixes, "stage", lambda df, name, keep=suffixes.stage: staged.append(name) or keep(df, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = repeated_bytes(frame(rows))
        assert result(found) == brute(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(staged) == ["contexts", "hot-anchors", "shared-ids"]
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("mapInArrow") + plan.count("MapInArrow") >= 4 and plan.count("ReusedExchange") >= 2


def test_chance_meetings_do_not_open_contexts():
    """Texts of few words share many strings of 16 bytes; an anchor is longer, so fewer of them meet."""
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(60)]
    keys = [set(suffixes.contexts(" ".join(rng.choices(words, k=3000)).encode())[2].tolist()) for _ in range(8)]
    shared = [len(k & set().union(*keys[:i], *keys[i + 1:])) / len(k) for i, k in enumerate(keys)]
    assert suffixes.GRAM > 16 and max(shared) < 0.2
