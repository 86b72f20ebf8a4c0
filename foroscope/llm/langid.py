"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point. An n-gram binds its letters: the vectors are
rotated by their place and multiplied. A text is the bundle (sum) of its n-grams, a language the bundle of the texts that
teach it, and a text gets the language whose prototype has the largest cosine. Bundles are sums of integers, so they do
not depend on how the texts are dealt out; a prototype costs one vector per task and language.
"""


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foroscope.llm.common import Memo, id_text, row_key, ship_by_value, to_batch
from foroscope.session import stage

ship_by_value(__name__)

SIZE = 1024
NONE = "\U0010ffff"
GRAM = 3
CHUNK = 1 << 19  # characters whose n-grams are counted together
OWNERS = 512  # texts that are counted together
GRAMS = 2048  # different n-grams that are bound at once
LANGUAGES = 4096  # prototypes that a pass over the texts holds


@Memo
def letter_table() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


@Memo
def letter_vector(code: int) -> np.ndarray:
    """Random signs; 0 stands for what is not a letter."""
    return (np.random.Generator(np.random.Philox(key=code)).integers(0, 2, SIZE, dtype=np.int8) * 2 - 1)


def letters(text: str) -> np.ndarray:
    """Lower-case code points with 0 for each stretch of other characters, and at both ends; empty without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(letter_table()[codes], codes, 0)
    if not codes.any():
        return codes[:0]
    codes = np.concatenate([np.zeros(1, np.uint32), codes, np.zeros(1, np.uint32)])
    return codes[(codes > 0) | np.append(True, codes[:-1] > 0)]


def bundles(texts: list[tuple[int, np.ndarray]], n_owners: int) -> np.ndarray:
    """Sum of the n-gram vectors of all texts of each owner."""
    total = np.zeros((n_owners, SIZE), np.int64)
    pieces, size = [], 0
    for owner, codes in texts:
        for i in range(0, max(len(codes) - GRAM + 1, 0), CHUNK):
            pieces.append((owner, codes[i:i + CHUNK + GRAM - 1]))
            size += len(pieces[-1][1])
            if size >= CHUNK or len(pieces) >= OWNERS:
                add_bundles(pieces, total)
                pieces, size = [], 0
    if pieces:
        add_bundles(pieces, total)
    return total


def add_bundles(pieces: list[tuple[int, np.ndarray]], total: np.ndarray) -> None:
    codes = np.concatenate([c for _, c in pieces])
    ends = np.cumsum([len(c) for _, c in pieces])
    names, place = np.unique(codes, return_inverse=True)
    inside = np.ones(len(codes), bool)  # n-grams that begin here lie in one text
    for k in range(1, GRAM):
        inside[ends - k] = False
    gram = np.zeros(len(codes) - GRAM + 1, np.int64)
    for k in range(GRAM):
        gram = gram * len(names) + place[k:len(codes) - GRAM + 1 + k]
    gram = gram[inside[:len(gram)]]
    owners = np.array([o for o, _ in pieces])
    rows, row = np.unique(owners, return_inverse=True)
    row = np.repeat(row, [len(c) - GRAM + 1 for _, c in pieces])
    grams, column = np.unique(gram, return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    vectors = np.stack([letter_vector(int(c)) for c in names])
    for first in range(0, len(grams), GRAMS):  # a block of n-grams at a time, whatever the alphabet
        block = grams[first:first + GRAMS]
        a, b = np.searchsorted(column, (first, first + len(block)))
        own, here = np.unique(row[a:b], return_inverse=True)
        counts = np.bincount(here * len(block) + column[a:b] - first, minlength=len(own) * len(block))
        bound = np.ones((len(block), SIZE), np.int8)
        rest = block
        for k in range(GRAM):  # from the last letter, not rotated, to the first
            rest, letter = np.divmod(rest, len(names))
            bound *= np.roll(vectors[letter], k, axis=1)
        # sums of less than 2 ** 24 are exact
        part = counts.reshape(len(own), -1).astype(np.float32) @ bound.astype(np.float32)
        total[rows[own]] += np.rint(part).astype(np.int64)


def teach(batches):
    """One bundle per language of a task's texts; sums that have grown too many go out in parts."""
    schema = pa.schema([("lang", pa.string()), ("bundle", pa.list_(pa.int64()))])
    known: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        for at in range(0, len(langs), OWNERS):
            names = sorted(set(langs[at:at + OWNERS]))
            number = {x: i for i, x in enumerate(names)}
            rows = [(number[x], letters(t)) for x, t in zip(langs[at:at + OWNERS], texts[at:at + OWNERS], strict=True)]
            for name, vector in zip(names, bundles(rows, len(names)), strict=True):
                known[name] = known.get(name, 0) + vector
            if len(known) > LANGUAGES:
                yield to_batch(schema, list(known), [v.tolist() for v in known.values()])
                known = {}
    yield to_batch(schema, list(known), [v.tolist() for v in known.values()])


def prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> list[tuple[list[str], np.ndarray]]:
    """Languages and their unit vectors, from all rows with text and language, in blocks of about ``LANGUAGES``."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(
        "text is not null and lang is not null")
    parts = rows.mapInArrow(teach, "lang string, bundle array<long>")
    sums = parts.select("lang", F.posexplode("bundle")).groupBy("lang", "pos").agg(F.sum("col").alias("x"))
    taught = stage(sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("v")).filter(
        F.exists("v", lambda p: p["x"] != 0)), "prototypes")
    n = -(-taught.count() // LANGUAGES)
    out = []
    for i in range(n):
        got = sorted(taught.filter(F.pmod(F.xxhash64("lang"), F.lit(n)) == i).collect(), key=lambda r: r.lang)
        vectors = np.array([[p.x for p in r.v] for r in got], float).reshape(-1, SIZE)
        out.append(([r.lang for r in got], vectors / np.linalg.norm(vectors, axis=1, keepdims=True)))
    return [x for x in out if x[0]]


def identify(docs: DataFrame, model: list[tuple[list[str], np.ndarray]], id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row. The score is the cosine, 0 where it is negative; each block of languages is
    one step over the texts, the better of two blocks stays."""
    schema = pa.schema([("id", pa.int64()), ("text", pa.string()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def compare(names, matrix):
        def run(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, OWNERS):
                    part = batch.slice(at, OWNERS)
                    texts = [letters(t or "") for t in part.column("text").to_pylist()]
                    found = bundles(list(enumerate(texts)), len(texts)).astype(float)
                    norm = np.linalg.norm(found, axis=1)
                    cosine = np.clip(found @ matrix.T / np.maximum(norm, 1)[:, None], 0, 1)
                    best = cosine.argmax(axis=1)
                    score = cosine[np.arange(len(texts)), best]
                    rows = zip(norm > 0, best, score, part.column("lang_pred").to_pylist(), part.column("score").to_pylist(),
                               strict=True)
                    chosen = [(names[b], s) if known and (-s, names[b]) < (-t, old) else (old, t)
                              for known, b, s, old, t in rows]
                    yield to_batch(schema, part.column("id"), part.column("text"), [c[0] for c in chosen],
                                   [c[1] for c in chosen])
        return run

    # nothing is worse than no language: every name comes before the last code point
    rows = docs.select(row_key(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.lit(NONE).alias("lang_pred"),
                       F.lit(0.0).alias("score"))
    for names, matrix in model:
        rows = rows.mapInArrow(compare(names, matrix), "id long, text string, lang_pred string, score double")
    return rows.select("id", F.when(F.col("lang_pred") == NONE, "und").otherwise(F.col("lang_pred")).alias("lang_pred"), "score")


def held_out(id_col: str = "doc_id"):
    """One third of the documents, by checksum of the id; rows without an id are held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(True))


def languages(docs: DataFrame) -> DataFrame:
    """Language of all ``documents``, learned from those that are not held out: doc_id, held_out, lang_pred, score.

    Null texts and texts without letters are ``und`` with score 0, and so is every text when nothing teaches a
    language. Ties go to the language that is first by code point. Rows without a language teach nothing; repeated
    rows teach repeatedly and get repeated results. An empty table gives an empty result; further columns are ignored.
    """
    found = identify(docs, prototypes(docs.filter(~held_out())))
    return found.select(id_text("id").alias("doc_id"), "lang_pred", "score").withColumn(
        "held_out", held_out()).select("doc_id", "held_out", "lang_pred", "score")
