"""Quality classifier from weak labels.

Two questions are asked of a text: is it of low quality, and is it toxic. For each, several overlapping labellers vote
yes, no or nothing: heuristics on form, word lists learned from parts of the labelled rows, and the given labels. The
corpus is counted by vote pattern (at most 3 ** labellers patterns), expectation-maximisation estimates from these
counts how often each labeller is right, and the posterior of a pattern is the soft label of its documents. Soft labels
then train a linear scorer on hashed features, which judges every document by its text alone.
"""

import math
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foroscope.llm.common import id_text, row_key, ship_by_value, texts_of, to_batch

ship_by_value(__name__)

SAMPLE = 10_000  # about so many rows fit the scorers and the word lists: a documented bound
FOLDS = 3
LEAST = 4  # features of fewer sample rows get no weight
MIN_DOCS = 4  # a listed word is held by so many yes documents of its part
ODDS = 20  # and so many times as often as in no documents
TRUST = 0.98  # a given label is right at least so often
YES, NO, NONE = 1, 0, -1
BIAS = -1  # in place of a feature
ENTRIES = 1 << 20
MARKS = bytes(b for b in range(256) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 or b == 32
                                            or 9 <= b <= 13))
NOT_MARKS = bytes(b for b in range(256) if b not in MARKS and b not in b" \t\n\x0b\x0c\r")
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
LETTERS = bytes(b for b in range(256) if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
NOT_LETTERS = bytes(b for b in range(256) if b not in LETTERS)
NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
BLANKS = b" \t\n\x0b\x0c\r"


def form(text: bytes) -> dict[str, float]:
    """Measures of form, each between 0 and 1."""
    words = text.split()
    n, solid = max(len(words), 1), max(len(text.translate(None, BLANKS)), 1)
    letters = len(text.translate(None, NOT_LETTERS))
    marked = text.translate(None, NOT_MARKS)
    runs = Counter(marked.split())
    pairs = list(zip(words, words[1:], strict=False))
    return {
        "marks": min(4 * len(marked.translate(None, BLANKS)) / solid, 1.0),
        "odd_marks": min(sum(c for m, c in runs.items() if m.strip(b".,;:!?'\"()-")) / n, 1.0),
        "shouts": min(sum(c for m, c in runs.items() if len(m) > 1 and m.strip(b"!?") != m) / n, 1.0),
        "upper": min(len(text.translate(None, NOT_UPPER)) / max(letters, 1), 1.0),
        "twins": sum(a == b for a, b in pairs) / n,
        "repeats": 1 - len(set(pairs)) / len(pairs) if pairs else 0.0,
        "letters": letters / solid,
    }


#: A labeller on form votes no up to the first value and yes from the second on; the last measure falls in bad texts.
FORM_VOTES = {"odd_marks": (0.02, 0.15), "shouts": (0.02, 0.2), "upper": (0.15, 0.5), "twins": (0.05, 0.3),
              "repeats": (0.3, 0.6), "letters": (0.9, 0.7)}


def form_votes(found: dict[str, float]) -> list[int]:
    votes = []
    for name, (no, yes) in FORM_VOTES.items():
        sign = 1 if yes > no else -1
        votes.append(YES if sign * found[name] >= sign * yes else NO if sign * found[name] <= sign * no else NONE)
    return votes


def hashed(feature: bytes) -> int:
    return zlib.crc32(feature) >> 1


def form_features(text: bytes, found: dict[str, float]) -> list[int]:
    """Hashed features of form: each measure in steps, and the kinds of mark runs."""
    kinds = {m[:3] for m in text.translate(None, NOT_MARKS).split()}
    steps = [f"{k}>{i}".encode() for k, v in found.items() for i in range(17) if v > max(i / 16, 0.02)]
    return list({hashed(b"m " + k) for k in kinds} | {hashed(s) for s in steps})


def word_features(text: bytes) -> list[int]:
    """Hashed words and beginnings of words."""
    words = set(text.translate(WORD_BYTES).split())
    starts = {b"4" + w[:4] for w in words if len(w) > 4} | {b"6" + w[:6] for w in words if len(w) > 6}
    return list(set(map(hashed, words | starts)))


def vote_on_form(batches):
    """Only the votes on form of whole texts; a text without words is bad for all labellers."""
    schema = pa.schema([("id", pa.int64()), ("votes", pa.list_(pa.int8()))])
    for batch in batches:
        yield to_batch(schema, batch.column("id"), [form_votes(form(t)) if t.split() else [YES] * len(FORM_VOTES)
                                                    for t in texts_of(batch)])


def featurise(batches):
    """Votes on form and hashed features of the sample, with its labels."""
    schema = pa.schema([("id", pa.int64()), ("votes", pa.list_(pa.int8())), ("form", pa.list_(pa.int32())),
                        ("words", pa.list_(pa.int32())), ("quality", pa.int8()), ("toxic", pa.int8())])
    for batch in batches:
        texts = texts_of(batch)
        found = [form(t) for t in texts]
        yield to_batch(
            schema, batch.column("id"), [form_votes(f) if t.split() else [YES] * len(FORM_VOTES)
                                         for t, f in zip(texts, found, strict=True)],
            [form_features(t, f) for t, f in zip(texts, found, strict=True)], [word_features(t) for t in texts],
            batch.column("quality"), batch.column("toxic"))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, prior: float, kinds: int = 1, rounds: int = 500):
    """How the labellers vote given the truth, from counts of vote patterns.

    ``patterns`` is (pattern, labeller) of 1, 0 and -1 (no vote); the last labeller is the given label, which starts as
    right 98 times in 100 and is never estimated lower. The truth is no, or yes of one of ``kinds`` kinds; labellers
    are independent given it. With several kinds, kind k starts with labeller k as its finder; otherwise all
    labellers find the only kind. Returns the posterior of yes (of any kind) for each pattern, and (labeller, truth)
    shares of yes among the votes, between 0.1 % and 99.9 %.
    """
    yes, no = patterns == YES, patterns == NO
    share = np.array([1 - prior] + [prior / kinds] * kinds)
    start = np.full((patterns.shape[1], 1 + kinds), 0.05)
    if kinds == 1:
        start[:, 1] = 0.5
    else:
        start[np.arange(kinds), np.arange(kinds) + 1] = 0.8
    rate = start.copy()
    rate[-1] = [1 - TRUST] + [TRUST] * kinds
    for _ in range(rounds):
        odds = np.log(share) + yes @ np.log(rate) + no @ np.log(1 - rate)
        post = np.exp(odds - odds.max(axis=1, initial=-np.inf, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
        share = (counts @ post + 0.5) / (counts.sum() + 0.5 * len(share))
        weight = counts[:, None] * post
        new = np.clip((yes.T @ weight + start) / ((yes | no).T @ weight + 1), 1e-3, 1 - 1e-3)
        new[-1] = [min(new[-1, 0], 1 - TRUST), *np.maximum(new[-1, 1:], TRUST)]
        settled = np.abs(new - rate).max() < 1e-6
        rate = new
        if settled:
            break
    return post[:, 1:].sum(axis=1), rate


def fit_linear(rows: list[np.ndarray], target: np.ndarray, decay: float = 1.5, rounds: int = 200):
    """Logistic regression on sets of hashed features: full gradients, a step size and a lasso for each feature.

    Returns {feature: weight} and the bias. A feature needs a net pull of ``decay`` rows to get a weight. Entries are
    gone through in blocks, so that memory holds two numbers for each.
    """
    n = max(len(rows), 1)
    index = np.concatenate([*rows, np.zeros(0, np.int32)])
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    names = np.sort(index)
    start = np.flatnonzero(np.append(True, names[1:] != names[:-1])) if len(names) else np.zeros(0, np.int64)
    names = names[start[np.diff(np.append(start, len(names))) >= LEAST]]
    blocks = []
    for i in range(0, len(index), ENTRIES):
        own = index[i:i + ENTRIES]
        at = np.minimum(np.searchsorted(names, own), max(len(names) - 1, 0))
        known = names[at] == own if len(names) else np.zeros(len(own), bool)
        blocks.append((at[known].astype(np.int32), owner[i:i + ENTRIES][known]))
    del index, owner
    weights, bias = np.zeros(len(names)), 0.0
    square, square_b = np.full(len(names), 1e-8), 1e-8
    for _ in range(rounds):
        margin = np.full(len(rows), bias)
        for at, who in blocks:
            margin += np.bincount(who, weights[at], minlength=len(rows))
        error = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - target) / n
        grad = np.zeros(len(names))
        for at, who in blocks:
            grad += np.bincount(at, error[who], minlength=len(names))
        square += grad * grad
        step = 1 / np.sqrt(square)
        weights -= step * grad
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * decay / n, 0)
        square_b += error.sum() ** 2
        bias -= error.sum() / math.sqrt(square_b)
    kept = np.flatnonzero(weights)
    return dict(zip(names[kept].tolist(), weights[kept].tolist(), strict=True)), float(bias)


def listed_words(rows: list[np.ndarray], truth: np.ndarray, fold: np.ndarray) -> list[np.ndarray]:
    """For each part of the labelled rows: hashed words far more frequent in its yes documents."""
    lists = []
    for k in range(FOLDS):
        own = np.flatnonzero(fold == k)
        names, at = np.unique(np.concatenate([*[rows[i] for i in own], np.zeros(0, np.int32)]), return_inverse=True)
        yes = np.bincount(at, np.repeat(truth[own], [len(rows[i]) for i in own]), minlength=len(names))
        no = np.bincount(at, minlength=len(names)) - yes
        n_yes, n_no = max(truth[own].sum(), 1), max((1 - truth[own]).sum(), 1)
        lists.append(names[(yes >= MIN_DOCS) & (yes / n_yes > ODDS * (no + 0.5) / n_no)])
    return lists


def fold_of(doc: int) -> int:
    return zlib.crc32(str(doc).encode()) % FOLDS


def word_votes(words: np.ndarray, lists: list[np.ndarray], fold: int) -> list[int]:
    """A word list votes on the documents that it was not learned from."""
    return [NONE if k == fold else YES if np.isin(words, own).any() else NO for k, own in enumerate(lists)]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> dict:
    """The model: (weights, bias) of both scorers, and the estimated rates of each labeller.

    The votes on form and the labels are counted over all documents. Word lists and scorers are fitted on about
    ``sample`` rows below a hash threshold: labelled rows, and others only if these are too few.
    """
    rows = docs.select(row_key(id_col).alias("id"), F.col(text_col).alias("text"))
    given = labels.filter("quality is not null or toxic is not null").groupBy(row_key("doc_id").alias("id")).agg(
        F.min(F.col("quality").cast("byte")).alias("quality"), F.max(F.col("toxic").cast("byte")).alias("toxic"))
    # one row per vote pattern, at most 3 ** 7
    votes = rows.mapInArrow(vote_on_form, "id long, votes array<byte>").join(given, "id", "left")
    gold = F.coalesce(1 - F.col("quality"), F.lit(NONE)).cast("byte")
    patterns = votes.groupBy(F.concat("votes", F.array(gold)).alias("p")).agg(
        F.count("*").alias("n"), F.count(F.coalesce("quality", "toxic")).alias("labelled")).collect()
    low, low_rate = expectation_maximisation(np.array([r.p for r in patterns], int).reshape(-1, len(FORM_VOTES) + 1),
                                             np.array([r.n for r in patterns], float), 0.15, len(FORM_VOTES))
    posterior = {tuple(r.p): float(x) for r, x in zip(patterns, low, strict=True)}
    n, labelled = sum(r.n for r in patterns), sum(r.labelled for r in patterns)
    of_labelled = sample / max(labelled, sample)
    of_others = max(sample - labelled, 0) / max(n - labelled, sample)
    place = F.pmod(F.xxhash64(F.lit(29), "id"), F.lit(1 << 30)) / (1 << 30)
    is_labelled = F.coalesce("quality", "toxic").isNotNull()
    chosen = rows.filter(place < max(of_labelled, of_others)).join(given, "id", "left").filter(
        place < F.when(is_labelled, of_labelled).otherwise(of_others))
    features = chosen.mapInArrow(featurise, "id long, votes array<byte>, form array<int>, words array<int>, "
                                            "quality byte, toxic byte")
    got = features.repartition(1).mapInArrow(fit_sample(posterior), "name string, feature long, weight double").collect()
    model = {"low_rate": low_rate, "toxic_rate": [r.weight for r in got if r.name == "rate"]}
    for name in ("low", "toxic"):
        weights = {r.feature: r.weight for r in got if r.name == name}
        model[name] = weights, weights.pop(BIAS, -1.0)
    return model


def fit_sample(posterior: dict):
    """Fits both scorers in one task, which holds the sample's features."""
    schema = pa.schema([("name", pa.string()), ("feature", pa.int64()), ("weight", pa.float64())])

    def run(batches):
        parts = list(batches)
        if not sum(p.num_rows for p in parts):
            return
        got = pa.Table.from_batches(parts).sort_by("id").to_pandas()
        labelled = got.quality.notna()
        gold = np.where(labelled, 1 - got.quality.fillna(0), NONE).astype(int)
        target = np.array([posterior.get((*map(int, v), int(g)), 0.5) for v, g in zip(got.votes, gold, strict=True)])
        marked = got[got.toxic.notna()]
        words, truth = list(marked.words), marked.toxic.to_numpy(int)
        fold = np.array([fold_of(i) for i in marked.id], int)
        lists = listed_words(words, truth, fold)
        votes = np.array([[*word_votes(w, lists, f), t] for w, f, t in zip(words, fold, truth, strict=True)],
                         int).reshape(-1, FOLDS + 1)
        kinds, which, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
        toxic, rate = expectation_maximisation(kinds, n.astype(float), 0.1)
        yield to_batch(schema, ["rate"] * rate.size, range(rate.size), rate.ravel())
        for name, rows, wanted in (("low", list(got.form), target), ("toxic", words, toxic[which.ravel()])):
            if rows:
                weights, bias = fit_linear(rows, wanted)
                yield to_batch(schema, [name] * (len(weights) + 1), [BIAS, *weights], [bias, *weights.values()])

    return run


def probability(model: tuple[dict, float], features: list[int]) -> float:
    weights, bias = model
    margin = bias + sum(map(weights.get, features, repeat(0.0)))
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, margin))))


def judge(model: dict, text: bytes) -> tuple[float, float]:
    """Probabilities of low quality and of toxicity. A text without words is of low quality."""
    if not text.split():
        return 1.0, 0.0
    return probability(model["low"], form_features(text, form(text))), probability(model["toxic"], word_features(text))


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, p_low, p_toxic, rejected) for every row, from the text alone."""
    schema = pa.schema([("id", pa.int64()), ("p_low", pa.float64()), ("p_toxic", pa.float64()),
                        ("rejected", pa.bool_())])

    def run(batches):
        for batch in batches:
            found = [judge(model, t) for t in texts_of(batch)]
            yield to_batch(schema, batch.column("id"), [a for a, _ in found], [b for _, b in found],
                           [max(x) > 0.5 for x in found])

    return docs.select(row_key(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id long, p_low double, p_toxic double, rejected boolean")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Quality of all ``documents``: doc_id, p_low, p_toxic, rejected.

    Null, empty and blank texts are rejected. Rows that repeat an id are judged one by one; labels that repeat an id
    count as their worst. Without labels the heuristics on form alone are weighed, and nothing is called toxic. Labels
    of unknown documents and further columns are ignored. An empty table gives an empty result.
    """
    return score(docs, fit(docs, labels)).select(id_text("id").alias("doc_id"), "p_low", "p_toxic", "rejected")


def stage_quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents of low quality and toxic ones go."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))

    def keep(texts):
        import pandas as pd

        return pd.Series([max(judge(model, b"" if t is None else t.encode())) <= 0.5 for t in texts], dtype=bool)

    return docs.filter(F.pandas_udf(keep, "boolean")("text"))
