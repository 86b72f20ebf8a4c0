"""Row scoring with a caller's function, resumable batch by batch."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foroscope.operators.sample import hash_order
from foroscope.session import ship_by_value
from foroscope.sources.combine import pending
from foroscope.sources.commits import adopt, committed, read_committed, write_batch

ship_by_value(__name__)


def score_rows(df: DataFrame, key: str, text: str, scorer: Callable[[pd.Series], pd.Series]) -> DataFrame:
    """Raw label per row from a function of a text batch; Arrow batches, no row-at-a-time calls."""
    key_type = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "label": scorer(pdf[text])})

    return df.select(key, text).mapInPandas(run, f"{key} {key_type}, label string")


def score_with_resume(spark: SparkSession, df: DataFrame, key: str, text: str, scorer, path: str,
                      batches: int = 4) -> DataFrame:
    """Score what the result table does not hold yet, in hash-split batches that are committed one by one.

    A plain Parquet table of earlier results at ``path`` is taken over. A lost run continues after its last committed
    batch; a batch that was written but not committed is done again, so no key is lost or doubled. New rows of a later
    run make a batch of their own.
    """
    part = F.pmod(F.xxhash64(F.lit("batch"), hash_order(key)), F.lit(batches))
    adopt(spark, path)
    run = len(committed(spark, path))
    for i in range(batches):
        done = read_committed(spark, path)
        todo = df.filter(part == i)
        if done is not None:
            todo = pending(todo, done, key)
        if not todo.isEmpty():
            write_batch(score_rows(todo, key, text, scorer), path, f"{run}-{i}")
    schema = score_rows(df, key, text, scorer).schema
    return read_committed(spark, path, schema)


def rule_scorer(texts: pd.Series) -> pd.Series:
    """Rule-based scorer used by the tests and as an example of the interface."""
    low = texts.fillna("").str.lower()
    out = pd.Series("statement.", index=texts.index)
    out[low.str.contains(r"\?", regex=True)] = "Question, asks"
    out[low.str.contains("!", regex=False)] = "exclamation!"
    return out
