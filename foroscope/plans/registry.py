"""Registry of runnable queries and their reference SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, days: tuple = ()):
    """Register a query; the columns named in ``days`` are delivered as ISO text on both sides."""
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            df = fn(spark, sf_dir)
            return df.withColumns({c: F.col(c).cast("string") for c in days}) if days else df

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql:
            text = ", ".join(f"cast({c} as varchar) as {c}" for c in days)
            ORACLES[name] = f"select * replace ({text}) from ({sql.strip()})" if days else sql.strip()
        return fn

    return register
