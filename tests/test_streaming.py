"""Hourly counts as a stream: equal to the batch result, also after a restart and a repeated batch."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from foroscope.streaming import activity as st

START = datetime(2024, 1, 1)


def rows(first, last):
    return [(i, START + timedelta(minutes=7 * i), "ab"[i % 2]) for i in range(first, last)]


def write(spark, data, path):
    spark.createDataFrame(data, "id long, ts timestamp, forum string").repartition(3).write.mode("append").parquet(path)


def result(df):
    return sorted((r.hour, r.forum, r.posts) for r in df.collect())


def run(spark, tmp):
    posts = spark.readStream.schema("id long, ts timestamp, forum string").option("maxFilesPerTrigger", 2).parquet(f"{tmp}/in")
    st.start_hourly(posts, "ts", ["forum"], f"{tmp}/out", f"{tmp}/checkpoint", late="3 days").awaitTermination()


def test_stream_equals_batch_and_goes_on_after_a_restart(spark, tmp_path):
    tmp = str(tmp_path)
    write(spark, rows(0, 200), f"{tmp}/in")
    run(spark, tmp)
    write(spark, rows(200, 500), f"{tmp}/in")  # hours that were open go on counting
    run(spark, tmp)
    run(spark, tmp)  # nothing new
    want = result(st.hourly_counts(spark.read.parquet(f"{tmp}/in"), "ts", ["forum"]))
    assert result(st.read_hourly(spark, f"{tmp}/out", ["forum"])) == want and len(want) > 100


def test_a_batch_that_dies_after_writing_counts_once(spark, tmp_path, monkeypatch):
    tmp = str(tmp_path)
    write(spark, rows(0, 100), f"{tmp}/in")
    real, state = st.hourly_counts, {"left": 1}

    class Dies(Exception):
        pass

    posts = spark.readStream.schema("id long, ts timestamp, forum string").parquet(f"{tmp}/in")

    def write_and_die(batch, number):
        batch.write.mode("overwrite").parquet(f"{tmp}/out/batch={number}")
        state["left"] -= 1
        raise Dies("after the write, before the commit of the batch")

    dying = real(posts, "ts", ["forum"], "3 days").writeStream.outputMode("update").foreachBatch(write_and_die).option(
        "checkpointLocation", f"{tmp}/checkpoint").trigger(availableNow=True).start()
    with pytest.raises(Exception, match="after the write"):
        dying.awaitTermination()
    run(spark, tmp)
    got = st.read_hourly(spark, f"{tmp}/out", ["forum"])
    assert got.agg(F.sum("posts")).first()[0] == 100 and state["left"] == 0


def test_late_rows_are_left_out(spark, tmp_path):
    tmp = str(tmp_path)
    write(spark, rows(0, 2000), f"{tmp}/in")
    run(spark, tmp)
    write(spark, [(9999, START, "a")], f"{tmp}/in")
    run(spark, tmp)
    assert st.read_hourly(spark, f"{tmp}/out", ["forum"]).agg(F.sum("posts")).first()[0] == 2000
