from check import compare, connect
from conftest import SF
from pyspark.sql import functions as F

from foroscope.llm import mixing
from foroscope.llm.mixing import mix, source_mix, stage_mix, targets


def fill(sizes, weights):
    """Targets by sharing again what is above a limit."""
    total, out, open_ = 1.5 * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        level = (total - sum(out[i] for i in range(len(sizes)) if i not in open_)) / sum(weights[i] for i in open_)
        over = {i for i in open_ if weights[i] * level > 2 * sizes[i]}
        for i in over or open_:
            out[i] = 2.0 * sizes[i] if over else weights[i] * level
        open_ -= over or open_
    return out


def test_sql(spark):
    ok, message, _ = compare(spark, connect(SF), "op2", lambda s, d: source_mix(s.read.parquet(f"{d}/documents.parquet")),
                             mixing.ORACLE, SF)
    assert ok, message


def test_targets(spark):
    for sizes in ([10, 10, 10], [1, 100, 1000], [0, 5, 7, 900], [3], [0, 0], [50, 1, 1, 80, 2, 9, 4]):
        names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
        got = targets(spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, source_size long"))
        by = {r.source: r.target for r in got.collect()}
        want = fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
        assert all(abs(by[n] - w) < 1e-6 for n, w in zip(names, want, strict=True)), (sizes, by, want)


def test_odd_rows_and_bounds(spark, frame):
    rows = [(i, "a b c " * (i % 5), None, ("x", "y", None)[i % 3]) for i in range(300)]
    rows += [(1, None, None, "x"), (None, "w w", None, "zero"), (None, "w", None, "y"), (400, "", None, "empty"), (5, "a b", None, "x")]
    got = mix(frame(rows))
    assert got.count() == len(rows)
    assert got.filter("taken > 2 * size or (source = 'empty' and taken > 0)").count() == 0
    by = got.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("w"), F.max("size").alias("m")).collect()
    assert all(abs(r.t - r.w) <= r.m for r in by if r.source != "zero")
    assert source_mix(frame([])).count() == 0
    assert sorted(map(str, mix(frame(rows).repartition(7)).collect())) == sorted(map(str, got.collect()))


def test_a_larger_budget_keeps_what_a_smaller_one_takes(spark):
    sizes = mixing.measure(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", "text", "source", 42)
    plan = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    edges = [{r.source: r.edge for r in mixing.thresholds(sizes, plan.withColumn(
        "target", F.col("source_size") * share)).collect()} for share in (0.2, 0.5, 0.9)]
    assert all(edges[0][s] <= edges[1][s] <= edges[2][s] for s in edges[0])


def test_stage(spark, frame):
    rows = [(i, "a b c d", None, "s%d" % (i % 2)) for i in range(100)]
    out = stage_mix(spark, frame(rows, clash=False), "")
    assert out.columns == [*frame(rows, clash=False).columns, "copies"]
    assert out.filter("copies not in (1, 2)").count() == 0
    assert abs(out.agg(F.sum("copies")).first()[0] - 150) <= 2
