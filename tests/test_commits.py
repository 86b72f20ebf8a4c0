"""Tables that grow by committed batches."""

import pytest

from foroscope.operators import enrich as en
from foroscope.sources import commits


def frame(spark, first, last, source="a"):
    return spark.createDataFrame([(i, source, f"text {i}!") for i in range(first, last)], "id long, source string, text string")


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_a_batch_counts_once(spark, tmp_path):
    root = str(tmp_path)
    schema = frame(spark, 0, 1).schema
    assert commits.read_committed(spark, root) is None and ids(commits.read_committed(spark, root, schema)) == []
    assert commits.write_batch(frame(spark, 0, 5), root, "one/with strange: name")
    assert not commits.write_batch(frame(spark, 0, 5), root, "one/with strange: name")
    assert commits.write_batch(frame(spark, 5, 9), root, "two")
    assert ids(commits.read_committed(spark, root)) == list(range(9))


def test_killed_between_write_and_commit(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    commits.write_batch(frame(spark, 0, 5), root, "one")

    def die(*_):
        raise KeyboardInterrupt("killed")

    with monkeypatch.context() as m:
        m.setattr(commits, "commit", die)
        with pytest.raises(KeyboardInterrupt):
            commits.write_batch(frame(spark, 5, 9), root, "two")
    assert ids(commits.read_committed(spark, root)) == list(range(5))  # written, but nobody reads it
    commits.write_batch(frame(spark, 5, 9), root, "two")
    assert ids(commits.read_committed(spark, root)) == list(range(9))


def test_two_runs_of_one_batch(spark, tmp_path):
    root = str(tmp_path)
    commits.write_batch(frame(spark, 0, 3), root, "x")
    frame(spark, 0, 3).write.parquet(f"{root}/data/late")
    commits.commit(spark, root, "x", "data/late")
    assert ids(commits.read_committed(spark, root)) == [0, 1, 2]


def test_extend_by_new_sources(spark, tmp_path):
    root = str(tmp_path)
    a, b = frame(spark, 0, 5), frame(spark, 5, 9, "b/c")
    assert ids(commits.extend_table(spark, root, a, "source")) == list(range(5))
    assert ids(commits.extend_table(spark, root, a.unionByName(b), "source")) == list(range(9))
    assert ids(commits.extend_table(spark, root, a.unionByName(b), "source")) == list(range(9))


def test_scoring_goes_on_after_a_kill(spark, tmp_path, monkeypatch):
    root, df = str(tmp_path), frame(spark, 0, 60)
    real, calls = commits.commit, []

    def die_at_third(*args):
        calls.append(1)
        if len(calls) == 3:
            raise KeyboardInterrupt("killed")
        real(*args)

    with monkeypatch.context() as m:
        m.setattr(commits, "commit", die_at_third)
        with pytest.raises(KeyboardInterrupt):
            en.score_with_resume(spark, df, "id", "text", en.rule_scorer, root)
    before = ids(commits.read_committed(spark, root))
    assert 0 < len(before) < 60
    more = df.unionByName(frame(spark, 60, 70))
    assert ids(en.score_with_resume(spark, more, "id", "text", en.rule_scorer, root)) == list(range(70))
