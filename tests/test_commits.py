"""Publication in one step: failures, races and merges."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from riskspark.models.scoring import load_version, model_versions, save_version, version_metadata
from riskspark.sources import commits, sinks
from riskspark.sources.commits import CommitLog
from riskspark.streaming import labels


@pytest.fixture()
def root(tmp_path):
    return str(tmp_path / "root")


def test_concurrent_commits_get_their_own_numbers(spark, root):
    log = CommitLog(spark, root)
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda i: CommitLog(spark, root).commit({f"k{i}": f"data/part={i}"}), range(60)))
    assert sorted(numbers) == list(range(1, 61)) == log.numbers()
    # Commit 50 holds the whole state.
    assert "state" in log.read(commits.STATE_EVERY) and len(log.state()) == 60
    log.commit({"k1": "data/part=new"}, drop=["k2", "absent"])
    state = log.state()
    assert state["k1"] == "data/part=new" and "k2" not in state and len(state) == 59
    assert not [n for n in os.listdir(f"{root}/_commits") if n.startswith(".")]


def test_a_file_is_made_once(spark, root):
    assert commits.create_once(spark, f"{root}/a.json", "one") and not commits.create_once(spark, f"{root}/a.json", "two")
    assert open(f"{root}/a.json").read() == "one" and os.listdir(root) == ["a.json"]


def test_scores_appear_at_once_and_are_replaced(spark, root):
    rows = spark.createDataFrame([(1, 0.1, "a"), (2, 0.2, "b")], "id int, p double, batch_id string")
    with pytest.raises(ValueError):
        sinks.read_scored(spark, root)
    sinks.write_scored(rows, root)
    before = sinks.read_scored(spark, root)
    sinks.write_scored(rows.where("batch_id = 'a'").withColumn("p", F.lit(0.9)), root)
    # A reader that began earlier goes on with what it saw.
    assert sorted(map(tuple, before.collect())) == [(1, 0.1, "a"), (2, 0.2, "b")]
    assert sorted(map(tuple, sinks.read_scored(spark, root).collect())) == [(1, 0.9, "a"), (2, 0.2, "b")]
    assert [r["p"] for r in sinks.read_scored(spark, root, "b").collect()] == [0.2]
    fails = F.raise_error(F.lit("broken")).cast("double")
    broken = rows.withColumn("p", F.when(F.col("id") == 2, fails).otherwise(0.5))
    with pytest.raises(Exception, match="broken"):
        sinks.write_scored(broken, root)
    assert sorted(r["p"] for r in sinks.read_scored(spark, root).collect()) == [0.2, 0.9]
    assert len(CommitLog(spark, root).unused()) >= 1
    sinks.write_scored(rows.limit(0), root)
    assert sinks.read_scored(spark, root).count() == 2


def test_a_quarantine_that_dies_halfway_shows_nothing(spark, root, monkeypatch):
    rows = spark.createDataFrame([(1, "x")], "id int, v string")
    kind = type(rows)
    whole, calls = kind.write.fget, []

    def dying(frame):
        calls.append(frame)
        if len(calls) == 3:
            raise RuntimeError("killed")
        return whole(frame)

    monkeypatch.setattr(kind, "write", property(dying))
    with pytest.raises(RuntimeError):
        sinks.quarantine_batch(rows, rows, rows, root, "b1")
    monkeypatch.undo()
    assert not os.path.exists(f"{root}/batch_id=b1")
    folder = sinks.quarantine_batch(rows, rows, rows, root, "b1")
    assert sorted(os.listdir(folder)) == ["errors", "report", "rows"]
    sinks.quarantine_batch(rows, rows, rows.union(rows), root, "b1")
    assert spark.read.parquet(f"{folder}/rows").count() == 2
    assert len(os.listdir(f"{root}/_replaced")) == 1


def test_versions_are_whole_and_distinct(spark, root):
    model = Pipeline(stages=[SQLTransformer(statement="SELECT *, 1 AS one FROM __THIS__")]).fit(spark.range(1))
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: save_version(spark, model, root, {"i": i}), range(4)))
    assert sorted(numbers) == [1, 2, 3, 4] == model_versions(spark, root)
    assert sorted(version_metadata(spark, root, n)["i"] for n in numbers) == [0, 1, 2, 3]

    class Dying:
        def write(self):
            return self

        def save(self, path):
            os.makedirs(path)
            raise RuntimeError("killed")

    with pytest.raises(RuntimeError):
        save_version(spark, Dying(), root)
    assert model_versions(spark, root) == [1, 2, 3, 4]
    assert load_version(spark, root, "latest").transform(spark.range(2)).columns == ["id", "one"]


def test_a_merge_loses_no_epoch_written_meanwhile(spark, root, monkeypatch):
    handle = labels.published_log(root, "k", ["at"])

    def epoch(number, *rows):
        handle(spark.createDataFrame(list(rows), "k string, at int"), number)

    assert labels.merge_published(spark, root, "k", ["at"]) is None
    epoch(0, ("a", 1), ("b", 1))
    epoch(1, ("a", 2))
    commit = CommitLog.commit

    def late(self, entries, drop=(), note=None):
        if drop:
            monkeypatch.undo()
            epoch(2, ("b", 5), ("c", 5))
        return commit(self, entries, drop, note)

    monkeypatch.setattr(CommitLog, "commit", late)
    labels.merge_published(spark, root, "k", ["at"])
    assert len(CommitLog(spark, root).state()) == 2
    want = [("a", 2), ("b", 5), ("c", 5)]
    assert sorted(map(tuple, labels.published_rows(spark, root, "k", ["at"]).collect())) == want
    epoch(1, ("a", 2))
    labels.merge_published(spark, root, "k", ["at"])
    assert len(CommitLog(spark, root).state()) == 1
    assert sorted(map(tuple, labels.published_rows(spark, root, "k", ["at"]).collect())) == want
