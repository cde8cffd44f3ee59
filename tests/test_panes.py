"""Panes of streams and windows merged from them."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskspark.operators import monitoring as batch
from riskspark.streaming import panes, runs

START = datetime(2024, 1, 1)
SCHEMA = "id int, at timestamp, kind string, took double"


def event(i, minute, kind="a", took=0.02):
    return (i, START + timedelta(minutes=minute), kind, took)


@pytest.fixture()
def streamed(spark, tmp_path):
    """Runs a pane stream over arrivals, one micro-batch each, and returns the written panes."""

    def run(arrivals, make):
        for rows in arrivals:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = make(runs.file_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema, files_per_trigger=1))
        runs.run_to_files(stream, str(tmp_path / "out"), str(tmp_path / "state"))
        return spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))

    return run


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_late_rows_are_left_out_and_windows_equal_the_batch_form(spark, streamed):
    steady = [event(i, i / 4, "ab"[i % 2], (i % 40) / 100) for i in range(1200)]
    first = [r for r in steady if r[1] < START + timedelta(minutes=100)]
    second = [r for r in steady if START + timedelta(minutes=100) <= r[1] < START + timedelta(minutes=200)]
    third = [r for r in steady if r[1] >= START + timedelta(minutes=200)]
    # Closed by the first arrival, open until the second one's watermark, and without a time.
    lost, kept, timeless = event(9001, 50), event(9002, 120), (9003, None, "a", 0.1)
    written = streamed(
        [first, second, [*third, lost, kept, timeless]],
        lambda s: panes.latency_panes(s, "at", "took", ["kind"], "10 minutes"),
    ).cache()
    mark = max(r[1] for r in steady) - timedelta(minutes=10)
    on_time = [r for r in [*steady, kept] if r[1].replace(second=0) + timedelta(minutes=1) <= mark]
    assert written.agg(F.sum("requests")).first()[0] == len(on_time)
    assert written.select("pane_start", "kind").distinct().count() == written.count()
    events = spark.createDataFrame(on_time, SCHEMA)
    newest = max(r[1] for r in on_time).replace(second=0) + timedelta(minutes=1)
    for minutes in (1, 5, 60):
        merged = panes.merge_panes(written, ["kind"], f"{minutes} minutes")
        whole = batch.latency_quantiles(events, "at", "took", ["kind"], width=f"{minutes} minutes")
        whole = whole.where(F.col("window_start") <= F.lit(newest - timedelta(minutes=minutes)))
        assert rows_of(panes.pane_quantiles(merged, ["kind"])) == rows_of(whole)
    five = panes.merge_panes(written, ["kind"], "5 minutes")
    assert rows_of(panes.merge_panes(five, ["kind"], "60 minutes")) == rows_of(panes.merge_panes(written, ["kind"], "60 minutes"))
    sliding = panes.merge_panes(written, ["kind"], "10 minutes", "5 minutes")
    assert sliding.agg(F.sum("requests")).first()[0] > merged.agg(F.sum("requests")).first()[0]


def test_null_labels_and_empty_streams(spark, streamed):
    rows = [event(i, i, None) for i in range(30)]
    written = streamed([rows], lambda s: panes.failure_panes(s, "at", "kind", F.col("took") > 1, "1 minute"))
    got = panes.merge_panes(written, ["kind"], "10 minutes").collect()
    assert [(r["kind"], r["failures"], r["events"]) for r in got] == [(None, 0, 10)] * 2
    assert panes.merge_panes(written.limit(0), ["kind"], "10 minutes").count() == 0


def test_one_hot_label_is_one_row_of_state(spark, streamed):
    rows = [event(i, 0.001 * i, "hot") for i in range(5000)] + [event(9999, 60, "end")]
    written = streamed([rows], lambda s: panes.volume_panes(s, "at", ["kind"], "1 minute"))
    assert written.count() == 5 and written.agg(F.sum("predictions")).first()[0] == 5000


def test_arrivals_of_many_files_are_one_micro_batch_each(spark, tmp_path):
    """An arrival is written by all its tasks; late rows are judged by the watermark of the arrivals before the last one."""
    first = [(0, 0), (1, 5), (2, 65), (3, 200)]
    # The first arrival closes minute 0 for the third, the second one would close minute 1 and 2 too.
    arrivals = [first, [(4, 400), (5, 410)], [(6, 10), (7, 130), (8, 900)]]
    frames = [
        spark.createDataFrame(rows, "id int, s int").repartition(3).select("id", F.timestamp_seconds("s").alias("ts"))
        for rows in arrivals
    ]

    def run(stream, more):
        made = panes.pane_stream(stream, "ts", [], {"n": F.count(F.lit(1))}, "1 minute")
        runs.run_to_files(made, str(tmp_path / "out"), str(tmp_path / "state"), more=more)

    runs.arrive_in_turn(frames, str(tmp_path / "in"), run)
    assert len(list((tmp_path / "in").glob("part-*"))) > 3
    rows = spark.read.parquet(str(tmp_path / "out")).select(F.unix_seconds("pane_start"), "n").collect()
    assert sorted(map(tuple, rows)) == [(0, 2), (60, 1), (120, 1), (180, 1), (360, 2)]
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


def test_panes_and_gate_write_with_all_tasks(spark, sf_dir, monkeypatch):
    """Neither query sends its input through one task."""
    import catalog.streams as streams
    from pyspark.sql import DataFrame

    def refused(self, *args):
        raise AssertionError("rows are brought together in one task")

    monkeypatch.setattr(DataFrame, "coalesce", refused)
    assert streams.gate_stream(spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    assert streams.batch_counters(spark, sf_dir).count() > 0
