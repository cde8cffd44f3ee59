"""Counters in short panes of event time, and longer windows merged from the stored panes.

A stream keeps one row of counters per open pane and label, writes each pane once when the watermark has passed it, and
forgets it. Windows of any length that panes divide come from the written panes by adding counters, so dashboards over
1, 5 and 60 minutes share one state and a longer look-back costs no state at all.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.operators import monitoring as batch
from riskspark.operators.distribution import small
from riskspark.streaming.runs import event_timed

#: Bounds of a pane or window.
BOUNDS = ("pane_start", "pane_end")


def pane_stream(
    events: DataFrame, time: str, by: Sequence[str], counters: Mapping[str, Column], delay: str, width: str = "1 minute"
) -> DataFrame:
    """Counters of every pane and label: ``pane_start``, ``pane_end``, labels, counters.

    ``counters`` are aggregates whose values of two panes can be added. In append mode a pane comes out once, when the
    watermark, the latest time less ``delay``, has passed its end; rows that arrive for it after that are left out. Rows
    without a time are in no pane; null labels count as a label.
    """
    timed = event_timed(events, time).withWatermark(time, delay)
    counted = timed.groupBy(F.window(time, width).alias("_w"), *by).agg(*[c.alias(n) for n, c in counters.items()])
    return counted.select(
        F.col("_w.start").alias("pane_start"), F.col("_w.end").alias("pane_end"), *by, *counters
    )


def merge_panes(panes: DataFrame, by: Sequence[str], width: str, slide: str | None = None) -> DataFrame:
    """Windows of ``width``, a multiple of the panes' width, with all other columns added up.

    With ``slide``, also a multiple, windows overlap. Windows that end after the newest pane are not complete yet and left out.
    The result has the columns of panes, so it can be stored in their place and merged again.
    """
    counters = [c for c in panes.columns if c not in (*BOUNDS, *by)]
    newest = panes.agg(F.max("pane_end").alias("_newest"))
    merged = panes.groupBy(F.window("pane_start", width, slide).alias("_w"), *by).agg(
        *[F.sum(c).alias(c) for c in counters]
    )
    whole = merged.join(small(newest, 1), F.col("_w.end") <= F.col("_newest"))
    return whole.select(F.col("_w.start").alias("pane_start"), F.col("_w.end").alias("pane_end"), *by, *counters)


def latency_panes(
    events: DataFrame,
    time: str,
    latency: str,
    by: Sequence[str],
    delay: str,
    buckets: Sequence[float] = batch.LATENCY_BUCKETS,
    width: str = "1 minute",
) -> DataFrame:
    """Panes with the counters of latency quantiles."""
    return pane_stream(events, time, by, batch.latency_counters(F.col(latency), buckets), delay, width)


def pane_quantiles(
    panes: DataFrame,
    by: Sequence[str],
    quantiles: Sequence[float] = (0.95, 0.99),
    buckets: Sequence[float] = batch.LATENCY_BUCKETS,
) -> DataFrame:
    """Latency quantiles of panes or merged windows."""
    return panes.select(
        F.col("pane_start").alias("window_start"), *by, "requests", *batch.bucket_quantiles(quantiles, buckets)
    )


def volume_panes(scored: DataFrame, time: str, by: Sequence[str], delay: str, width: str = "1 minute") -> DataFrame:
    """Panes with the number of predictions served per class and model version."""
    return pane_stream(scored, time, by, {"predictions": F.count(F.lit(1))}, delay, width)


def report_panes(reports: DataFrame, time: str, delay: str, width: str = "1 minute") -> DataFrame:
    """Panes with the totals over quality reports."""
    return pane_stream(reports, time, [], batch.report_counters(), delay, width)


def failure_panes(
    events: DataFrame, time: str, reason: str, failed: Column, delay: str, width: str = "1 minute"
) -> DataFrame:
    """Panes with failures and events per reason."""
    return pane_stream(events, time, [reason], batch.failure_counters(failed), delay, width)
