"""Continuous operational metrics: the batch aggregations behind a watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.operators import monitoring as batch
from riskspark.streaming.runs import event_timed


def request_rate_stream(
    events: DataFrame, time: str, by: Sequence[str], delay: str, width: str = "1 minute", seconds: int = 60
) -> DataFrame:
    """Tumbling request rates; a window is emitted once the watermark has passed it."""
    return batch.request_rates(event_timed(events, time).withWatermark(time, delay), time, by, width, seconds)


def latency_stream(
    events: DataFrame,
    time: str,
    latency: str,
    by: Sequence[str],
    delay: str,
    buckets: Sequence[float] = batch.LATENCY_BUCKETS,
    width: str = "5 minutes",
) -> DataFrame:
    """Windowed latency quantiles from fixed buckets: state is one counter per bucket."""
    return batch.latency_quantiles(
        event_timed(events, time).withWatermark(time, delay), time, latency, by, buckets=buckets, width=width
    )


def error_rate_stream(
    events: DataFrame,
    time: str,
    failed: Column,
    delay: str,
    width: str = "5 minutes",
    slide: str = "1 minute",
) -> DataFrame:
    """Sliding error rate."""
    return (
        event_timed(events, time).withWatermark(time, delay)
        .groupBy(F.window(time, width, slide).alias("_w"))
        .agg(F.count(F.when(failed, 1)).alias("failures"), F.count(F.lit(1)).alias("requests"))
        .select(
            F.col("_w.start").alias("window_start"),
            "failures",
            "requests",
            F.round(F.col("failures") / F.col("requests"), 4).alias("error_rate"),
        )
    )


def session_stream(events: DataFrame, user: str, time: str, delay: str, gap: str = "30 minutes") -> DataFrame:
    """Sessions per user, closed by the watermark."""
    return batch.sessions(event_timed(events, time).withWatermark(time, delay), user, time, gap)
