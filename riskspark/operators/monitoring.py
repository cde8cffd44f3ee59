"""Operational metrics and alerts over event and batch tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.rounding import round4, share

# Latency buckets in seconds.
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)


@dataclass(frozen=True)
class AlertPolicy:
    """Limits above which an alert fires."""

    error_rate: float = 0.05
    rejection_rate: float = 0.05
    drift_status: str = "significant_drift"


def request_rates(
    events: DataFrame, time: str, by: Sequence[str], width: str = "1 minute", seconds: int = 60
) -> DataFrame:
    """Requests and requests per second in tumbling windows, by the given labels."""
    return (
        events.groupBy(F.window(time, width).alias("_w"), *by)
        .agg(F.count(F.lit(1)).alias("requests"))
        .select(
            F.col("_w.start").alias("window_start"),
            *by,
            "requests",
            round4(F.col("requests") / F.lit(float(seconds))).alias("rate_per_second"),
        )
    )


def latency_quantiles(
    events: DataFrame,
    time: str,
    latency: str,
    by: Sequence[str],
    quantiles: Sequence[float] = (0.95, 0.99),
    buckets: Sequence[float] = LATENCY_BUCKETS,
    width: str = "5 minutes",
) -> DataFrame:
    """Latency quantiles per window from fixed buckets, linear inside the bucket.

    One aggregation with one counter per bucket. A rank beyond the last finite
    bucket reports the last bound.
    """
    counts = events.groupBy(F.window(time, width).alias("_w"), *by).agg(
        *[c.alias(n) for n, c in latency_counters(F.col(latency), buckets).items()]
    )
    return counts.select(
        F.col("_w.start").alias("window_start"), *by, "requests", *bucket_quantiles(quantiles, buckets)
    )


def latency_counters(latency: Column, buckets: Sequence[float] = LATENCY_BUCKETS) -> dict[str, Column]:
    """Counters that quantiles need: ``requests``, and per bucket those of its bound at most."""
    within = {f"within_{i}": F.count(F.when(latency <= float(e), 1)) for i, e in enumerate(buckets)}
    return {"requests": F.count(F.lit(1)), **within}


def bucket_quantiles(
    quantiles: Sequence[float] = (0.95, 0.99), buckets: Sequence[float] = LATENCY_BUCKETS
) -> list[Column]:
    """Quantile columns ``p95`` … over the counters of :func:`latency_counters`, whose sums over windows serve as well."""
    edges = [float(b) for b in buckets]

    def quantile(q: float) -> Column:
        rank = F.col("requests") * F.lit(float(q))
        out = None
        for i, upper in enumerate(edges):
            below = F.col(f"within_{i - 1}") if i else F.lit(0)
            lower = edges[i - 1] if i else 0.0
            here = F.col(f"within_{i}") - below
            inside = F.lit(lower) + F.lit(upper - lower) * share(rank - below, here)
            hit = F.col(f"within_{i}") >= rank
            out = F.when(hit, inside) if out is None else out.when(hit, inside)
        return out.otherwise(F.lit(edges[-1]))

    return [round4(quantile(q)).alias(f"p{round(q * 100)}") for q in quantiles]


def prediction_volume(scored: DataFrame, by: Sequence[str] = ("predicted_class", "model_version")) -> DataFrame:
    """Predictions served per class and model version."""
    return scored.groupBy(*by).agg(F.count(F.lit(1)).alias("predictions"))


def batch_counters(reports: DataFrame) -> DataFrame:
    """Totals over quality reports: jobs by status, records by status, validation failures."""
    return reports.agg(*[c.alias(n) for n, c in report_counters().items()])


def report_counters() -> dict[str, Column]:
    """The counters of :func:`batch_counters`, for any grouping of report rows."""
    ok = F.col("is_valid")
    return {
        "batches_success": F.count(F.when(ok, 1)),
        "batches_rejected": F.count(F.when(~ok, 1)),
        "records_accepted": F.coalesce(F.sum("accepted_records"), F.lit(0)),
        "records_rejected": F.coalesce(F.sum("rejected_records"), F.lit(0)),
        "validation_failures": F.coalesce(F.sum("schema_violations"), F.lit(0)),
    }


def failure_counts(events: DataFrame, reason: str, failed: Column) -> DataFrame:
    """Failures per reason, reasons without failures included."""
    return events.groupBy(reason).agg(*[c.alias(n) for n, c in failure_counters(failed).items()])


def failure_counters(failed: Column) -> dict[str, Column]:
    """The counters of :func:`failure_counts`, for any grouping of events."""
    return {"failures": F.count(F.when(failed, 1)), "events": F.count(F.lit(1))}


def error_rates(events: DataFrame, time: str, failed: Column, width: str = "5 minutes") -> DataFrame:
    """Failures, requests and error rate per window."""
    return (
        events.groupBy(F.window(time, width).alias("_w"))
        .agg(F.count(F.when(failed, 1)).alias("failures"), F.count(F.lit(1)).alias("requests"))
        .select(
            F.col("_w.start").alias("window_start"),
            "failures",
            "requests",
            round4(share(F.col("failures"), F.col("requests"))).alias("error_rate"),
        )
    )


def error_rate_alerts(rates: DataFrame, policy: AlertPolicy = AlertPolicy()) -> DataFrame:
    """Windows whose error rate is above the limit."""
    return rates.filter(
        share(F.col("failures"), F.col("requests")) > policy.error_rate
    ).select(
        F.lit("High_Prediction_Error_Rate").alias("alert"),
        F.lit("P1").alias("severity"),
        F.col("window_start").cast("string").alias("subject"),
        F.col("error_rate").alias("measured"),
    )


def rejection_alerts(
    reports: DataFrame, subject: Column | None = None, policy: AlertPolicy = AlertPolicy()
) -> DataFrame:
    """Batches whose rejection rate is above the limit."""
    return reports.filter(F.col("rejection_rate") > policy.rejection_rate).select(
        F.lit("High_Validation_Failure_Rate").alias("alert"),
        F.lit("P2").alias("severity"),
        (subject if subject is not None else F.lit("batch")).alias("subject"),
        F.col("rejection_rate").alias("measured"),
    )


def drift_alerts(features: DataFrame, policy: AlertPolicy = AlertPolicy()) -> DataFrame:
    """Features whose drift status is the alerting one."""
    return features.filter(F.col("drift_status") == policy.drift_status).select(
        F.lit("Significant_Data_Drift").alias("alert"),
        F.lit("P2").alias("severity"),
        F.col("feature").alias("subject"),
        F.col("psi").alias("measured"),
    )


def load_failure_alerts(failures: DataFrame, reason: str, load_reason: str) -> DataFrame:
    """Fires as soon as one model load has failed."""
    return failures.filter((F.col(reason) == load_reason) & (F.col("failures") > 0)).select(
        F.lit("Model_Load_Failure").alias("alert"),
        F.lit("P1").alias("severity"),
        F.col(reason).alias("subject"),
        F.col("failures").cast("double").alias("measured"),
    )


def sessions(events: DataFrame, user: str, time: str, gap: str = "30 minutes") -> DataFrame:
    """Activity sessions per user: runs of events closer together than ``gap``."""
    return (
        events.groupBy(F.session_window(time, gap).alias("_w"), user)
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            user,
            F.col("_w.start").alias("session_start"),
            F.col("_w.end").alias("session_end"),
            "events",
        )
    )
