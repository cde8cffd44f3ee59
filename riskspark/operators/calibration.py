"""Calibration curves with uniform or quantile bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.rounding import round4
from riskspark.operators.distribution import running_totals
from riskspark.operators.scores import ScoreTable


def uniform_edges(n_bins: int) -> list[float]:
    """Interior edges of ``n_bins`` equal bins of [0, 1]."""
    if n_bins < 1:
        raise ValueError("n_bins must be at least 1")
    return [i * (1.0 / n_bins) for i in range(1, n_bins)]


def _points(frame: DataFrame, table: ScoreTable, bin_index: Column) -> DataFrame:
    """Mean outcome and mean score per bin; bins are open on the left, empty ones absent."""
    out = (
        frame.withColumn("bin", bin_index)
        .groupBy(*table.keys, "bin")
        .agg(
            round4(F.sum("pos") / F.sum("n")).alias("prob_true"),
            round4(F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("prob_pred"),
            F.sum("n").alias("bin_count"),
        )
    )
    return table.strip(out)


def calibration_uniform(table: ScoreTable, n_bins: int = 10) -> DataFrame:
    """Reliability points over equal-width bins, straight from the rows."""
    index = F.lit(0)
    for edge in uniform_edges(n_bins):
        index = index + (F.col("score") > F.lit(edge)).cast("int")
    return _points(table.frame, table, index)


def calibration_quantile(table: ScoreTable, n_bins: int = 10) -> DataFrame:
    """Reliability points over bins holding equal numbers of scores.

    A score lies above the quantile edge at position ``h`` exactly when more than
    ``floor(h)`` rows score lower, so the bin follows from the running count and
    the edges themselves are never needed.
    """
    rising = running_totals(
        table.histogram().frame, table.keys, "score", ["n"], bounded=table.bounded
    )
    lower = F.col("cum_n") - F.col("n")
    index = F.lit(0)
    for i in range(1, n_bins):
        edge = F.floor((F.col("all_n") - 1).cast("double") * F.lit(i / n_bins))
        index = index + (lower > edge).cast("int")
    return _points(rising, table, index)
