"""Logistic regression by Newton steps: one aggregation of the rows per step, a small system solved on the driver."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.session import written

# Tasks carry this module's functions with them, so a cluster needs no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class NewtonFit:
    """Weights in the order of the features, the intercept, the steps taken and the last change."""

    features: tuple[str, ...]
    weights: np.ndarray
    intercept: float
    steps: int
    change: float

    def frame(self, spark) -> DataFrame:
        """``feature``, ``coefficient``, ``odds_ratio``; the intercept is a row of its own."""
        rows = [*zip(self.features, self.weights.tolist()), ("(intercept)", self.intercept)]
        frame = spark.createDataFrame(rows, "feature string, coefficient double")
        clipped = F.greatest(F.lit(-20.0), F.least(F.lit(20.0), F.col("coefficient")))
        return frame.withColumn("odds_ratio", F.exp(clipped))


def step_sums(rows: DataFrame, weights: np.ndarray) -> dict[tuple[int, int], float]:
    """X'WX as entries (i, j) with i <= j and X'r as entries (i, -1), over rows ``x`` (with a leading one) and ``y``.

    A task sends one number per entry, so what is shuffled does not grow with the rows.
    """
    width = len(weights)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        curvature, slope = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -500, 500)))
            slope += x.T @ (batch.column(1).to_numpy(zero_copy_only=False) - p)
            curvature += (x * (p * (1 - p))[:, None]).T @ x
        i, j = np.triu_indices(width)
        rest = np.arange(width)
        arrays = [np.concatenate((i, rest)), np.concatenate((j, np.full(width, -1))), np.concatenate((curvature[i, j], slope))]
        kinds = [pa.int32(), pa.int32(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(arrays, kinds)], ["i", "j", "s"])

    parts = rows.select("x", "y").mapInArrow(summed, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    return {(r["i"], r["j"]): r["s"] for r in parts.collect()}


def fit_logistic(
    df: DataFrame, features: Sequence[str], label: str, C: float = 1.0, max_steps: int = 50, tolerance: float = 1e-9
) -> NewtonFit:
    """Minimise the sum of losses plus ``1 / (2 C)`` times the squared weights; the intercept is free.

    Rows with a missing feature or label are left out. No weight moves by more than five in a step.
    """
    one = F.array(F.lit(1.0), *[F.col(c).cast("double") for c in features])
    rows = df.select(one.alias("x"), F.col(label).cast("double").alias("y"))
    known = F.col("y").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v))
    rows = written(rows.where(known), "newton-rows")
    width = len(features) + 1
    penalty = np.full(width, 1.0 / C)
    penalty[0] = 0.0
    weights, change, steps = np.zeros(width), np.inf, 0
    while steps < max_steps and change > tolerance:
        sums = step_sums(rows, weights)
        if not sums:
            raise ValueError("no rows to fit")
        curvature = np.array([[sums[min(i, j), max(i, j)] for j in range(width)] for i in range(width)])
        slope = np.array([sums[i, -1] for i in range(width)]) - penalty * weights
        step = np.linalg.lstsq(curvature + np.diag(penalty), slope, rcond=None)[0]
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-300))
        weights, change, steps = weights + step, float(np.abs(step).max()), steps + 1
    return NewtonFit(tuple(features), weights[1:], float(weights[0]), steps, change)
