"""Rounding rules of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round4(value: Column) -> Column:
    """Evaluation, drift and decision figures: four decimals."""
    return F.round(value.cast("double"), 4)


def round2(value: Column) -> Column:
    """Profile figures and money: two decimals."""
    return F.round(value.cast("double"), 2)


def share(part: Column, whole: Column, empty: float | None = 0.0) -> Column:
    """``part / whole`` as double, ``empty`` when the denominator is zero."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double")).otherwise(
        F.lit(empty).cast("double")
    )


def half_even_count(total: Column, fraction: float) -> Column:
    """Number of rows a capacity fraction stands for: half-even, at least one."""
    return F.greatest(
        F.lit(1).cast("bigint"),
        F.bround(total.cast("double") * F.lit(float(fraction)), 0).cast("bigint"),
    )
