"""Chart data: the aggregation behind each chart, ready to draw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.bands import flag_label
from riskspark.functions.rounding import round4
from riskspark.operators.distribution import (
    quantiles_from_curve,
    small,
    unpivot,
    value_curve,
)
from riskspark.operators.profile import QUARTILES, categorical_summary, positive_rates

# Features of the rate bars, histogram bins, importance bars.
KEY_FEATURES = ("Contract", "InternetService", "PaymentMethod", "TechSupport", "OnlineSecurity")
HISTOGRAM_BINS = 30
TOP_IMPORTANCES = 15


def class_bars(df: DataFrame, target: str) -> DataFrame:
    """Bar height and percentage label per class, relative to all rows."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("_total")).withColumn("_one", F.lit(1))
    return (
        counts.filter(F.col(target).isNotNull())
        .withColumn("_one", F.lit(1))
        .join(F.broadcast(total), "_one")
        .select(
            F.col(target).alias("value"),
            "count",
            F.round(100.0 * F.col("count") / F.col("_total"), 1).alias("label_pct"),
        )
    )


def class_histograms(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    bins: int = HISTOGRAM_BINS,
) -> DataFrame:
    """Equal-width histogram per numeric column and class over the column's full range."""
    long = unpivot(df, columns, keep=[target]).filter(
        F.col("value").isNotNull() & F.col(target).isNotNull()
    )
    ranges = long.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    index = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.lit(bins - 1), F.floor((F.col("value") - F.col("lo")) / width).cast("int"))
    )
    return (
        long.join(small(ranges, len(columns)), "feature")
        .withColumn("bin", index)
        .groupBy("feature", target, "bin")
        .agg(
            F.count(F.lit(1)).alias("count"),
            round4(F.max(F.col("lo") + F.col("bin") * width)).alias("bin_start"),
        )
    )


def box_statistics(
    df: DataFrame,
    columns: Sequence[str],
    target: str,
    classes: Sequence[str] = ("Yes", "No"),
) -> DataFrame:
    """Quartiles, 1.5-IQR whiskers and outlier count per numeric column and class."""
    keys = ["feature", target]
    long = unpivot(df, columns, keep=[target]).filter(F.col(target).isin(*classes))
    curve = value_curve(long, keys, "value")
    q = quantiles_from_curve(curve, keys, "value", QUARTILES, out="q").select(
        *keys, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = (F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach)
    return (
        curve.join(small(q, len(columns) * len(classes)), keys)
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("low"),
            F.max(F.when(inside, F.col("value"))).alias("high"),
            F.sum(F.when(~inside, F.col("n")).otherwise(F.lit(0))).alias("outliers"),
        )
        .select(
            *keys,
            round4(F.col("q1")).alias("q1"),
            round4(F.col("median")).alias("median"),
            round4(F.col("q3")).alias("q3"),
            round4(F.col("low")).alias("whisker_low"),
            round4(F.col("high")).alias("whisker_high"),
            "outliers",
        )
    )


def rate_bars(
    df: DataFrame, target: str, columns: Sequence[str] = KEY_FEATURES, positive: str = "Yes"
) -> DataFrame:
    """Positive-rate bars per category of the key features."""
    return categorical_summary(df, columns, target, positive).select(
        "feature", "category", "churn_rate"
    )


def scatter_grid(
    df: DataFrame, x: str, y: str, target: str, x_step: float, y_step: float
) -> DataFrame:
    """Scatter as a grid of counts, so every row is in the picture at any size."""
    known = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull() & F.col(target).isNotNull())
    return known.groupBy(
        (F.floor(F.col(x) / F.lit(float(x_step))) * F.lit(float(x_step))).alias("x"),
        (F.floor(F.col(y) / F.lit(float(y_step))) * F.lit(float(y_step))).alias("y"),
        F.col(target).alias("value"),
    ).agg(F.count(F.lit(1)).alias("count"))


def sensitive_bars(
    df: DataFrame, target: str, gender: str = "gender", senior: str = "SeniorCitizen", positive: str = "Yes"
) -> DataFrame:
    """Positive-rate bars of the sensitive attributes, flags shown as words."""
    labelled = df.withColumn(senior, flag_label(F.col(senior), "Non-Senior", "Senior"))
    return positive_rates(labelled, [gender, senior], target, positive)
