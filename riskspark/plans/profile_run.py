"""The whole profile of a typed snapshot, and its long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.operators import charts, profile


def run_profile(
    df: DataFrame,
    key: str = "customerID",
    target: str = "Churn",
    numeric: Sequence[str] = profile.NUMERIC_COLUMNS,
    categorical: Sequence[str] = (),
    sensitive: Sequence[str] = ("gender", "SeniorCitizen"),
) -> dict[str, DataFrame]:
    """Every profile and chart frame by name; each is lazy and separately writable."""
    return {
        "overview": profile.overview(df, key),
        "columns": profile.column_overview(df),
        "target": profile.target_distribution(df, target),
        "balance": profile.target_balance(df, target),
        "numeric": profile.numeric_summary(df, numeric),
        "categorical": profile.categorical_summary(df, categorical, target),
        "correlations": profile.correlations(df, numeric),
        "discrepancy": profile.charge_discrepancies(df),
        "uniqueness": profile.id_uniqueness(df, key),
        "sensitive_rates": profile.positive_rates(df, sensitive, target),
        "class_bars": charts.class_bars(df, target),
        "histograms": charts.class_histograms(df, numeric, target),
        "boxes": charts.box_statistics(df, numeric, target),
        "rate_bars": charts.rate_bars(df, target),
        "scatter": charts.scatter_grid(df, "tenure", "MonthlyCharges", target, 6.0, 10.0),
        "sensitive_bars": charts.sensitive_bars(df, target),
    }


def long_form(frame: DataFrame, section: str, item: Column, measures: Sequence[str]) -> DataFrame:
    """A report frame as (section, item, measure, value) rows, for one summary table."""
    cells = F.array(
        *[
            F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
            for m in measures
        ]
    )
    return frame.select(F.lit(section).alias("section"), item.alias("item"), F.explode(cells).alias("_c")).select(
        "section", "item", "_c.measure", "_c.value"
    )


def profile_table(frames: dict[str, DataFrame]) -> DataFrame:
    """The key figures of a profile run in one long table."""
    whole = F.lit("table")
    parts = [
        long_form(frames["overview"], "overview", whole, ["total_rows", "duplicate_rows", "duplicate_customer_ids"]),
        long_form(frames["balance"], "balance", whole, ["positives", "negatives", "churn_rate"]),
        long_form(
            frames["numeric"],
            "numeric",
            F.col("feature"),
            ["count", "mean", "std", "min", "p25", "p50", "p75", "max", "iqr", "outliers_iqr"],
        ),
        long_form(
            frames["categorical"],
            "categorical",
            F.concat_ws("=", "feature", "category"),
            ["count", "churn_count", "churn_rate"],
        ),
        long_form(
            frames["discrepancy"], "discrepancy", whole, ["mean_abs_diff", "median_abs_diff", "max_abs_diff"]
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
