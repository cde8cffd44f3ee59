"""Profiling: overview, target, numeric and categorical summaries, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.bands import charge_discrepancy
from riskspark.functions.rounding import round2, round4, share
from riskspark.operators.contract import duplicate_counts
from riskspark.operators.distribution import (
    exact_quantiles,
    finite,
    quantiles_from_curve,
    running_totals,
    small,
    unpivot,
)
from riskspark.operators.quality import missing_values
from riskspark.session import written

# Default profile columns.
NUMERIC_COLUMNS = ("tenure", "MonthlyCharges", "TotalCharges")
QUARTILES = (0.25, 0.5, 0.75)


def overview(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, columns, extra whole-row copies, extra copies of keys."""
    return duplicate_counts(df, key).select(
        "total_rows",
        F.lit(len(df.columns)).alias("total_cols"),
        "duplicate_rows",
        F.col("extra_keys").alias("duplicate_customer_ids"),
    )


def column_overview(df: DataFrame) -> DataFrame:
    """Per column: type, null count, null percentage (null where nothing is missing)."""
    types = F.create_map(*[F.lit(v) for pair in df.dtypes for v in pair])
    present = missing_values(df, only_present=False)
    total = F.col("null_count") > 0
    return present.select(
        "column",
        F.element_at(types, F.col("column")).alias("dtype"),
        F.col("null_count").alias("missing_count"),
        F.when(total, F.col("null_percentage") * 100).alias("missing_percentage"),
    )


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count and percentage of each non-null target value."""
    if target not in df.columns:
        raise ValueError(f"target column '{target}' not found")
    counts = df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("_total")).withColumn("_one", F.lit(1))
    return (
        counts.withColumn("_one", F.lit(1))
        .join(small(total, 1), "_one")
        .select(
            F.col(target).alias("value"),
            "count",
            round2(100.0 * F.col("count") / F.col("_total")).alias("percentage"),
        )
    )


def target_balance(df: DataFrame, target: str, positive: str = "Yes", negative: str = "No") -> DataFrame:
    """One row: positives, negatives, positive rate over all rows, negative-to-positive ratio."""
    def count_of(value: str) -> Column:
        return F.count(F.when(F.col(target) == value, 1))

    counts = df.agg(
        count_of(positive).alias("positives"),
        count_of(negative).alias("negatives"),
        F.count(F.lit(1)).alias("total"),
    )
    return counts.select(
        "positives",
        "negatives",
        round4(share(F.col("positives"), F.col("total"))).alias("churn_rate"),
        F.when(F.col("positives") > 0, round4(F.col("negatives") / F.col("positives")))
        .otherwise(F.lit(float("inf")))
        .alias("imbalance_ratio"),
    )


def numeric_summary(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Moments, exact quartiles, skewness (bias-corrected), IQR and outlier count per column.

    The table is read once: its value histogram is written, and all figures come from it.
    """
    columns = [c for c in columns if c in df.columns]
    long = unpivot(df, columns).filter(F.col("value").isNotNull())
    hist = written(long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")), "value-histogram")
    sums = hist.groupBy("feature").agg(
        F.sum("n").alias("count"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    off = F.col("value") - F.col("mean")
    central = (
        hist.join(small(sums, len(columns)), "feature")
        .groupBy("feature", "count", "mean", "min", "max")
        .agg(
            F.sum(F.col("n") * off * off).alias("m2"),
            F.sum(F.col("n") * off * off * off).alias("m3"),
        )
    )
    moments = central.select(
        "feature",
        "count",
        "mean",
        "min",
        "max",
        F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1))).alias("std"),
        F.when(
            F.col("m2") > 0, (F.col("m3") / F.col("count")) / F.pow(F.col("m2") / F.col("count"), 1.5)
        ).alias("g1"),
    )
    curve = written(running_totals(hist, ["feature"], "value", ["n"]), "value-curve")
    quartiles = quantiles_from_curve(curve, ["feature"], "value", QUARTILES, out="q")
    bounds = quartiles.select(
        "feature",
        F.col("q")[0].alias("q25"),
        F.col("q")[1].alias("q50"),
        F.col("q")[2].alias("q75"),
        (F.col("q")[2] - F.col("q")[0]).alias("iqr"),
    )
    fence = 1.5 * F.col("iqr")
    outliers = (
        curve.join(small(bounds, len(columns)), "feature")
        .groupBy("feature")
        .agg(
            F.sum(
                F.when(
                    (F.col("value") < F.col("q25") - fence) | (F.col("value") > F.col("q75") + fence),
                    F.col("n"),
                ).otherwise(F.lit(0))
            ).alias("outliers_iqr")
        )
    )
    count = F.col("count").cast("double")
    skew = F.when(
        F.col("count") > 2, F.col("g1") * F.sqrt(count * (count - 1)) / (count - 2)
    )
    return (
        moments.join(bounds, "feature")
        .join(outliers, "feature")
        .select(
            "feature",
            "count",
            round2(F.col("mean")).alias("mean"),
            round2(F.col("std")).alias("std"),
            round2(F.col("min")).alias("min"),
            round2(F.col("q25")).alias("p25"),
            round2(F.col("q50")).alias("p50"),
            round2(F.col("q75")).alias("p75"),
            round2(F.col("max")).alias("max"),
            round2(skew).alias("skewness"),
            round2(F.col("iqr")).alias("iqr"),
            "outliers_iqr",
        )
    )


def categorical_summary(
    df: DataFrame, columns: Sequence[str], target: str | None = None, positive: str = "Yes"
) -> DataFrame:
    """Per (feature, category): count, share of all rows, positives, positive rate."""
    columns = [c for c in columns if c in df.columns]
    keep = [target] if target and target in df.columns else []
    long = unpivot(df, columns, keep=keep, value="category", as_type="string")
    hit = F.count(F.when(F.col(target) == positive, 1)) if keep else F.lit(0).cast("bigint")
    counts = long.groupBy("feature", "category").agg(
        F.count(F.lit(1)).alias("count"), hit.alias("churn_count")
    )
    # Null categories are counted in the row total of a feature but not listed.
    total = counts.groupBy("feature").agg(F.sum("count").alias("_total"))
    return (
        counts.filter(F.col("category").isNotNull())
        .join(small(total, len(columns)), "feature")
        .select(
            "feature",
            "category",
            "count",
            round2(100.0 * F.col("count") / F.col("_total")).alias("percentage"),
            "churn_count",
            round2(100.0 * share(F.col("churn_count"), F.col("count"))).alias("churn_rate"),
        )
    )


def correlations(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Pearson correlations in long form (both triangles and the diagonal), pairwise complete."""
    columns = [c for c in columns if c in df.columns]
    pairs = list(combinations(columns, 2))
    x = {c: finite(F.col(c)) for c in columns}
    row = df.agg(
        F.lit(1).alias("_one"),
        *[F.corr(x[a], x[b]).alias(f"_r{i}") for i, (a, b) in enumerate(pairs)],
    )

    def cell(a: str, b: str, r: Column) -> Column:
        return F.struct(F.lit(a).alias("feature_x"), F.lit(b).alias("feature_y"), r.alias("correlation"))

    cells = [cell(c, c, F.lit(1.0)) for c in columns]
    for i, (a, b) in enumerate(pairs):
        r = round4(F.col(f"_r{i}"))
        cells += [cell(a, b, r), cell(b, a, r)]
    return row.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")


def charge_discrepancies(
    df: DataFrame,
    tenure: str = "tenure",
    monthly: str = "MonthlyCharges",
    total: str = "TotalCharges",
) -> DataFrame:
    """One row: missing totals and the distribution of |total - tenure * monthly|."""
    gaps = df.select(
        charge_discrepancy(F.col(tenure), F.col(monthly), F.col(total)).alias("gap"),
        F.col(total).isNull().alias("blank"),
        F.lit(1).alias("_one"),
    )
    moments = gaps.groupBy("_one").agg(
        F.count(F.when(F.col("blank"), 1)).alias("blank_total_charges_count"),
        F.avg("gap").alias("mean"),
        F.stddev_samp("gap").alias("std"),
        F.max("gap").alias("max"),
    )
    median = exact_quantiles(gaps, ["_one"], "gap", [0.5], out="q")
    return moments.join(median, "_one", "left").select(
        "blank_total_charges_count",
        round2(F.col("mean")).alias("mean_abs_diff"),
        round2(F.col("q")[0]).alias("median_abs_diff"),
        round2(F.col("std")).alias("std_abs_diff"),
        round2(F.col("max")).alias("max_abs_diff"),
    )


def id_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """One row: whether every row has its own non-null key, by counting keys in two steps."""
    counts = df.groupBy(F.col(key).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count("key").alias("distinct_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows")
    ).select(
        "distinct_keys",
        "total_rows",
        (F.col("distinct_keys") == F.col("total_rows")).alias("customer_id_unique"),
    )


#: Size of the distinct sketch (two to this power) and the share of rows beyond which its estimate decides: over six standard errors.
SKETCH, SKETCH_MARGIN = 14, 0.05


def keys_repeat_for_sure(df: DataFrame, key: str) -> bool:
    """Whether one narrow pass shows that keys are missing or repeat: tasks send a sketch each, no keys.

    False only says that the sketch cannot tell.
    """
    text = F.col(key).cast("string")
    row = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(text).alias("known"),
        F.hll_sketch_estimate(F.hll_sketch_agg(text, F.lit(SKETCH))).alias("distinct"),
    ).first()
    return row["known"] < row["total"] or (row["distinct"] or 0) < row["total"] * (1 - SKETCH_MARGIN)


def has_unique_ids(df: DataFrame, key: str) -> DataFrame:
    """One row ``customer_id_unique``; keys are shuffled only if a sketch of them leaves the answer open."""
    if keys_repeat_for_sure(df, key):
        return df.sparkSession.range(1).select(F.lit(False).alias("customer_id_unique"))
    return id_uniqueness(df, key).select("customer_id_unique")


def positive_rates(
    df: DataFrame, dimensions: Sequence[str], target: str, positive: str = "Yes"
) -> DataFrame:
    """Positive rate in percent per value of each sensitive dimension."""
    summary = categorical_summary(df, dimensions, target, positive)
    return summary.select("feature", "category", "count", "churn_count", "churn_rate")
