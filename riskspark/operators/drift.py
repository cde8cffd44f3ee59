"""Drift between a reference table and a current table: PSI, KS, missing rates.

Both tables are read once. Their values meet in one histogram of all features with a
count for each side, which is written; PSI, KS, missing rates and sizes are read from it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.parsing import to_number
from riskspark.functions.rounding import round4, share
from riskspark.operators.distribution import (
    edge_bin,
    quantiles_from_curve,
    running_totals,
    side_by_side,
    finite,
    small,
    unpivot,
)
from riskspark.session import written

# Bins, zero-share replacement, missing category, default features.
PSI_BINS = 10
EPSILON = 1e-4
MISSING = "__MISSING__"
NUMERIC_FEATURES = ("tenure", "MonthlyCharges", "TotalCharges")
CATEGORICAL_FEATURES = (
    "Contract",
    "InternetService",
    "PaymentMethod",
    "OnlineSecurity",
    "TechSupport",
    "PaperlessBilling",
    "PhoneService",
    "MultipleLines",
    "OnlineBackup",
    "DeviceProtection",
    "StreamingTV",
    "StreamingMovies",
    "Partner",
    "Dependents",
)
KS_TERMS = 100
CELL = ("kind", "feature", "number", "word")
#: Up to so many rows on either side the KS p-value is exact.
KS_EXACT_ROWS = 10_000
#: From this shape on both p-values are below 1e-13 and the series is taken.
KS_FAR = 4.0


@dataclass(frozen=True)
class DriftPolicy:
    """Thresholds of the drift report. The last two are off unless set."""

    psi_warning: float = 0.10
    psi_critical: float = 0.25
    ks_alpha: float | None = None
    missing_rate_delta: float | None = None


def status(psi: Column, policy: DriftPolicy = DriftPolicy()) -> Column:
    """Drift status word of a PSI value."""
    return (
        F.when(psi >= policy.psi_critical, F.lit("significant_drift"))
        .when(psi >= policy.psi_warning, F.lit("moderate_drift"))
        .otherwise(F.lit("no_drift"))
    )


def _shared(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in reference.columns and c in current.columns]


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    def number(c: str) -> Column:
        text = isinstance(df.schema[c].dataType, T.StringType)
        return (to_number(F.col(c)) if text else F.col(c).cast("double")).alias(c)

    return df.select(*[number(c) for c in columns])


def _side_counts(reference: DataFrame, current: DataFrame, columns: Sequence[str], as_type: str) -> DataFrame:
    """Counts per (feature, value) on each side; null values form a value of their own."""
    def side(df: DataFrame, ref: int) -> DataFrame:
        long = unpivot(df, columns, as_type=as_type)
        return long.select("feature", "value", F.lit(ref).alias("is_ref"))

    both = side(reference, 1).unionByName(side(current, 0))
    return both.groupBy("feature", "value").agg(
        F.sum("is_ref").cast("bigint").alias("ref_n"),
        F.sum(1 - F.col("is_ref")).cast("bigint").alias("cur_n"),
    )


def numeric_histogram(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two-sided counts per (feature, value) of numeric features; bad text counts as missing."""
    columns = _shared(reference, current, columns)
    return _side_counts(_numbers(reference, columns), _numbers(current, columns), columns, "double")


def feature_histogram(
    reference: DataFrame, current: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> DataFrame:
    """Two-sided counts per (kind, feature, number, word) of all shared features, from one pass over each table."""
    numeric = _shared(reference, current, numeric)
    categorical = _shared(reference, current, categorical)
    if not numeric and not categorical:
        raise ValueError("the two tables share none of the drift features")

    def side(df: DataFrame, ref: int) -> DataFrame:
        return feature_cells(df, numeric, categorical).withColumn("is_ref", F.lit(ref))

    return (
        side(reference, 1)
        .unionByName(side(current, 0))
        .groupBy(*CELL)
        .agg(
            F.sum("is_ref").cast("bigint").alias("ref_n"),
            F.sum(1 - F.col("is_ref")).cast("bigint").alias("cur_n"),
        )
    )


def feature_cells(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Every value of every feature as a row ``kind``, ``feature``, ``number``, ``word``; bad numbers count as missing."""

    def cell(kind: str, name: str) -> Column:
        value = F.col(name)
        text = isinstance(df.schema[name].dataType, T.StringType)
        number = finite(to_number(value) if text else value) if kind == "numerical" else F.lit(None)
        word = value if kind == "categorical" else F.lit(None)
        return F.struct(
            F.lit(kind).alias("kind"),
            F.lit(name).alias("feature"),
            number.cast("double").alias("number"),
            word.cast("string").alias("word"),
        )

    cells = [cell("numerical", c) for c in numeric] + [cell("categorical", c) for c in categorical]
    return df.select(F.explode(F.array(*cells)).alias("_cell")).select("_cell.*")


def categorical_histogram(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Two-sided counts per (feature, category) of categorical features."""
    columns = _shared(reference, current, columns)
    return _side_counts(reference.select(*columns), current.select(*columns), columns, "string")


def missing_rates(histogram: DataFrame) -> DataFrame:
    """Missing rate on both sides and their absolute difference, per feature."""
    gone = F.col("value").isNull()
    sums = histogram.groupBy("feature").agg(
        F.sum(F.when(gone, F.col("ref_n")).otherwise(0)).alias("ref_missing"),
        F.sum(F.when(gone, F.col("cur_n")).otherwise(0)).alias("cur_missing"),
        F.sum("ref_n").alias("ref_n"),
        F.sum("cur_n").alias("cur_n"),
    )
    ref = share(F.col("ref_missing"), F.col("ref_n"))
    cur = share(F.col("cur_missing"), F.col("cur_n"))
    return sums.select(
        "feature",
        round4(ref).alias("missing_rate_reference"),
        round4(cur).alias("missing_rate_scoring"),
        round4(F.abs(cur - ref)).alias("missing_rate_delta"),
    )


def _psi_term(ref_share: Column, cur_share: Column) -> Column:
    p = F.when(ref_share == 0, F.lit(EPSILON)).otherwise(ref_share)
    q = F.when(cur_share == 0, F.lit(EPSILON)).otherwise(cur_share)
    return (q - p) * F.log(q / p)


def _curve(histogram: DataFrame) -> DataFrame:
    return running_totals(
        histogram.filter(F.col("value").isNotNull()), ["feature"], "value", ["ref_n", "cur_n"]
    )


def numeric_psi(
    histogram: DataFrame,
    max_features: int,
    bins: int = PSI_BINS,
    curve: DataFrame | None = None,
) -> DataFrame:
    """PSI per feature over the reference's quantile bins.

    Bins are the distinct reference quantiles; values of the current side outside
    them belong to no bin but stay in the denominator; with fewer than two edges,
    or with an empty side, the PSI is 0.
    """
    curve = _curve(histogram) if curve is None else curve
    steps = [i / bins for i in range(bins + 1)]
    edges = quantiles_from_curve(curve, ["feature"], "value", steps, count="ref_n", out="edges")
    edges = edges.select("feature", F.array_sort(F.array_distinct("edges")).alias("edges"))
    binned = (
        curve.join(small(edges, max_features), "feature")
        .withColumn("bin", F.when(F.size("edges") >= 2, edge_bin(F.col("value"), F.col("edges"))))
        .groupBy("feature", "bin")
        .agg(
            F.sum("ref_n").alias("ref_n"),
            F.sum("cur_n").alias("cur_n"),
            F.max("all_ref_n").alias("all_ref_n"),
            F.max("all_cur_n").alias("all_cur_n"),
        )
    )
    # Inner bins holding neither side contribute nothing, so only seen bins matter.
    term = _psi_term(
        share(F.col("ref_n"), F.col("all_ref_n")), share(F.col("cur_n"), F.col("all_cur_n"))
    )
    usable = F.col("bin").isNotNull() & (F.col("all_ref_n") > 0) & (F.col("all_cur_n") > 0)
    return binned.groupBy("feature").agg(
        round4(F.greatest(F.lit(0.0), F.coalesce(F.sum(F.when(usable, term)), F.lit(0.0)))).alias("psi")
    )


def categorical_psi(histogram: DataFrame, max_features: int) -> DataFrame:
    """PSI per feature over categories; missing is a category."""
    named = histogram.groupBy("feature", F.coalesce("value", F.lit(MISSING)).alias("value")).agg(
        F.sum("ref_n").alias("ref_n"), F.sum("cur_n").alias("cur_n")
    )
    totals = named.groupBy("feature").agg(
        F.sum("ref_n").alias("all_ref_n"), F.sum("cur_n").alias("all_cur_n")
    )
    term = _psi_term(
        share(F.col("ref_n"), F.col("all_ref_n")), share(F.col("cur_n"), F.col("all_cur_n"))
    )
    return (
        named.join(small(totals, max_features), "feature")
        .groupBy("feature")
        .agg(round4(F.greatest(F.lit(0.0), F.sum(term))).alias("psi"))
    )


def ks_p_value(statistic: Column, n_ref: Column, n_cur: Column, exact_rows: int = KS_EXACT_ROWS) -> Column:
    """Two-sided p-value of the two-sample statistic.

    Exact while neither side has more than ``exact_rows`` rows, from the asymptotic Kolmogorov distribution beyond. At the default
    border the two differ by less than 0.006. Without a statistic it is 1.
    """
    lam = statistic * F.sqrt(n_ref.cast("double") * n_cur / (n_ref + n_cur))
    few = (F.greatest(n_ref, n_cur) <= exact_rows) & (lam < KS_FAR)
    return F.when(few, _exact_p_value(statistic, n_ref, n_cur)).otherwise(_asymptotic_p_value(lam))


def _asymptotic_p_value(lam: Column) -> Column:
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_TERMS)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(-2.0 * k * k * lam * lam),
    )
    # Below 0.2 the alternating series has not converged yet and the value is 1.
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series))
    )


def _exact_p_value(statistic: Column, n_ref: Column, n_cur: Column) -> Column:
    """The chance that a random order of both sides' rows has a statistic at least as large.

    An order is a lattice path: after k rows, i are of the reference. The path is a walk whose step chances are the shares
    of the rows left, and its statistic stays below the given one while ``abs(i * n_cur - (k - i) * n_ref)`` stays below ``h``. The
    chances of all i inside that band are one array, taken from step to step; what is left of them at the end is the
    chance of a smaller statistic. The band is about ``2 * lam * sqrt(n_ref * n_cur / (n_ref + n_cur))`` entries wide.
    """
    n, m = n_ref.cast("double"), n_cur.cast("double")
    total = n + m
    h = F.round(statistic * n * m)

    def step(walk: Column, k: Column) -> Column:
        low = F.greatest(F.lit(0.0), k - m, F.floor((k * n - h) / total) + 1).cast("int")
        high = F.least(n, k.cast("double"), F.ceil((k * n + h) / total) - 1).cast("int")

        def chance(i: Column) -> Column:
            from_ref = F.coalesce(F.get(walk["p"], i - 1 - walk["low"]), F.lit(0.0)) * (n - i + 1)
            from_cur = F.coalesce(F.get(walk["p"], i - walk["low"]), F.lit(0.0)) * (m - k + 1 + i)
            return (from_ref + from_cur) / (total - k + 1)

        none = F.array().cast("array<double>")
        inside = F.when(high < low, none).otherwise(F.transform(F.sequence(low, high), chance))
        return F.struct(low.alias("low"), inside.alias("p"))

    start = F.struct(F.lit(0).alias("low"), F.array(F.lit(1.0)).alias("p"))
    steps = F.sequence(F.lit(1), (n_ref + n_cur).cast("int"))
    left = F.aggregate(
        steps, start, step, lambda walk: F.aggregate(walk["p"], F.lit(0.0), lambda a, x: a + x)
    )
    return F.when(h <= 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - left)))


def ks_statistics(histogram: DataFrame, curve: DataFrame | None = None) -> DataFrame:
    """Two-sample KS statistic and p-value per feature; 0 and 1 when a side is empty.

    The exact p-value of a small feature is worked out in its one row.
    """
    curve = _curve(histogram) if curve is None else curve
    gap = F.abs(
        F.col("cum_ref_n") / F.col("all_ref_n") - F.col("cum_cur_n") / F.col("all_cur_n")
    )
    both = (F.col("all_ref_n") > 0) & (F.col("all_cur_n") > 0)
    top = curve.groupBy("feature").agg(
        F.max(F.when(both, gap)).alias("ks"),
        F.max("all_ref_n").alias("n_ref"),
        F.max("all_cur_n").alias("n_cur"),
    )
    p = F.when(
        F.col("ks").isNotNull(), ks_p_value(F.col("ks"), F.col("n_ref"), F.col("n_cur"))
    ).otherwise(F.lit(1.0))
    return top.select(
        "feature",
        round4(F.coalesce("ks", F.lit(0.0))).alias("ks_statistic"),
        round4(p).alias("ks_p_value"),
    )


def feature_drift(
    current: DataFrame,
    reference: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    policy: DriftPolicy = DriftPolicy(),
    histogram: DataFrame | None = None,
) -> DataFrame:
    """One row per feature present in both tables: PSI, KS, missing rates, status.

    ``histogram`` is a :func:`feature_histogram` that was made before.
    """
    if histogram is None:
        histogram = written(feature_histogram(reference, current, numeric, categorical), "drift-histogram")
    numeric = _shared(reference, current, numeric)
    categorical = _shared(reference, current, categorical)
    parts = []
    if numeric:
        hist = histogram.where("kind = 'numerical'").select(
            "feature", F.col("number").alias("value"), "ref_n", "cur_n"
        )
        curve = written(_curve(hist), "drift-curve")
        # A feature that is missing everywhere has no curve and keeps PSI 0, KS 0, p 1.
        parts.append(
            missing_rates(hist)
            .join(numeric_psi(hist, len(numeric), curve=curve), "feature", "left")
            .join(ks_statistics(hist, curve), "feature", "left")
            .select(
                "feature",
                F.lit("numerical").alias("feature_type"),
                F.coalesce("psi", F.lit(0.0)).alias("psi"),
                F.coalesce("ks_statistic", F.lit(0.0)).alias("ks_statistic"),
                F.coalesce("ks_p_value", F.lit(1.0)).alias("ks_p_value"),
                "missing_rate_reference",
                "missing_rate_scoring",
                "missing_rate_delta",
            )
        )
    if categorical:
        hist = histogram.where("kind = 'categorical'").select(
            "feature", F.col("word").alias("value"), "ref_n", "cur_n"
        )
        parts.append(
            missing_rates(hist)
            .join(categorical_psi(hist, len(categorical)), "feature")
            .select(
                "feature",
                F.lit("categorical").alias("feature_type"),
                "psi",
                F.lit(None).cast("double").alias("ks_statistic"),
                F.lit(None).cast("double").alias("ks_p_value"),
                "missing_rate_reference",
                "missing_rate_scoring",
                "missing_rate_delta",
            )
        )
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    out = out.withColumn("drift_status", status(F.col("psi"), policy))
    if policy.ks_alpha is not None:
        out = out.withColumn(
            "ks_flag", F.coalesce(F.col("ks_p_value") < policy.ks_alpha, F.lit(False))
        )
    if policy.missing_rate_delta is not None:
        out = out.withColumn("missing_flag", F.col("missing_rate_delta") > policy.missing_rate_delta)
    return out


def drift_report(
    features: DataFrame,
    reference: DataFrame,
    current: DataFrame,
    policy: DriftPolicy = DriftPolicy(),
    histogram: DataFrame | None = None,
) -> DataFrame:
    """One row: sizes of both tables, highest PSI, drifted features, overall status.

    With a :func:`feature_histogram` the sizes are sums over any one of its features.
    """
    if histogram is None:
        sizes = (
            reference.agg(F.count(F.lit(1)).alias("reference_record_count")),
            current.agg(F.count(F.lit(1)).alias("scoring_record_count")),
        )
    else:
        per_feature = histogram.groupBy("kind", "feature").agg(
            F.sum("ref_n").alias("ref_n"), F.sum("cur_n").alias("cur_n")
        )
        sizes = (
            per_feature.agg(
                F.coalesce(F.max("ref_n"), F.lit(0)).alias("reference_record_count"),
                F.coalesce(F.max("cur_n"), F.lit(0)).alias("scoring_record_count"),
            ),
        )

    rolled = features.agg(
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi"),
        F.count(F.when(F.col("drift_status") == "significant_drift", 1)).alias("drifted_features_count"),
        F.count(F.lit(1)).alias("features_evaluated"),
        F.array_sort(
            F.collect_list(F.when(F.col("drift_status") == "significant_drift", F.col("feature")))
        ).alias("drifted_features"),
    )
    joined = side_by_side(rolled, *sizes)
    overall = status(F.col("max_psi"), policy)
    return joined.select(
        "reference_record_count",
        "scoring_record_count",
        overall.alias("overall_drift_status"),
        "max_psi",
        "drifted_features_count",
        "features_evaluated",
        "drifted_features",
        F.concat(
            F.lit("Drift Analysis: overall status="),
            overall,
            F.lit(", max PSI="),
            F.col("max_psi").cast("string"),
            F.lit(", "),
            F.col("drifted_features_count").cast("string"),
            F.lit("/"),
            F.col("features_evaluated").cast("string"),
            F.lit(" features exhibited significant drift."),
        ).alias("summary"),
    )


def detect_drift(
    current: DataFrame,
    reference: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    policy: DriftPolicy = DriftPolicy(),
) -> tuple[DataFrame, DataFrame]:
    """Per-feature rows and the one-row rollup of one drift comparison."""
    histogram = written(feature_histogram(reference, current, numeric, categorical), "drift-histogram")
    features = written(
        feature_drift(current, reference, numeric, categorical, policy, histogram), "drift-features"
    )
    return features, drift_report(features, reference, current, policy, histogram)
