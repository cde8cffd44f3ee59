"""Segment and fairness reviews: the score metrics keyed by (dimension, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.bands import charge_band, tenure_band
from riskspark.functions.rounding import round4, share
from riskspark.operators.classification import confusion_sums, squared_error
from riskspark.operators.distribution import small
from riskspark.operators.ranking import ranking_sums
from riskspark.operators.scores import ScoreTable

# Default review dimensions.
SEGMENT_DIMENSIONS = ("tenure_band", "Contract", "InternetService", "monthly_charges_band")
SENSITIVE_DIMENSIONS = ("gender", "SeniorCitizen")


def with_bands(df: DataFrame) -> DataFrame:
    """Add the derived band columns where their source columns exist."""
    if "tenure" in df.columns:
        df = df.withColumn("tenure_band", tenure_band(F.col("tenure")))
    if "MonthlyCharges" in df.columns:
        df = df.withColumn("monthly_charges_band", charge_band(F.col("MonthlyCharges")))
    return df


def _group_sums(
    hist: ScoreTable,
    threshold: float,
    cut: float | DataFrame | None,
    max_cuts: int | None = None,
) -> DataFrame:
    """Counts, score sums and ranking sums per key, from one histogram.

    ``cut`` is the campaign cut score: a number, or a frame with one ``cut`` per
    outer key (all keys but dimension and value), at most ``max_cuts`` rows.
    """
    frame = hist.frame
    if isinstance(cut, DataFrame):
        outer = [k for k in hist.keys if k not in ("dimension", "value")]
        if outer:
            frame = frame.join(small(cut.select(*outer, "cut"), max_cuts), outer)
        else:
            frame = frame.withColumn("_one", F.lit(1)).join(
                small(cut.select(F.lit(1).alias("_one"), "cut"), 1), "_one"
            )
    elif cut is not None:
        frame = frame.withColumn("cut", F.lit(float(cut)))
    else:
        frame = frame.withColumn("cut", F.lit(None).cast("double"))
    at_cut = F.col("score") >= F.col("cut")
    counts = frame.groupBy(*hist.keys).agg(
        F.sum("n").alias("count"),
        F.sum("pos").alias("churn_count"),
        (F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("mean_score"),
        (squared_error() / F.sum("n")).alias("brier"),
        *confusion_sums(threshold),
        F.sum(F.when(at_cut, F.col("n")).otherwise(F.lit(0))).alias("cap_n"),
        F.sum(F.when(at_cut, F.col("pos")).otherwise(F.lit(0))).alias("cap_pos"),
    )
    return counts.join(ranking_sums(hist), list(hist.keys))


def _common(keys: Sequence[str]) -> list[Column | str]:
    return [
        *keys,
        F.col("count"),
        F.col("churn_count"),
        round4(share(F.col("churn_count"), F.col("count"))).alias("churn_rate"),
        round4(F.col("mean_score")).alias("mean_predicted_probability"),
        round4(F.col("pr_auc")).alias("pr_auc"),
        round4(F.col("roc_auc")).alias("roc_auc"),
        round4(F.col("brier")).alias("brier_score"),
    ]


def segment_metrics(
    table: ScoreTable,
    threshold: float = 0.5,
    cut: float | DataFrame | None = None,
    max_cuts: int | None = None,
) -> DataFrame:
    """One row per segment value; single-class segments have null AUCs and F1 0."""
    sums = _group_sums(table.histogram(), threshold, cut, max_cuts)
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    single = F.col("pr_auc").isNull()
    columns = _common(table.keys) + [
        round4(share(tp + tn, F.col("count"))).alias("accuracy"),
        F.when(single, F.lit(0.0)).otherwise(round4(share(2 * tp, 2 * tp + fp + fn))).alias("f1_score"),
    ]
    if cut is not None:
        columns += [
            F.col("cap_n").alias("selected_count_at_capacity"),
            round4(share(F.col("cap_pos"), F.col("cap_n"))).alias("precision_at_capacity"),
            round4(share(F.col("cap_pos"), F.col("churn_count"))).alias("recall_at_capacity"),
        ]
    return sums.select(*columns)


def fairness_metrics(
    table: ScoreTable,
    threshold: float = 0.5,
    cut: float | DataFrame | None = None,
    max_cuts: int | None = None,
) -> DataFrame:
    """One row per sensitive subgroup: selection rate, TPR, FPR, AUCs, Brier."""
    sums = _group_sums(table.histogram(), threshold, cut, max_cuts)
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    columns = _common(table.keys) + [
        round4(share(tp + fp, F.col("count"))).alias("selection_rate"),
        round4(share(tp, tp + fn)).alias("tpr"),
        round4(share(fp, fp + tn)).alias("fpr"),
    ]
    if cut is not None:
        columns.append(
            round4(share(F.col("cap_n"), F.col("count"))).alias("capacity_selection_rate")
        )
    return sums.select(*columns)


def fairness_disparities(subgroups: DataFrame, keys: Sequence[str] = ("dimension",)) -> DataFrame:
    """Gaps between the already rounded subgroup rates, for dimensions with two groups or more."""
    def gap(column: str) -> Column:
        return round4(F.max(column) - F.min(column))

    top, bottom = F.max("selection_rate"), F.min("selection_rate")
    return (
        subgroups.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("groups"),
            gap("selection_rate").alias("demographic_parity_difference"),
            round4(share(bottom, top, empty=1.0)).alias("demographic_parity_ratio"),
            gap("tpr").alias("equalized_odds_tpr_difference"),
            gap("fpr").alias("equalized_odds_fpr_difference"),
            gap("brier_score").alias("brier_score_disparity"),
        )
        .filter(F.col("groups") >= 2)
        .drop("groups")
    )
