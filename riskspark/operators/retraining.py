"""Retraining advice from outcome metrics, drift and label coverage. Never starts a training run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.rounding import round4
from riskspark.operators.distribution import side_by_side


@dataclass(frozen=True)
class RetrainingPolicy:
    """Thresholds of the advice; the baseline is the published one unless given."""

    baseline_pr_auc: float = 0.6437
    pr_auc_drop: float = 0.05
    brier_max: float = 0.20
    psi_alert: float = 0.25
    min_match_rate: float = 0.80


def retraining_decision(
    evaluation: DataFrame,
    drift: DataFrame | None = None,
    matching: DataFrame | None = None,
    policy: RetrainingPolicy = RetrainingPolicy(),
) -> DataFrame:
    """One row of evidence, fired triggers and the recommendation.

    ``evaluation`` needs ``pr_auc`` and ``brier_score``; ``drift`` is the rollup of
    the drift report; ``matching`` the match statistics. All have one row.
    """
    parts = [evaluation.select("pr_auc", "brier_score")]
    if drift is not None:
        names = F.col("drifted_features") if "drifted_features" in drift.columns else F.array()
        parts.append(
            drift.select(
                "max_psi",
                "drifted_features_count",
                names.cast("array<string>").alias("drifted_features"),
            )
        )
    if matching is not None:
        parts.append(matching.select("match_rate"))
    row = side_by_side(*parts)
    if drift is None:
        row = row.withColumn("max_psi", F.lit(0.0)).withColumn(
            "drifted_features_count", F.lit(0).cast("bigint")
        ).withColumn("drifted_features", F.array().cast("array<string>"))
    if matching is None:
        row = row.withColumn("match_rate", F.lit(1.0))

    current = F.coalesce(F.col("pr_auc"), F.lit(0.0))
    brier = F.coalesce(F.col("brier_score"), F.lit(0.0))
    baseline = F.lit(float(policy.baseline_pr_auc))
    degraded = (baseline - current) > F.lit(policy.pr_auc_drop)
    miscalibrated = brier > F.lit(policy.brier_max)
    drifted = (F.col("max_psi") >= F.lit(policy.psi_alert)) | (F.col("drifted_features_count") > 0)
    unmatched = F.col("match_rate") < F.lit(policy.min_match_rate)
    triggers = F.array_compact(
        F.array(
            F.when(degraded, F.lit("PR_AUC_DEGRADATION")),
            F.when(miscalibrated, F.lit("CALIBRATION_DEGRADATION")),
            F.when(drifted, F.lit("FEATURE_DRIFT_ALERT")),
            F.when(unmatched, F.lit("DATA_QUALITY_ALERT")),
        )
    )
    # What each fired trigger saw and the limit it compared with, in the order of the triggers.
    def reason(fired: Column, code: str, seen: Column, limit: float) -> Column:
        return F.when(
            fired,
            F.struct(
                F.lit(code).alias("trigger"),
                round4(seen).alias("observed"),
                F.lit(float(limit)).alias("limit"),
            ),
        )

    reasons = F.array_compact(
        F.array(
            reason(degraded, "PR_AUC_DEGRADATION", baseline - current, policy.pr_auc_drop),
            reason(miscalibrated, "CALIBRATION_DEGRADATION", brier, policy.brier_max),
            reason(drifted, "FEATURE_DRIFT_ALERT", F.col("max_psi"), policy.psi_alert),
            reason(unmatched, "DATA_QUALITY_ALERT", F.col("match_rate"), policy.min_match_rate),
        )
    )
    advise = degraded | (drifted & miscalibrated)
    return row.select(
        advise.alias("retrain_recommended"),
        F.when(advise, F.lit("RETRAIN_RECOMMENDED"))
        .otherwise(F.lit("MAINTAIN_INCUMBENT"))
        .alias("decision_code"),
        round4(baseline).alias("baseline_pr_auc"),
        round4(current).alias("delayed_label_pr_auc"),
        round4(current - baseline).alias("pr_auc_delta"),
        F.lit(float(policy.pr_auc_drop)).alias("pr_auc_drop_threshold"),
        round4(brier).alias("brier_score"),
        F.lit(float(policy.brier_max)).alias("brier_score_max"),
        round4(F.col("max_psi")).alias("max_psi"),
        F.lit(float(policy.psi_alert)).alias("psi_alert_threshold"),
        round4(F.col("match_rate")).alias("match_rate"),
        F.lit(float(policy.min_match_rate)).alias("min_match_rate"),
        triggers.alias("triggers_fired"),
        reasons.alias("reasons"),
        F.col("drifted_features"),
    )
