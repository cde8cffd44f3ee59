"""Post-deployment review: match outcomes, evaluate, measure the campaign, advise."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from riskspark.operators.campaign import campaign_effect
from riskspark.operators.feedback import (
    evaluate_matched,
    match_outcomes,
    match_statistics,
    matched_calibration,
)
from riskspark.operators.retraining import RetrainingPolicy, retraining_decision
from riskspark.session import written


@dataclass(frozen=True)
class Review:
    """Frames of one review run."""

    matched: DataFrame
    statistics: DataFrame
    evaluation: DataFrame
    calibration: DataFrame
    campaign: DataFrame
    decision: DataFrame


def run_review(
    predictions: DataFrame,
    labels: DataFrame,
    key: str = "customerID",
    prediction_order: Sequence[str] = ("scoring_timestamp",),
    label_order: Sequence[str] = ("observation_date",),
    drift: DataFrame | None = None,
    threshold: float = 0.5,
    fraction: float = 0.10,
    contact_cost: float = 10.0,
    customer_value: float = 500.0,
    policy: RetrainingPolicy = RetrainingPolicy(),
    decimals: int | None = None,
) -> Review:
    """Predictions and late labels in, advice out. Nothing is trained or triggered.

    The matched rows and the two one-row reports are written to the shared folder:
    each is read by several later steps.
    """
    matched = written(
        match_outcomes(predictions, labels, key, prediction_order, label_order), "matched"
    )
    statistics = written(match_statistics(predictions, labels, matched), "match-statistics")
    evaluation = written(evaluate_matched(matched, [key], threshold, fraction, decimals=decimals), "late-evaluation")
    campaign = campaign_effect(matched, contact_cost, customer_value)
    decision = retraining_decision(evaluation, drift, statistics, policy)
    return Review(
        matched, statistics, evaluation, matched_calibration(matched), campaign, decision
    )
