"""Late outcomes: keep-last dedup, matching with predictions, evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.parsing import binary_outcome, outcome_column
from riskspark.functions.rounding import round4, share
from riskspark.operators.calibration import calibration_uniform
from riskspark.operators.capacity import capacity_metrics
from riskspark.operators.classification import binary_metrics
from riskspark.operators.distribution import side_by_side
from riskspark.operators.scores import score_table

SCORE_COLUMN = "churn_probability"
OUTCOME = "observed_churn"


def keep_last(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the one latest in ``order``.

    ``max_by`` combines map-side, so a key repeated in a third of all rows sends
    one candidate per task instead of all its rows. The order columns should end
    with a tiebreak that makes the last row unique.
    """
    if not order:
        raise ValueError("keep_last needs at least one ordering column")
    latest = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row")
    return df.groupBy(F.col(key).alias("_key")).agg(latest).select("_row.*")


def prepare_labels(labels: DataFrame, key: str) -> DataFrame:
    """Labels with a 0/1 ``observed_churn`` derived from the first known outcome column."""
    if key not in labels.columns:
        raise ValueError(f"labels lack the id column '{key}'")
    source = outcome_column(labels.columns)
    kind = labels.schema[source].dataType.simpleString()
    return labels.withColumn(OUTCOME, binary_outcome(F.col(source), kind))


def match_outcomes(
    predictions: DataFrame,
    labels: DataFrame,
    key: str = "customerID",
    prediction_order: Sequence[str] = ("scoring_timestamp",),
    label_order: Sequence[str] = ("observation_date",),
) -> DataFrame:
    """Predictions joined with their outcomes on the key, the last row of each side kept.

    Both sides have unique keys by then, so the join has no hot key. Columns both
    sides share get the suffixes ``_pred`` and ``_observed``.
    """
    for name, frame in (("predictions", predictions), ("labels", labels)):
        if key not in frame.columns:
            raise ValueError(f"{name} lack the id column '{key}'")
    if SCORE_COLUMN not in predictions.columns:
        raise ValueError(f"predictions lack the probability column '{SCORE_COLUMN}'")
    left = keep_last(predictions, key, prediction_order)
    right = keep_last(prepare_labels(labels, key), key, label_order)
    shared = [c for c in left.columns if c in right.columns and c != key]
    for c in shared:
        left = left.withColumnRenamed(c, c + "_pred")
        right = right.withColumnRenamed(c, c + "_observed")
    return left.join(right, key)


def match_statistics(predictions: DataFrame, labels: DataFrame, matched: DataFrame) -> DataFrame:
    """One row: sizes before dedup, matched rows, unmatched predictions, match rate."""
    def rows(df: DataFrame, kind: str) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"))

    counted = (
        rows(predictions, "p").unionByName(rows(labels, "l")).unionByName(rows(matched, "m"))
    ).agg(
        *[
            F.count(F.when(F.col("kind") == k, 1)).alias(name)
            for k, name in (
                ("p", "total_historical_predictions"),
                ("l", "total_delayed_labels_received"),
                ("m", "matched_records"),
            )
        ]
    )
    total, hit = F.col("total_historical_predictions"), F.col("matched_records")
    return counted.select(
        "total_historical_predictions",
        "total_delayed_labels_received",
        "matched_records",
        (total - hit).alias("unmatched_predictions"),
        round4(share(hit, total)).alias("match_rate"),
    )


def evaluate_matched(
    matched: DataFrame,
    ids: Sequence[str],
    threshold: float = 0.5,
    fraction: float = 0.10,
    score: str = SCORE_COLUMN,
    outcome: str = OUTCOME,
    decimals: int | None = None,
) -> DataFrame:
    """One row: prevalence, binary metrics and capacity metrics of matched predictions.

    Scores are compared as stored. ``decimals`` says that they lie on a grid of so many
    decimals, which keeps the histogram small. ``matched_calibration`` has the calibration points.
    """
    for column in (score, outcome):
        if column not in matched.columns:
            raise ValueError(f"matched rows lack the column '{column}'")
    table = score_table(matched, outcome, score, decimals=decimals)
    size = matched.agg(
        F.count(F.lit(1)).alias("sample_size"),
        round4(F.avg(outcome)).alias("observed_churn_prevalence"),
    )
    metrics = binary_metrics(table, threshold)
    capacity = capacity_metrics(matched, fraction, ids, outcome, score, decimals=decimals)
    return side_by_side(size, metrics, capacity)


def matched_calibration(
    matched: DataFrame, n_bins: int = 10, score: str = SCORE_COLUMN, outcome: str = OUTCOME
) -> DataFrame:
    """Calibration points of matched predictions over equal-width bins."""
    return calibration_uniform(score_table(matched, outcome, score), n_bins)
