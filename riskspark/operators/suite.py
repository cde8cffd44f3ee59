"""Whole evaluations: several models and splits at once, gates and the decision record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.rounding import round4
from riskspark.operators.capacity import capacity_cut, capacity_metrics
from riskspark.operators.classification import binary_metrics
from riskspark.operators.distribution import side_by_side
from riskspark.operators.scores import ScoreTable, fan_out, score_cells
from riskspark.operators.segments import (
    SEGMENT_DIMENSIONS,
    SENSITIVE_DIMENSIONS,
    fairness_disparities,
    fairness_metrics,
    segment_metrics,
)
from riskspark.session import written

KEYS = ("model", "split")
SPLIT_COUNT = 3
SUMMARY_METRICS = (
    "pr_auc",
    "roc_auc",
    "brier_score",
    "accuracy",
    "precision",
    "recall",
    "f1_score",
    "precision_at_capacity",
    "recall_at_capacity",
)


@dataclass(frozen=True)
class GatePolicy:
    """What a challenger must achieve on the selection split."""

    min_pr_auc_gain: float = 0.0100
    max_brier_rise: float = 0.0200
    max_parity_rise: float = 0.0500
    parity_dimension: str = "gender"
    selection_split: str = "val"
    report_split: str = "test"


def by_model(
    df: DataFrame, models: Mapping[str, str], ids: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """Long form with one row per (row, model): the scores of every model under one name."""
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("model"), F.col(column).cast("double").alias("y_prob"))
            for name, column in models.items()
        ]
    )
    columns = list(dict.fromkeys([*ids, *keep]))
    return df.select(*columns, F.explode(cells).alias("_m")).select(
        *columns, "_m.model", "_m.y_prob"
    )


@dataclass(frozen=True)
class Evaluation:
    """Result frames of one suite run, all keyed by model and split."""

    summary: DataFrame
    segments: DataFrame
    subgroups: DataFrame
    disparities: DataFrame


def evaluate_suite(
    df: DataFrame,
    models: Mapping[str, str],
    ids: Sequence[str],
    label: str = "y_true",
    split: str = "split",
    threshold: float = 0.5,
    fraction: float = 0.10,
    segment_dimensions: Sequence[str] = SEGMENT_DIMENSIONS,
    sensitive_dimensions: Sequence[str] = SENSITIVE_DIMENSIONS,
    decimals: int | None = None,
) -> Evaluation:
    """All metrics of all models on all splits of a scored table.

    The scored table is read once, to count it per (model, split, dimensions,
    score); those counts and the capacity lines are written to the shared folder,
    and every figure is computed from them. Only the rows tied at a capacity line
    are looked up in the table again.
    """
    segment_dimensions = [d for d in segment_dimensions if d in df.columns]
    sensitive_dimensions = [d for d in sensitive_dimensions if d in df.columns]
    dimensions = list(dict.fromkeys([*segment_dimensions, *sensitive_dimensions]))
    named = df.withColumn("split", F.col(split)).withColumn("y_true", F.col(label))
    long = by_model(named, models, ids, ["split", "y_true", *dimensions])
    max_keys = len(models) * SPLIT_COUNT

    cells = written(score_cells(long, dimensions, keys=KEYS, decimals=decimals), "score-cells")
    table = ScoreTable(cells.select(*KEYS, "score", "n", "pos"), KEYS, decimals)
    cut = written(capacity_cut(table, fraction), "capacity-lines")
    capacity = capacity_metrics(
        long, fraction, ids, keys=KEYS, decimals=decimals, max_keys=max_keys, cut=cut
    )

    def review(kind, names):
        return kind(fan_out(cells, names, KEYS, decimals), threshold, cut, max_keys)

    subgroups = review(fairness_metrics, sensitive_dimensions)
    return Evaluation(
        summary=binary_metrics(table, threshold).join(capacity, list(KEYS)),
        segments=review(segment_metrics, segment_dimensions),
        subgroups=subgroups,
        disparities=fairness_disparities(subgroups, [*KEYS, "dimension"]),
    )


def _of(model: str, column: str) -> Column:
    return F.max(F.when(F.col("model") == model, F.col(column)))


def compare_models(
    evaluation: Evaluation, champion: str, challenger: str, parity_dimension: str = "gender"
) -> DataFrame:
    """One row per split: metrics of both models and challenger-minus-champion differences."""
    wide = evaluation.summary.groupBy("split").agg(
        F.max("total_customers").alias("sample_size"),
        *[_of(champion, m).alias("champion_" + m) for m in SUMMARY_METRICS],
        *[_of(challenger, m).alias("challenger_" + m) for m in SUMMARY_METRICS],
        F.countDistinct("model").alias("models_present"),
    )
    parity = (
        evaluation.disparities.filter(F.col("dimension") == parity_dimension)
        .groupBy("split")
        .agg(
            _of(champion, "demographic_parity_difference").alias("champion_parity"),
            _of(challenger, "demographic_parity_difference").alias("challenger_parity"),
        )
    )

    def difference(metric: str) -> Column:
        return round4(F.col("challenger_" + metric) - F.col("champion_" + metric)).alias(metric + "_diff")

    zero = F.lit(0.0)
    return wide.join(parity, "split", "left").select(
        "split",
        "sample_size",
        "models_present",
        *["champion_" + m for m in SUMMARY_METRICS],
        *["challenger_" + m for m in SUMMARY_METRICS],
        *[
            difference(m)
            for m in ("pr_auc", "roc_auc", "brier_score", "precision_at_capacity", "recall_at_capacity")
        ],
        round4(
            F.coalesce("challenger_parity", zero) - F.coalesce("champion_parity", zero)
        ).alias("parity_change"),
    )


def acceptance_gates(comparison: DataFrame, policy: GatePolicy = GatePolicy()) -> DataFrame:
    """One row: each gate on the selection split, and whether all of them passed."""
    gain = F.col("pr_auc_diff") >= policy.min_pr_auc_gain
    calibrated = F.col("brier_score_diff") <= policy.max_brier_rise
    fair = F.col("parity_change") <= policy.max_parity_rise
    present = F.col("models_present") == 2
    return comparison.filter(F.col("split") == policy.selection_split).select(
        F.col("split").alias("selection_split"),
        F.col("sample_size").alias("selection_sample_size"),
        "pr_auc_diff",
        "brier_score_diff",
        "parity_change",
        F.coalesce(gain, F.lit(False)).alias("pr_auc_gate_passed"),
        F.coalesce(calibrated, F.lit(False)).alias("calibration_gate_passed"),
        F.coalesce(fair, F.lit(False)).alias("fairness_gate_passed"),
        present.alias("operational_gate_passed"),
        F.coalesce(gain & calibrated & fair & present, F.lit(False)).alias("all_gates_passed"),
    )


def decision_record(
    evaluation: Evaluation,
    comparison: DataFrame,
    champion: str,
    challenger: str,
    policy: GatePolicy = GatePolicy(),
) -> DataFrame:
    """One row: the selected model and a JSON record of gates, metrics and reviews.

    Only the per-group summaries enter the record, whose size is bounded by the
    number of models, splits and segment values.
    """
    gates = acceptance_gates(comparison, policy)

    def as_list(frame: DataFrame, name: str) -> DataFrame:
        rows = frame.filter(F.col("split") == policy.report_split)
        return rows.agg(F.array_sort(F.collect_list(F.struct(*frame.columns))).alias(name))

    joined = side_by_side(
        gates.select(F.struct(*gates.columns).alias("acceptance_gates"), "all_gates_passed"),
        as_list(comparison, "metrics_summary"),
        as_list(evaluation.segments, "segment_analysis"),
        as_list(evaluation.subgroups, "fairness_review"),
        as_list(evaluation.disparities, "fairness_disparities"),
    )
    chosen = F.when(F.col("all_gates_passed"), F.lit(challenger)).otherwise(F.lit(champion))
    record = F.struct(
        F.lit(policy.selection_split).alias("selection_split"),
        F.lit(policy.report_split).alias("evaluation_split"),
        F.array(F.lit(champion), F.lit(challenger)).alias("models_compared"),
        "acceptance_gates",
        "metrics_summary",
        "segment_analysis",
        "fairness_review",
        "fairness_disparities",
        chosen.alias("selected_model_name"),
    )
    return joined.select(
        chosen.alias("selected_model_name"), "all_gates_passed", F.to_json(record).alias("record")
    )
