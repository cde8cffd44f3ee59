"""Champion against challenger: train both on one split, score, compare, decide."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.models.training import (
    ModelSpec,
    fit_classifier,
    fit_encoding,
    positive_probability,
    split_rows,
    with_label,
)
from riskspark.operators.segments import with_bands
from riskspark.operators.suite import (
    Evaluation,
    GatePolicy,
    compare_models,
    decision_record,
    evaluate_suite,
)
from riskspark.session import written


@dataclass(frozen=True)
class Selection:
    """Frames of one selection run."""

    scored: DataFrame
    evaluation: Evaluation
    comparison: DataFrame
    record: DataFrame


def run_selection(
    rows: DataFrame,
    champion: ModelSpec,
    challenger: ModelSpec,
    threshold: float = 0.5,
    fraction: float = 0.10,
    policy: GatePolicy = GatePolicy(),
) -> Selection:
    """Fit both models on the training part, judge on validation, report on test."""
    split = split_rows(rows, champion)
    train = split.filter(F.col("split") == "train")
    scored = with_label(split, champion).withColumn("y_true", F.col("label").cast("int"))
    prepared: dict[tuple, tuple] = {}
    for spec in (champion, challenger):
        if spec.encoding not in prepared:
            prepared[spec.encoding] = fit_encoding(train, spec)
        model = fit_classifier(*prepared[spec.encoding], spec)
        kept = scored.columns
        scored = positive_probability(model.transform(scored)).select(
            *kept, F.col("probability_1").alias(f"score_{spec.name}")
        )
    scored = written(with_bands(scored), "selection-scores")
    models = {spec.name: f"score_{spec.name}" for spec in (champion, challenger)}
    judged = scored.filter(F.col("split") != "train")
    evaluation = evaluate_suite(judged, models, [champion.key], threshold=threshold, fraction=fraction)
    comparison = compare_models(evaluation, champion.name, challenger.name, policy.parity_dimension)
    record = decision_record(evaluation, comparison, champion.name, challenger.name, policy)
    return Selection(scored, evaluation, comparison, record)
