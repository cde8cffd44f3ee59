"""Batch scoring with a fitted pipeline or with a logistic formula as a column expression."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.decisions import batch_stamp, check_threshold, decide, new_batch_id
from riskspark.functions.rounding import round4
from riskspark.models.training import positive_probability
from riskspark.sources.commits import CommitLog


@dataclass(frozen=True)
class LogisticFormula:
    """``sigmoid(b + sum(w_i * x_i) + sum(w_cv * [c = v]))`` over plain columns."""

    intercept: float
    numeric: Mapping[str, float] = field(default_factory=dict)
    categorical: Mapping[str, Mapping[str, float]] = field(default_factory=dict)

    def margin(self) -> Column:
        terms = [F.lit(float(self.intercept))]
        terms += [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(float(w)) for c, w in self.numeric.items()]
        for column, weights in self.categorical.items():
            value = F.col(column).cast("string")
            branch = reduce(
                lambda acc, item: acc.when(value == item[0], F.lit(float(item[1]))),
                weights.items(),
                F.when(F.lit(False), F.lit(0.0)),
            )
            terms.append(branch.otherwise(F.lit(0.0)))
        return reduce(lambda a, b: a + b, terms)

    def probability(self) -> Column:
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))


def formula_of(model: PipelineModel) -> tuple[SQLTransformer, LogisticFormula]:
    """A fitted logistic pipeline as its fill-and-scale projection and a formula.

    Scoring then needs no vector column and stays in generated code.
    """
    fitted = model.stages[-1]
    if not hasattr(fitted, "coefficients"):
        raise ValueError("only a logistic model has a formula")
    projection = next(s for s in model.stages if isinstance(s, SQLTransformer))
    weights = [float(w) for w in fitted.coefficients.toArray()]
    assembler = model.stages[-2]
    scaled = [c for c in assembler.getInputCols() if c.endswith("_scaled")]
    numeric = dict(zip(scaled, weights))
    categorical: dict[str, dict[str, float]] = {}
    at = len(scaled)
    for indexer in (s for s in model.stages if isinstance(s, StringIndexerModel)):
        for column, labels in zip(indexer.getInputCols(), indexer.labelsArray):
            categorical[column] = dict(zip(labels, weights[at : at + len(labels)]))
            at += len(labels)
    return projection, LogisticFormula(float(fitted.intercept), numeric, categorical)


def _with_probability(df: DataFrame, scorer: PipelineModel | LogisticFormula | Column) -> DataFrame:
    if isinstance(scorer, LogisticFormula):
        return df.withColumn("probability_1", scorer.probability())
    if isinstance(scorer, Column):
        return df.withColumn("probability_1", scorer)
    if hasattr(scorer.stages[-1], "coefficients"):
        projection, formula = formula_of(scorer)
        return projection.transform(df).withColumn("probability_1", formula.probability())
    return positive_probability(scorer.transform(df))


def score_batch(
    df: DataFrame,
    scorer: PipelineModel | LogisticFormula | Column,
    key: str = "customerID",
    threshold: float = 0.5,
    model_version: str = "1.0.0",
    batch_id: str | None = None,
    scored_at: datetime | None = None,
) -> DataFrame:
    """One output row per input row: id, probability, class and the batch stamp.

    The class compares the unrounded probability; the stored one has four decimals.
    """
    if key not in df.columns:
        raise ValueError(f"input lacks the key column '{key}'")
    check_threshold(threshold)
    scored = _with_probability(df, scorer)
    return scored.select(
        key,
        round4(F.col("probability_1")).alias("churn_probability"),
        decide(F.col("probability_1"), threshold).alias("predicted_class"),
        *batch_stamp(threshold, model_version, batch_id or new_batch_id(), scored_at),
    )


def model_versions(spark, root: str) -> list[int]:
    """Numbers of the versions that were stored whole."""
    return CommitLog(spark, root).numbers()


def save_version(spark, model: PipelineModel, root: str, metadata: Mapping | None = None) -> int:
    """Store a model as the next version, with its metadata; returns the version.

    The number is taken when the model lies there whole: of two writers each gets its own, and no reader meets half a version.
    """
    log = CommitLog(spark, root)
    folder = log.draft()
    model.write().save(log.path(f"{folder}/model"))
    return log.commit({"model": folder}, note=metadata)


def version_metadata(spark, root: str, version: int) -> dict:
    """What was noted when the version was stored."""
    return CommitLog(spark, root).read(version)["note"]


def load_version(spark, root: str, version: int | str | None = None) -> PipelineModel:
    """Load the given version, or the latest one."""
    log = CommitLog(spark, root)
    known = log.numbers()
    if not known:
        raise ValueError(f"no model versions under {root}")
    chosen = known[-1] if version in (None, "latest") else int(version)
    if chosen not in known:
        raise ValueError(f"model version {chosen} not found under {root}")
    return PipelineModel.load(log.path(f"{log.read(chosen)['set']['model']}/model"))
