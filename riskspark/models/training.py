"""Training of the binary risk models on Spark ML, and what a fitted model tells."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoderModel, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.parsing import binary_target
from riskspark.functions.rounding import round4, share
from riskspark.models.boosting import HistogramBoosting
from riskspark.models.preprocessing import (
    CATEGORICAL_FEATURES,
    NUMERIC_FEATURES,
    encoding_stages,
    fit_preprocessing,
)
from riskspark.operators.split import exact_split
from riskspark.session import written

# Hyperparameters of the published models.
LOGISTIC_DEFAULTS = {"C": 1.0, "max_iter": 1000}
BOOSTING_DEFAULTS = {
    "n_estimators": 100,
    "max_depth": 3,
    "learning_rate": 0.05,
    "subsample": 0.8,
    "max_features": "sqrt",
}
# Defaults of the library whose model type this is.
HISTOGRAM_DEFAULTS = {
    "max_iter": 100,
    "learning_rate": 0.1,
    "max_leaf_nodes": 31,
    "max_depth": None,
    "min_samples_leaf": 20,
    "l2_regularization": 0.0,
    "max_bins": 255,
}
_LOGISTIC_NAMES = ("logisticregression", "logistic_regression")
_BOOSTING_NAMES = ("gradientboosting", "gradientboostingclassifier", "gb", "gbc")
_HISTOGRAM_NAMES = ("histgradientboosting", "histgradientboostingclassifier")


@dataclass(frozen=True)
class ModelSpec:
    """What to train: type, hyperparameters, features, target and split."""

    name: str = "baseline_logistic_regression"
    kind: str = "LogisticRegression"
    hyperparameters: Mapping[str, object] = field(default_factory=dict)
    numeric: Sequence[str] = NUMERIC_FEATURES
    categorical: Sequence[str] = CATEGORICAL_FEATURES
    key: str = "customerID"
    target: str = "Churn"
    positive: str = "Yes"
    test_size: float = 0.15
    val_size: float = 0.15
    seed: int = 42

    @property
    def encoding(self) -> tuple:
        """What the preparation of training rows depends on."""
        return tuple(self.numeric), tuple(self.categorical), self.target, self.positive


def classifier(spec: ModelSpec, rows: int):
    """The estimator of a spec. ``rows`` turns the inverse penalty C into Spark's per-row one."""
    kind = spec.kind.lower()
    common = {"featuresCol": "features", "labelCol": "label"}
    if kind in _LOGISTIC_NAMES:
        p = {**LOGISTIC_DEFAULTS, **spec.hyperparameters}
        return LogisticRegression(
            regParam=1.0 / (float(p["C"]) * rows),
            elasticNetParam=0.0,
            standardization=False,
            maxIter=int(p["max_iter"]),
            tol=1e-9,
            **common,
        )
    if kind in _HISTOGRAM_NAMES:
        p = {**HISTOGRAM_DEFAULTS, **spec.hyperparameters}
        return HistogramBoosting(
            maxIter=int(p["max_iter"]),
            learningRate=float(p["learning_rate"]),
            maxLeafNodes=int(p["max_leaf_nodes"]),
            maxDepth=int(p["max_depth"] or 0),
            minSamplesLeaf=int(p["min_samples_leaf"]),
            l2=float(p["l2_regularization"]),
            maxBins=int(p["max_bins"]),
            **common,
        )
    if kind in _BOOSTING_NAMES:
        p = {**BOOSTING_DEFAULTS, **spec.hyperparameters}
        return GBTClassifier(
            maxIter=int(p["n_estimators"]),
            maxDepth=int(p["max_depth"]),
            stepSize=float(p["learning_rate"]),
            subsamplingRate=float(p["subsample"]),
            featureSubsetStrategy=str(p["max_features"]),
            seed=spec.seed,
            **common,
        )
    raise ValueError(f"unsupported model type: {spec.kind}")


def with_label(df: DataFrame, spec: ModelSpec) -> DataFrame:
    return df.withColumn("label", binary_target(F.col(spec.target), spec.positive).cast("double"))


def split_rows(typed_rows: DataFrame, spec: ModelSpec) -> DataFrame:
    """The rows with their ``split``, written.

    A split reads its rows three times: to count classes, to count slices, and to deal them. They are written before it, so what they
    are made from is read once.
    """
    rows = written(typed_rows, "split-input")
    return written(
        exact_split(rows, [spec.key], spec.target, spec.test_size, spec.val_size, spec.seed), "split"
    )


def fit_encoding(train: DataFrame, spec: ModelSpec) -> tuple[PipelineModel, DataFrame]:
    """Preparation fitted on the training rows, and their ``label`` and ``features``.

    Estimators read their rows several times before they keep them, so the encoded rows are written and encoded only once.
    """
    labelled = with_label(train, spec)
    prepared = fit_preprocessing(labelled, spec.numeric, spec.categorical)
    encoder = Pipeline(stages=encoding_stages(prepared)).fit(labelled)
    return encoder, written(encoder.transform(labelled).select("label", "features"), "encoded")


def fit_classifier(encoder: PipelineModel, encoded: DataFrame, spec: ModelSpec) -> PipelineModel:
    """Fit the classifier of a spec on encoded rows; the model takes rows that are not encoded."""
    return PipelineModel([*encoder.stages, classifier(spec, encoded.count()).fit(encoded)])


def fit(train: DataFrame, spec: ModelSpec) -> PipelineModel:
    """Fit preparation and classifier on the training rows only."""
    return fit_classifier(*fit_encoding(train, spec), spec)


def positive_probability(scored: DataFrame) -> DataFrame:
    """Add ``probability_1`` from the model's probability vector."""
    return scored.withColumn("probability_1", vector_to_array("probability")[1])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Input rows with predicted class and probability (four decimals)."""
    scored = positive_probability(model.transform(df))
    return scored.select(
        *df.columns,
        F.col("prediction").cast("int").alias("churn_prediction"),
        round4(F.col("probability_1")).alias("churn_probability"),
    )


def accuracy_by_split(model: PipelineModel, rows: DataFrame, spec: ModelSpec) -> DataFrame:
    """Accuracy and size of the train, validation and test parts, in one aggregation."""
    scored = predict(model, with_label(rows, spec))
    right = F.count(F.when(F.col("churn_prediction") == F.col("label").cast("int"), 1))
    return scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), round4(share(right, F.count(F.lit(1)))).alias("accuracy")
    )


@dataclass(frozen=True)
class TrainedModel:
    """A fitted pipeline with the split rows it was made from."""

    model: PipelineModel
    spec: ModelSpec
    rows: DataFrame

    def metadata(self) -> DataFrame:
        """One row: name, type, split sizes and accuracies, feature names."""
        names = F.array(*[F.lit(n) for n in feature_names(self.model)])
        parts = accuracy_by_split(self.model, self.rows, self.spec)

        def of(split: str, column: str):
            return F.max(F.when(F.col("split") == split, F.col(column)))

        return parts.agg(
            F.lit(self.spec.name).alias("model_name"),
            F.lit(self.spec.kind).alias("model_type"),
            *[of(s, "rows").alias(f"{s}_rows") for s in ("train", "val", "test")],
            *[of(s, "accuracy").alias(f"{s}_accuracy") for s in ("train", "val", "test")],
            F.first(names).alias("feature_names"),
        )


def train_model(typed_rows: DataFrame, spec: ModelSpec = ModelSpec()) -> TrainedModel:
    """Split, fit on the training part, and keep the split for evaluation.

    Iterative fits read the training rows many times, so the split rows are written
    to the shared folder first; the estimators cache their own feature vectors.
    """
    rows = split_rows(typed_rows, spec)
    model = fit(rows.filter(F.col("split") == "train"), spec)
    return TrainedModel(model, spec, rows)


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the assembled vector's slots, numerics first, then one per category."""
    indexers = [s for s in model.stages if isinstance(s, StringIndexerModel)]
    encoders = [s for s in model.stages if isinstance(s, OneHotEncoderModel)]
    assembler = next(s for s in model.stages if s.hasParam("inputCols") and s.hasParam("outputCol") and s.getOutputCol() == "features")
    names: list[str] = [c[: -len("_scaled")] for c in assembler.getInputCols() if c.endswith("_scaled")]
    if indexers and encoders:
        for column, labels in zip(indexers[0].getInputCols(), indexers[0].labelsArray):
            base = column[: -len("_filled")]
            names += [f"{base}_{label}" for label in labels]
    return names


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Coefficient, magnitude and odds ratio per feature, largest magnitude first.

    Tree models report their importance as coefficient and an odds ratio of 1.
    """
    fitted = model.stages[-1]
    linear = hasattr(fitted, "coefficients")
    weights = fitted.coefficients if linear else fitted.featureImportances
    rows = [(n, float(w)) for n, w in zip(feature_names(model), weights.toArray())]
    frame = df.sparkSession.createDataFrame(rows, "feature string, weight double")
    clipped = F.greatest(F.lit(-20.0), F.least(F.lit(20.0), F.col("weight")))
    return frame.select(
        "feature",
        round4(F.col("weight")).alias("coefficient"),
        round4(F.abs("weight")).alias("abs_coefficient"),
        round4(F.exp(clipped) if linear else F.lit(1.0)).alias("odds_ratio"),
    ).orderBy(F.col("abs_coefficient").desc(), "feature")


def importance_bars(importance: DataFrame, top: int = 15) -> DataFrame:
    """The longest bars of the importance chart."""
    return importance.orderBy(F.col("abs_coefficient").desc(), "feature").limit(top)

