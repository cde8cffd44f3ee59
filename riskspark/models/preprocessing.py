"""Feature preparation fitted on the training part: impute, standardise, one-hot."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.distribution import exact_quantiles, small, unpivot

# Features of the customer models and the columns never used as features.
NUMERIC_FEATURES = ("tenure", "MonthlyCharges", "TotalCharges")
CATEGORICAL_FEATURES = (
    "Partner",
    "Dependents",
    "PhoneService",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
    "Contract",
    "PaperlessBilling",
    "PaymentMethod",
)
EXCLUDED_FEATURES = ("customerID", "gender", "SeniorCitizen")


def feature_columns(columns: Sequence[str], target: str, excluded: Sequence[str] = EXCLUDED_FEATURES) -> list[str]:
    """Columns that may be model inputs: no id, no sensitive attribute, no target."""
    return [c for c in columns if c != target and c not in excluded]


def numeric_constants(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per feature: exact median, then mean and population deviation after imputing it."""
    long = unpivot(train, columns)
    medians = exact_quantiles(long, ["feature"], "value", [0.5], out="q").select(
        "feature", F.col("q")[0].alias("median")
    )
    # A feature without any value has no median and is imputed with 0.
    filled = long.join(small(medians, len(columns)), "feature", "left").withColumn(
        "filled", F.coalesce("value", "median", F.lit(0.0))
    )
    return filled.groupBy("feature").agg(
        F.coalesce(F.max("median"), F.lit(0.0)).alias("median"),
        F.avg("filled").alias("mean"),
        F.stddev_pop("filled").alias("std"),
    )


def modes(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent category per feature, the smallest one on ties."""
    counts = (
        unpivot(train, columns, value="category", as_type="string")
        .filter(F.col("category").isNotNull())
        .groupBy("feature", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.groupBy("feature").agg(
        F.min_by("category", F.struct(-F.col("n"), F.col("category"))).alias("mode")
    )


def categories(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Known categories per feature with their one-hot position in alphabetical order.

    The number of categories is bounded by the closed domains of the contract.
    """
    seen = (
        unpivot(train, columns, value="category", as_type="string")
        .filter(F.col("category").isNotNull())
        .groupBy("feature", "category")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    listed = seen.groupBy("feature").agg(F.array_sort(F.collect_list("category")).alias("_all"))
    return listed.select("feature", F.posexplode("_all").alias("position", "category"))


@dataclass(frozen=True)
class Preprocessing:
    """Constants of one fit; a few numbers per feature."""

    numeric: dict[str, tuple[float, float, float]]
    categorical: dict[str, str]


def fit_preprocessing(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> Preprocessing:
    """Read the fitted constants: one row per feature comes to the driver."""
    numbers = {
        r["feature"]: (r["median"], r["mean"], r["std"] or 1.0)
        for r in numeric_constants(train, numeric).toLocalIterator()
    } if numeric else {}
    words = {r["feature"]: r["mode"] for r in modes(train, categorical).toLocalIterator()} if categorical else {}
    return Preprocessing(
        {c: numbers[c] for c in numeric}, {c: words.get(c, "") for c in categorical}
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def scaled_name(column: str) -> str:
    return f"{column}_scaled"


def filled_name(column: str) -> str:
    return f"{column}_filled"


def fill_and_scale(fitted: Preprocessing) -> SQLTransformer:
    """Imputation and scaling as a persistable projection, compiled with the rest of the plan."""
    parts = [
        f"(coalesce(nanvl(double(`{c}`), double(null)), {median!r}D) - ({mean!r}D)) / {std!r}D AS `{scaled_name(c)}`"
        for c, (median, mean, std) in fitted.numeric.items()
    ]
    parts += [
        f"coalesce(string(`{c}`), {_quoted(mode)}) AS `{filled_name(c)}`"
        for c, mode in fitted.categorical.items()
    ]
    return SQLTransformer(statement="SELECT *, " + ", ".join(parts) + " FROM __THIS__")


def encoding_stages(fitted: Preprocessing) -> list[Transformer]:
    """Index, one-hot and assemble stages; an unknown category gives an all-zero block."""
    stages: list = [fill_and_scale(fitted)]
    words = list(fitted.categorical)
    if words:
        indexed = [f"{c}_index" for c in words]
        encoded = [f"{c}_onehot" for c in words]
        stages += [
            StringIndexer(
                inputCols=[filled_name(c) for c in words],
                outputCols=indexed,
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            ),
            # 'keep' adds one index for unknowns and dropLast removes exactly that one.
            OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        ]
    inputs = [scaled_name(c) for c in fitted.numeric] + [f"{c}_onehot" for c in words]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    return stages

