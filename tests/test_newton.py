"""Logistic regression by Newton steps."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import customer, customers
from riskspark.models import newton, training
from riskspark.operators.contract import CUSTOMER_CONTRACT, typed


def test_the_fit_is_stationary_and_equals_the_library(spark):
    rows = typed(customers(spark, [customer(i, Churn="Yes" if i % 3 == 0 or i % 7 == 0 else "No") for i in range(120)]), CUSTOMER_CONTRACT)
    model = training.fit(rows, training.ModelSpec())
    features = model.transform(training.with_label(rows, training.ModelSpec()))
    width = model.stages[-1].numFeatures
    flat = features.select("label", *[vector_to_array("features")[i].alias(f"x{i}") for i in range(width)]).cache()
    fitted = newton.fit_logistic(flat, [f"x{i}" for i in range(width)], "label")
    assert fitted.steps < 15 and fitted.change <= 1e-9
    assert fitted.weights == pytest.approx(model.stages[-1].coefficients.toArray(), abs=2e-3)
    data = flat.toPandas()
    x, y = data.drop(columns="label").to_numpy(), data["label"].to_numpy()
    p = 1 / (1 + np.exp(-(x @ fitted.weights + fitted.intercept)))
    assert np.abs(x.T @ (p - y) + fitted.weights).max() < 1e-8 and abs((p - y).sum()) < 1e-8


def test_missing_values_parted_classes_and_no_rows(spark):
    rows = spark.createDataFrame([(float(i), int(i > 9), None if i == 3 else 1.0) for i in range(20)], "a double, y int, b double")
    fitted = newton.fit_logistic(rows.withColumn("b", F.coalesce("b", F.lit(1.0))), ["a", "b"], "y", C=10.0)
    assert fitted.steps < 50 and fitted.weights[0] > 0
    assert newton.fit_logistic(rows, ["a", "b"], "y").weights[0] == pytest.approx(
        newton.fit_logistic(rows.where("b IS NOT NULL"), ["a", "b"], "y").weights[0]
    )
    shown = {r["feature"]: r for r in fitted.frame(spark).collect()}
    assert set(shown) == {"a", "b", "(intercept)"} and shown["a"]["odds_ratio"] == pytest.approx(np.exp(fitted.weights[0]))
    one = newton.fit_logistic(rows.withColumn("y", F.lit(1)), ["a"], "y")
    assert np.isfinite(one.weights).all()
