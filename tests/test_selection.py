"""Champion and challenger fitted on one split."""

from __future__ import annotations

import pytest
from conftest import customer, customers
from pyspark.sql import functions as F

from riskspark.models import training
from riskspark.plans import selection


def test_models_on_the_same_features_share_one_encoding(spark, monkeypatch):
    rows = customers(spark, [customer(i) for i in range(120)] + [customer(3)])
    rows = rows.withColumn("TotalCharges", F.col("TotalCharges").cast("double"))
    read = spark.sparkContext.accumulator(0)

    def batches(found):
        for batch in found:
            read.add(batch.num_rows)
            yield batch

    fitted, prepare = [], training.fit_preprocessing
    monkeypatch.setattr(training, "fit_preprocessing", lambda *a: fitted.append(a[1:]) or prepare(*a))
    few = training.ModelSpec("few", numeric=("tenure",), hyperparameters={"max_iter": 5})
    models = [
        training.ModelSpec(hyperparameters={"max_iter": 5}),
        training.ModelSpec("boosted", "GradientBoosting", {"n_estimators": 3}),
    ]
    chosen = selection.run_selection(rows.mapInArrow(batches, rows.schema), *models)
    assert len(fitted) == 1
    # The rows come from their source once.
    assert read.value == 121
    scored = chosen.scored.toPandas()
    train = chosen.scored.filter("split = 'train'").select(*rows.columns)
    assert len(scored) == 121 and set(scored["split"]) == {"train", "val", "test"}
    for spec in models:
        alone = training.positive_probability(training.fit(train, spec).transform(chosen.scored))
        got = alone.agg(F.max(F.abs(F.col("probability_1") - F.col(f"score_{spec.name}")))).first()[0]
        assert got == pytest.approx(0, abs=1e-6)
    fitted.clear()
    selection.run_selection(rows, models[0], few)
    assert len(fitted) == 2


def test_encoded_rows_keep_what_is_known_of_their_features(spark):
    rows = customers(spark, [customer(i) for i in range(40)]).withColumn("TotalCharges", F.col("TotalCharges").cast("double"))
    spec = training.ModelSpec()
    encoder, encoded = training.fit_encoding(rows, spec)
    want = encoder.transform(training.with_label(rows, spec)).select("label", "features")
    assert encoded.schema["features"].metadata == want.schema["features"].metadata != {}
    assert sorted(map(str, encoded.collect())) == sorted(map(str, want.collect()))
