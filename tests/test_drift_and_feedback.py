"""Drift, late outcomes, campaign effect, retraining advice."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from riskspark.operators.campaign import campaign_effect
from riskspark.operators.drift import DriftPolicy, detect_drift
from riskspark.operators.feedback import evaluate_matched, keep_last, match_outcomes, match_statistics
from riskspark.operators.retraining import RetrainingPolicy, retraining_decision

RNG = np.random.default_rng(42)


def numpy_psi(ref, cur, bins=10):
    edges = np.unique(np.percentile(ref, np.linspace(0, 100, bins + 1)))
    p = np.histogram(ref, edges)[0] / len(ref)
    q = np.histogram(cur, edges)[0] / len(cur)
    p, q = np.where(p == 0, 1e-4, p), np.where(q == 0, 1e-4, q)
    return round(max(0.0, float(np.sum((q - p) * np.log(q / p)))), 4)


def test_drift_equals_numpy(spark):
    n = 1_000
    ref = pd.DataFrame({
        "same": RNG.normal(50, 10, n), "moved": RNG.normal(50, 10, n), "few": RNG.integers(0, 3, n).astype(float),
        "flat": np.full(n, 3.0), "word": ["a"] * 700 + ["b"] * 300, "gone": ["x"] * n,
    })
    cur = pd.DataFrame({
        "same": RNG.normal(50, 10, n), "moved": RNG.normal(100, 10, n), "few": RNG.integers(0, 4, n).astype(float),
        "flat": np.full(n, 9.0), "word": ["a"] * 100 + ["b"] * 900, "gone": [None] * 500 + ["x"] * 500,
    })
    numeric, words = ["same", "moved", "few", "flat", "absent"], ["word", "gone"]
    features, report = detect_drift(spark.createDataFrame(cur), spark.createDataFrame(ref), numeric, words,
                                    DriftPolicy(ks_alpha=0.05, missing_rate_delta=0.05))
    rows = {r["feature"]: r for r in features.collect()}
    assert set(rows) == {"same", "moved", "few", "flat", "word", "gone"}
    for c in ("same", "moved", "few"):
        assert rows[c]["psi"] == pytest.approx(numpy_psi(ref[c], cur[c]), abs=1e-4)
    assert rows["flat"]["psi"] == 0.0 and rows["flat"]["ks_statistic"] == 1.0
    assert rows["same"]["drift_status"] == "no_drift" and rows["moved"]["drift_status"] == "significant_drift"
    assert rows["moved"]["ks_statistic"] > 0.5 and rows["moved"]["ks_p_value"] < 0.05 and rows["moved"]["ks_flag"]
    assert rows["word"]["psi"] > 0.25 and rows["word"]["ks_statistic"] is None
    assert (rows["gone"]["missing_rate_scoring"], rows["gone"]["missing_flag"]) == (0.5, True)
    total = report.first()
    assert total["overall_drift_status"] == "significant_drift"
    assert "moved" in total["drifted_features"] and total["reference_record_count"] == n


def test_table_against_itself(spark):
    same = spark.createDataFrame(pd.DataFrame({"v": RNG.normal(0, 1, 300), "w": ["a", "b", "c"] * 100}))
    _, report = detect_drift(same, same, ["v"], ["w"])
    row = report.first()
    assert (row["overall_drift_status"], row["drifted_features_count"], row["max_psi"]) == ("no_drift", 0, 0.0)
    with pytest.raises(ValueError):
        detect_drift(same, same, ["other"], [])


def predictions(spark):
    rows = [(f"C{i}", p, "2026-07-29") for i, p in enumerate([0.85, 0.15, 0.70, 0.30, 0.90])]
    return spark.createDataFrame(rows, "customerID string, churn_probability double, scoring_timestamp string")


def late(spark, rows):
    return spark.createDataFrame(rows, "customerID string, observed_churn string, observation_date string")


def test_matching_and_evaluation(spark):
    words = ["Yes", "no", " TRUE ", "No", "0"]
    labels = late(spark, [(f"C{i}", w, "2026-08-01") for i, w in enumerate(words)])
    matched = match_outcomes(predictions(spark), labels)
    assert [r["observed_churn"] for r in matched.orderBy("customerID").collect()] == [1, 0, 1, 0, 0]
    stats = match_statistics(predictions(spark), labels, matched).first()
    assert (stats["matched_records"], stats["unmatched_predictions"], stats["match_rate"]) == (5, 0, 1.0)
    row = evaluate_matched(matched, ["customerID"]).first()
    assert (row["sample_size"], row["observed_churn_prevalence"], row["num_targeted_customers"]) == (5, 0.4, 1)


def test_partial_match_and_duplicates(spark):
    labels = late(spark, [("C0", "Yes", "2026-08-01"), ("C0", "No", "2026-08-02"), ("C1", "No", "2026-08-01"), ("ZZ", "No", "2026-08-01")])
    twice = predictions(spark).unionByName(predictions(spark).filter("customerID = 'C0'"))
    matched = match_outcomes(twice, labels)
    assert {r["customerID"]: r["observed_churn"] for r in matched.collect()} == {"C0": 0, "C1": 0}
    stats = match_statistics(twice, labels, matched).first()
    assert (stats["total_historical_predictions"], stats["matched_records"], stats["unmatched_predictions"]) == (6, 2, 4)
    with pytest.raises(ValueError):
        match_outcomes(predictions(spark), labels.drop("observed_churn"))
    with pytest.raises(ValueError):
        match_outcomes(predictions(spark).drop("customerID"), labels)


def test_keep_last_with_one_hot_key(spark):
    rows = [("hot", i, f"v{i}") for i in range(500)] + [("cold", 1, None), ("null", None, "kept")]
    frame = spark.createDataFrame(rows, "k string, t int, v string").repartition(8)
    got = {r["k"]: (r["t"], r["v"]) for r in keep_last(frame, "k", ["t"]).collect()}
    assert got == {"hot": (499, "v499"), "cold": (1, None), "null": (None, "kept")}


def test_campaign(spark):
    rows = [(" Treatment", int(i < 10)) for i in range(50)] + [("HOLDOUT", int(i < 25)) for i in range(50)] + [("other", 1)]
    frame = spark.createDataFrame(rows, "treatment_group string, observed_churn int")
    r = campaign_effect(frame).first()
    assert (r["absolute_churn_reduction"], r["relative_churn_reduction_pct"]) == (0.3, 60.0)
    assert (r["estimated_incremental_retained_customers"], r["total_campaign_cost_usd"]) == (15.0, 500.0)
    assert (r["gross_retained_margin_usd"], r["net_campaign_value_usd"], r["campaign_roi_percent"]) == (7500.0, 7000.0, 1400.0)
    bare = campaign_effect(frame.drop("treatment_group")).first()
    assert not bare["campaign_data_available"] and bare["campaign_roi_percent"] is None
    empty = campaign_effect(frame.filter("treatment_group = 'HOLDOUT'")).first()
    assert not empty["campaign_data_available"] and empty["n_treatment"] == 0


@pytest.mark.parametrize(
    "pr_auc,brier,psi,rate,baseline,code,triggers",
    [
        (0.65, 0.12, 0.0, 1.0, 0.6437, "MAINTAIN_INCUMBENT", []),
        (0.60, 0.12, 0.0, 1.0, 0.75, "RETRAIN_RECOMMENDED", ["PR_AUC_DEGRADATION"]),
        (0.64, 0.22, 0.35, 1.0, 0.6437, "RETRAIN_RECOMMENDED", ["CALIBRATION_DEGRADATION", "FEATURE_DRIFT_ALERT"]),
        (0.64, 0.12, 0.35, 0.5, 0.6437, "MAINTAIN_INCUMBENT", ["FEATURE_DRIFT_ALERT", "DATA_QUALITY_ALERT"]),
    ],
)
def test_retraining_advice(spark, pr_auc, brier, psi, rate, baseline, code, triggers):
    row = retraining_decision(
        spark.createDataFrame([(pr_auc, brier)], "pr_auc double, brier_score double"),
        spark.createDataFrame([(psi, int(psi >= 0.25))], "max_psi double, drifted_features_count bigint"),
        spark.createDataFrame([(rate,)], "match_rate double"),
        RetrainingPolicy(baseline_pr_auc=baseline),
    ).first()
    assert (row["decision_code"], row["triggers_fired"]) == (code, triggers)
