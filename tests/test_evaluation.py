"""Score-table metrics against hand values and brute force."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from conftest import scores
from riskspark.operators import calibration, capacity, classification, ranking, segments
from riskspark.operators.scores import by_dimension, score_table
from riskspark.operators.suite import acceptance_gates, compare_models, decision_record, evaluate_suite


def one(df):
    return df.first().asDict()


@pytest.mark.parametrize("decimals", [None, 4])
def test_perfect_ranking(spark, decimals):
    table = score_table(scores(spark, [0, 0, 1, 1], [0.1, 0.4, 0.6, 0.8]), decimals=decimals)
    row = one(classification.binary_metrics(table, 0.5))
    assert (row["pr_auc"], row["roc_auc"], row["precision"], row["recall"]) == (1, 1, 1, 1)
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (2, 0, 0, 2)
    low, high = (one(classification.threshold_metrics(table, t)) for t in (0.35, 0.7))
    assert (low["precision"], high["recall"]) == (0.6667, 0.5)


@pytest.mark.parametrize("decimals", [None, 4])
def test_tied_scores(spark, decimals):
    table = score_table(scores(spark, [0, 0, 1, 1, 0, 1], [0.1, 0.4, 0.6, 0.8, 0.6, 0.2]), decimals=decimals)
    assert one(ranking.ranking_metrics(table)) == {"pr_auc": 0.7556, "roc_auc": 0.7222}


def test_single_class_has_no_auc(spark):
    table = score_table(scores(spark, [1, 1, 1], [0.8, 0.9, 0.7]))
    assert one(ranking.ranking_metrics(table)) == {"pr_auc": None, "roc_auc": None}


def brute(y, p):
    order = np.argsort(-p, kind="stable")
    y, p = y[order], p[order]
    ap = roc = tp = seen = 0.0
    for s in dict.fromkeys(p):
        pos, n = y[p == s].sum(), (p == s).sum()
        tp, seen = tp + pos, seen + n
        ap += pos / y.sum() * tp / seen
        roc += (n - pos) * (tp - pos / 2)
    return round(ap, 4), round(roc / (y.sum() * (len(y) - y.sum())), 4)


@pytest.mark.parametrize("digits", [2, 12])
def test_ranking_equals_brute_force_in_any_partitioning(spark, digits):
    rng = np.random.default_rng(digits)
    y = rng.integers(0, 2, 500)
    p = np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1).round(digits)
    rows = scores(spark, y, p)
    for parts in (1, 7, 64):
        got = one(ranking.ranking_metrics(score_table(rows.repartition(parts))))
        assert (got["pr_auc"], got["roc_auc"]) == pytest.approx(brute(y, p), abs=1e-4)


def test_curve_points_and_report(spark):
    table = score_table(scores(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8]))
    roc = sorted((r["fpr"], r["tpr"]) for r in ranking.roc_points(table).collect())
    assert roc == [(0.0, 0.5), (0.5, 0.5), (0.5, 1.0), (1.0, 1.0)]
    pr = {r["threshold"]: (r["precision"], r["recall"], r["no_skill"]) for r in ranking.precision_recall_points(table).collect()}
    assert pr[0.35] == (0.6667, 1.0, 0.5)
    report = {r["label"]: r for r in classification.classification_report(table, 0.5).collect()}
    assert set(report) == {"No Churn", "Churn", "accuracy", "macro avg", "weighted avg"}
    assert (report["Churn"]["precision"], report["Churn"]["recall"], report["Churn"]["support"]) == (1.0, 0.5, 2)
    assert report["accuracy"]["f1_score"] == 0.75


def test_threshold_sweep_defaults(spark):
    table = score_table(scores(spark, [0, 0, 1, 1], [0.1, 0.4, 0.6, 0.8]))
    rows = classification.threshold_sweep(table).orderBy("threshold").collect()
    assert [r["threshold"] for r in rows] == [round(0.05 * i, 2) for i in range(1, 20)]
    assert all(r["tp"] + r["fp"] + r["tn"] + r["fn"] == 4 for r in rows)
    with pytest.raises(ValueError):
        classification.threshold_sweep(table, [1.5])


def test_calibration_bins(spark):
    y, p = [0] * 4 + [1] * 4, [0.1, 0.2, 0.3, 0.4, 0.6, 0.7, 0.8, 0.9]
    table = score_table(scores(spark, y, p))
    assert one(classification.brier_score(table))["brier_score"] == 0.075
    uniform = calibration.calibration_uniform(table, 5).collect()
    # 0.6 lies in the bin it closes, except where the edge is a hair above it.
    assert sum(r["bin_count"] for r in uniform) == 8 and len(uniform) == 5
    quantile = {r["bin"]: r["bin_count"] for r in calibration.calibration_quantile(table, 4).collect()}
    edges = np.quantile(p, [0.25, 0.5, 0.75])
    want = np.bincount(np.searchsorted(edges, p, side="left"), minlength=4)
    assert [quantile.get(i, 0) for i in range(4)] == want.tolist()


TEN = ([0] * 8 + [1, 1], [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.85, 0.95])


@pytest.mark.parametrize("fraction,n,captured,cut", [(0.1, 1, 1, 0.95), (0.5, 5, 2, 0.6), (1.0, 10, 2, 0.1), (0.01, 1, 1, 0.95), (0.25, 2, 2, 0.85)])
def test_capacity_line(spark, fraction, n, captured, cut):
    row = one(capacity.capacity_metrics(scores(spark, *TEN), fraction, ["id"]))
    assert (row["num_targeted_customers"], row["retained_churners_captured"], row["capacity_threshold"]) == (n, captured, cut)
    assert row["precision_at_capacity"] == round(captured / n, 4)


@pytest.mark.parametrize("fraction", [0.0, 1.5, -0.1])
def test_capacity_fraction_is_checked(spark, fraction):
    with pytest.raises(ValueError):
        capacity.capacity_metrics(scores(spark, *TEN), fraction, ["id"])


@pytest.mark.parametrize("decimals", [None, 4])
def test_ties_at_the_line_are_dealt_by_id(spark, decimals):
    """Two thirds of the rows share one score, so the line falls among them."""
    y = [int(i % 5 == 0) for i in range(900)]
    p = [0.5 if i % 3 else 0.9 for i in range(900)]
    rows = scores(spark, y, p).repartition(6)
    order = sorted(range(900), key=lambda i: (-p[i], hashlib.md5(str(i).encode()).hexdigest()))
    want = order[:540]
    got = capacity.worklist(rows, 0.6, ["id"], decimals=decimals)
    assert sorted(r["id"] for r in got.collect()) == sorted(want)
    row = one(capacity.capacity_metrics(rows, 0.6, ["id"], decimals=decimals))
    assert row["retained_churners_captured"] == sum(y[i] for i in want)


def test_segments_and_fairness(spark):
    rows = spark.createDataFrame(
        [
            (0, 1, 0.7, "Female", 0, "Month-to-month"),
            (1, 0, 0.2, "Male", 1, "Month-to-month"),
            (2, 1, 0.8, "Female", 1, "One year"),
            (3, 0, 0.3, "Male", 0, "One year"),
            (4, 0, 0.1, "Female", 0, None),
            (5, 0, 0.4, "Male", 1, "Two year"),
        ],
        "id int, y_true int, y_prob double, gender string, SeniorCitizen int, Contract string",
    )
    seg = {r["value"]: r for r in segments.segment_metrics(by_dimension(rows, ["Contract"]), 0.5, 0.65).collect()}
    assert set(seg) == {"Month-to-month", "One year", "Two year"}
    assert (seg["Two year"]["pr_auc"], seg["Two year"]["f1_score"]) == (None, 0.0)
    assert seg["One year"]["precision_at_capacity"] == 1.0
    groups = segments.fairness_metrics(by_dimension(rows, ["gender", "SeniorCitizen"]), 0.5)
    female = groups.filter("value = 'Female'").first()
    assert (female["count"], female["churn_count"], female["selection_rate"], female["tpr"]) == (3, 2, 0.6667, 1.0)
    gaps = {r["dimension"]: r for r in segments.fairness_disparities(groups).collect()}
    assert gaps["gender"]["demographic_parity_difference"] == 0.6667
    assert gaps["gender"]["demographic_parity_ratio"] == 0.0
    assert set(gaps) == {"gender", "SeniorCitizen"}


def test_challenger_needs_every_gate(spark):
    rng = np.random.default_rng(3)
    n = 600
    y = rng.integers(0, 2, n)
    rows = [
        (i, int(y[i]), float(np.clip(0.5 + 0.1 * (y[i] - 0.5) + rng.normal(0, 0.2), 0, 1)),
         float(np.clip(0.5 + 0.6 * (y[i] - 0.5) + rng.normal(0, 0.1), 0, 1)),
         "val" if i % 2 else "test", "Female" if i % 3 else "Male", "a" if i % 4 else "b")
        for i in range(n)
    ]
    frame = spark.createDataFrame(rows, "id int, y_true int, old double, new double, split string, gender string, seg string")
    result = evaluate_suite(frame, {"old": "old", "new": "new"}, ["id"], segment_dimensions=["seg"], sensitive_dimensions=["gender"])
    comparison = compare_models(result, "old", "new")
    gates = one(acceptance_gates(comparison))
    assert gates["selection_split"] == "val" and gates["pr_auc_gate_passed"] and gates["calibration_gate_passed"]
    record = one(decision_record(result, comparison, "old", "new"))
    assert record["selected_model_name"] == ("new" if gates["all_gates_passed"] else "old")
    assert '"evaluation_split":"test"' in record["record"]
    same = evaluate_suite(frame, {"old": "old", "new": "old"}, ["id"], segment_dimensions=["seg"], sensitive_dimensions=["gender"])
    kept = one(acceptance_gates(compare_models(same, "old", "new")))
    assert not kept["all_gates_passed"] and kept["pr_auc_diff"] == 0.0


def test_rows_without_label_or_score_are_left_out(spark):
    from riskspark.operators.classification import binary_metrics
    from riskspark.operators.scores import score_table, skipped_rows

    rows = spark.createDataFrame(
        [(1, 0.9), (None, 0.8), (0, None), (0, 0.2), (1, float("nan"))], "y_true int, y_prob double"
    )
    r = binary_metrics(score_table(rows)).first()
    assert (r["tp"], r["tn"], r["fp"], r["fn"], r["roc_auc"], r["accuracy"]) == (1, 1, 0, 0, 1.0, 1.0)
    assert tuple(skipped_rows(rows).first()) == (5, 3)
