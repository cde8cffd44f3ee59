"""Late outcomes, campaign effect and retraining advice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.drift_checks import CATEGORICAL, FEATURES_CTE, NUMERIC, REPORT_SQL
from catalog.evaluation import ACCURACY, CURVE, F1, PR_AUC, PRECISION, RECALL, ROC_AUC, confusion_sql, r4, ratio
from catalog.registry import query
from catalog.standins import (
    FORMULA_SQL,
    PREDICTIONS_CTE,
    SNAPSHOT_CTE,
    SNAPSHOT_FORMULA,
    late_labels,
    order_halves,
    predictions,
    snapshot,
    table,
)
from riskspark.functions.bands import tenure_band
from riskspark.functions.decisions import decide
from riskspark.operators import drift as drift_ops
from riskspark.operators import campaign, feedback, retraining
from riskspark.operators.distribution import side_by_side
from riskspark.plans.review import Review, run_review

KEY = "doc_id"
PREDICTION_ORDER, LABEL_ORDER = ("scoring_order",), ("observation_order",)


@query(
    "i01_keep_last_events",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
FROM events) e WHERE rn = 1""",
)
def keep_last_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each user."""
    last = feedback.keep_last(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])
    return last.select("user_id", "event_id", "event_type", "value")


@query(
    "i01_keep_last_predictions",
    """SELECT n_chars, doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY n_chars ORDER BY doc_id DESC) AS rn FROM documents) d
WHERE rn = 1""",
)
def keep_last_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by length: exact copies share the key, the one with the highest id stays."""
    docs = table(spark, sf_dir, "documents").select("n_chars", "doc_id", "lang")
    return feedback.keep_last(docs, "n_chars", ["doc_id"])


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feedback.match_outcomes(
        predictions(spark, sf_dir), late_labels(spark, sf_dir), KEY, PREDICTION_ORDER, LABEL_ORDER
    )


@query(
    "i02_matched_outcomes",
    f"WITH {PREDICTIONS_CTE} SELECT * FROM predictions JOIN late USING (doc_id)",
)
def matched_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _matched(spark, sf_dir)


STATISTICS_SQL = """SELECT count(*) AS total_historical_predictions, (SELECT count(*) FROM late) AS total_delayed_labels_received,
  count(l.doc_id) AS matched_records, count(*) - count(l.doc_id) AS unmatched_predictions,
  round(count(l.doc_id)::double / count(*), 4) AS match_rate FROM predictions p LEFT JOIN late l USING (doc_id)"""


@query("i03_match_statistics", f"WITH {PREDICTIONS_CTE} {STATISTICS_SQL}")
def match_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feedback.match_statistics(
        predictions(spark, sf_dir), late_labels(spark, sf_dir), _matched(spark, sf_dir)
    )


EVALUATION_CTE = f"""{PREDICTIONS_CTE},
matched AS (SELECT 'all' AS scope, churn_probability AS p, observed_churn AS y_true, md5(cast(doc_id as varchar)) AS row_hash
  FROM predictions JOIN late USING (doc_id)),
{CURVE.format(k="scope", p="p", t="matched")},
rank_sums AS (SELECT {PR_AUC} AS pr_auc, {ROC_AUC} AS roc_auc FROM curve),
counts AS (SELECT count(*) AS sample_size, round(avg(y_true), 4) AS observed_churn_prevalence, {confusion_sql("p", "0.5")},
  round(avg((p - y_true) * (p - y_true)), 4) AS brier_score, cast(sum(y_true) as bigint) AS all_pos FROM matched),
ranked AS (SELECT *, row_number() OVER (ORDER BY p DESC, row_hash) AS rn,
  greatest(1, cast(round_even(count(*) OVER () * 0.1::double, 0) as bigint)) AS k FROM matched),
cap AS (SELECT max(k) AS k, cast(sum(CASE WHEN rn <= k THEN y_true ELSE 0 END) as bigint) AS captured, min(CASE WHEN rn <= k THEN p END) AS cut FROM ranked),
evaluation AS (SELECT sample_size, observed_churn_prevalence, pr_auc, roc_auc, {r4(PRECISION)} AS precision, {r4(RECALL)} AS recall,
  {r4(F1)} AS f1_score, {r4(ACCURACY)} AS accuracy, brier_score, 0.5::double AS threshold, tn, fp, fn, tp,
  0.1::double AS campaign_capacity_fraction, k AS num_targeted_customers, sample_size AS total_customers,
  {r4(ratio("captured", "k"))} AS precision_at_capacity, {r4(ratio("captured", "all_pos"))} AS recall_at_capacity,
  round(cut, 4) AS capacity_threshold, captured AS retained_churners_captured, all_pos AS total_actual_churners
  FROM rank_sums, counts, cap)"""


@query("i04_evaluate_matched", f"WITH {EVALUATION_CTE} SELECT * FROM evaluation")
def evaluate_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feedback.evaluate_matched(_matched(spark, sf_dir), [KEY])


# One score lies between the threshold and what rounding to four decimals would make of it.
OFF_GRID = "0.49996 + doc_id / 1e12"


@query(
    "i04_off_grid_scores",
    f"""WITH {PREDICTIONS_CTE} SELECT count(*) AS sample_size, cast(0 as bigint) AS tp, sum(observed_churn) AS fn FROM predictions JOIN late USING (doc_id)""",
)
def off_grid_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores just below the threshold stay below it: they are compared as stored."""
    rows = _matched(spark, sf_dir).withColumn("churn_probability", F.expr(OFF_GRID))
    return feedback.evaluate_matched(rows, [KEY]).select("sample_size", "tp", "fn")


@query(
    "i04_matched_calibration",
    f"""WITH {PREDICTIONS_CTE}, m AS (SELECT churn_probability AS p, observed_churn AS y FROM predictions JOIN late USING (doc_id)),
b AS (SELECT *, {' + '.join(f'cast(p > {i} * (1.0::double / 10) as int)' for i in range(1, 10))} AS bin FROM m)
SELECT bin, round(sum(y) / count(*), 4) AS prob_true, round(avg(p), 4) AS prob_pred, count(*) AS bin_count FROM b GROUP BY bin""",
)
def matched_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feedback.matched_calibration(_matched(spark, sf_dir))


# --- campaign on the snapshot -----------------------------------------------------

ARM_SQL = "CASE WHEN substr(md5(\"customerID\"), 1, 1) < '8' THEN ' Treated' ELSE 'HOLDOUT ' END"
OUTCOME_SQL = "CASE WHEN \"Churn\" = 'Yes' AND NOT (substr(md5(\"customerID\"), 1, 1) < '2') THEN 1 ELSE 0 END"
CAMPAIGN_CTE = f"""{SNAPSHOT_CTE},
trial AS (SELECT "customerID", {ARM_SQL} AS treatment_group, {OUTCOME_SQL} AS observed_churn FROM snapshot)"""


def campaign_sql(source: str) -> str:
    return f"""SELECT true AS campaign_data_available, sample_size, round(overall, 4) AS overall_churn_rate, nt AS n_treatment, nc AS n_control,
  ct AS treatment_churn_count, cc AS control_churn_count, round(rt, 4) AS treatment_churn_rate, round(rc, 4) AS control_churn_rate,
  round(rc - rt, 4) AS absolute_churn_reduction, round(CASE WHEN rc <> 0 THEN (rc - rt) / rc ELSE 0 END * 100, 2) AS relative_churn_reduction_pct,
  round((rc - rt) * nt, 2) AS estimated_incremental_retained_customers, round(nt * 10.0::double, 2) AS total_campaign_cost_usd,
  round((rc - rt) * nt * 500.0::double, 2) AS gross_retained_margin_usd,
  round((rc - rt) * nt * 500.0::double - nt * 10.0::double, 2) AS net_campaign_value_usd,
  round(((rc - rt) * nt * 500.0::double - nt * 10.0::double) / (nt * 10.0::double) * 100, 2) AS campaign_roi_percent
FROM (SELECT *, ct::double / nt AS rt, cc::double / nc AS rc FROM (SELECT count(*) AS sample_size, avg(observed_churn) AS overall,
  count(*) FILTER (WHERE lower(trim(treatment_group)) = 'treated') AS nt, count(*) FILTER (WHERE lower(trim(treatment_group)) = 'holdout') AS nc,
  cast(sum(observed_churn) FILTER (WHERE lower(trim(treatment_group)) = 'treated') as bigint) AS ct,
  cast(sum(observed_churn) FILTER (WHERE lower(trim(treatment_group)) = 'holdout') as bigint) AS cc FROM {source}) s) r"""


def _trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    digit = F.substring(F.md5("customerID"), 1, 1)
    return snapshot(spark, sf_dir).select(
        "customerID",
        F.when(digit < "8", " Treated").otherwise("HOLDOUT ").alias("treatment_group"),
        F.when((F.col("Churn") == "Yes") & ~(digit < "2"), 1).otherwise(0).alias("observed_churn"),
    )


@query("i05_campaign_effect", f"WITH {CAMPAIGN_CTE}, c AS ({campaign_sql('trial')}) SELECT n_treatment, n_control, "
       "treatment_churn_count, control_churn_count, treatment_churn_rate, control_churn_rate, absolute_churn_reduction, "
       "relative_churn_reduction_pct, estimated_incremental_retained_customers FROM c")
def campaign_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaign.campaign_effect(_trial(spark, sf_dir)).select(
        "n_treatment",
        "n_control",
        "treatment_churn_count",
        "control_churn_count",
        "treatment_churn_rate",
        "control_churn_rate",
        "absolute_churn_reduction",
        "relative_churn_reduction_pct",
        "estimated_incremental_retained_customers",
    )


@query("i06_campaign_money", f"WITH {CAMPAIGN_CTE} {campaign_sql('trial')}")
def campaign_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaign.campaign_effect(_trial(spark, sf_dir)).drop("assumptions_documented")


@query(
    "i07_campaign_without_arms",
    f"""WITH {CAMPAIGN_CTE} SELECT false AS campaign_data_available, count(*) AS sample_size, round(avg(observed_churn), 4) AS overall_churn_rate,
  cast(NULL as double) AS campaign_roi_percent FROM trial""",
)
def campaign_without_arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaign.campaign_effect(_trial(spark, sf_dir).drop("treatment_group")).select(
        "campaign_data_available", "sample_size", "overall_churn_rate", "campaign_roi_percent"
    )


# --- retraining advice ------------------------------------------------------------

DECISION_SQL = """SELECT (degraded OR (drifted AND miscalibrated)) AS retrain_recommended,
  CASE WHEN degraded OR (drifted AND miscalibrated) THEN 'RETRAIN_RECOMMENDED' ELSE 'MAINTAIN_INCUMBENT' END AS decision_code,
  0.6437::double AS baseline_pr_auc, round(pr_auc, 4) AS delayed_label_pr_auc, round(pr_auc - 0.6437::double, 4) AS pr_auc_delta,
  0.05::double AS pr_auc_drop_threshold, round(brier_score, 4) AS brier_score, 0.2::double AS brier_score_max, round(max_psi, 4) AS max_psi,
  0.25::double AS psi_alert_threshold, round(match_rate, 4) AS match_rate, 0.8::double AS min_match_rate,
  concat_ws('|', CASE WHEN degraded THEN 'PR_AUC_DEGRADATION' END, CASE WHEN miscalibrated THEN 'CALIBRATION_DEGRADATION' END,
    CASE WHEN drifted THEN 'FEATURE_DRIFT_ALERT' END, CASE WHEN match_rate < 0.8 THEN 'DATA_QUALITY_ALERT' END) AS triggers_fired,
  drifted_features,
  round(CASE WHEN degraded THEN round(0.6437::double - pr_auc, 4) ELSE 0 END + CASE WHEN miscalibrated THEN round(brier_score, 4) ELSE 0 END
    + CASE WHEN drifted THEN round(max_psi, 4) ELSE 0 END + CASE WHEN match_rate < 0.8 THEN round(match_rate, 4) ELSE 0 END, 4)::double AS observed_sum,
  round(CASE WHEN degraded THEN 0.05 ELSE 0 END + CASE WHEN miscalibrated THEN 0.2 ELSE 0 END + CASE WHEN drifted THEN 0.25 ELSE 0 END
    + CASE WHEN match_rate < 0.8 THEN 0.8 ELSE 0 END, 4)::double AS limit_sum
FROM (SELECT *, 0.6437::double - pr_auc > 0.05 AS degraded, brier_score > 0.2 AS miscalibrated,
  max_psi >= 0.25 OR drifted_features_count > 0 AS drifted FROM evaluation, statistics, drift) x"""


def _drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = order_halves(spark, sf_dir)
    return drift_ops.detect_drift(current, reference, NUMERIC, CATEGORICAL)[1]


def _shown(decision: DataFrame) -> DataFrame:
    """Lists as text, and what the reasons say as sums."""
    def total(field: str):
        return F.round(F.aggregate("reasons", F.lit(0.0), lambda sum, r: sum + r[field]), 4)

    return decision.withColumns(
        {
            "triggers_fired": F.array_join("triggers_fired", "|"),
            "drifted_features": F.array_join("drifted_features", "|"),
            "observed_sum": total("observed"),
            "limit_sum": total("limit"),
        }
    ).drop("reasons")


@query(
    "i08_retraining_triggers",
    f"""WITH {EVALUATION_CTE}, statistics AS ({STATISTICS_SQL}), {FEATURES_CTE}, drift AS ({REPORT_SQL}) {DECISION_SQL}""",
)
def retraining_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = _matched(spark, sf_dir)
    evaluation = feedback.evaluate_matched(matched, [KEY])
    statistics = feedback.match_statistics(predictions(spark, sf_dir), late_labels(spark, sf_dir), matched)
    return _shown(retraining.retraining_decision(evaluation, _drift(spark, sf_dir), statistics))


# Baseline 0.95 against the toxic flag as outcome: the advice turns to retraining.
@query(
    "i09_recommendation",
    f"""WITH {PREDICTIONS_CTE}, matched AS (SELECT 'all' AS scope, churn_probability AS p, toxic AS y_true FROM predictions JOIN late USING (doc_id)),
{CURVE.format(k="scope", p="p", t="matched")}, e AS (SELECT {PR_AUC} AS pr_auc FROM curve)
SELECT 0.95::double - pr_auc > 0.05 AS retrain_recommended,
  CASE WHEN 0.95::double - pr_auc > 0.05 THEN 'RETRAIN_RECOMMENDED' ELSE 'MAINTAIN_INCUMBENT' END AS decision_code,
  round(pr_auc - 0.95::double, 4) AS pr_auc_delta FROM e""",
)
def recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    evaluation = feedback.evaluate_matched(_matched(spark, sf_dir), [KEY], outcome="toxic")
    policy = retraining.RetrainingPolicy(baseline_pr_auc=0.95)
    return retraining.retraining_decision(evaluation, policy=policy).select(
        "retrain_recommended", "decision_code", "pr_auc_delta"
    )


# --- whole review on the scored snapshot ------------------------------------------

REVIEW_CTE = f"""{SNAPSHOT_CTE},
scored_customers AS (SELECT "customerID", round({FORMULA_SQL}, 4) AS churn_probability FROM snapshot),
outcomes AS (SELECT "customerID", {ARM_SQL} AS treatment_group, {OUTCOME_SQL} AS observed_churn FROM snapshot WHERE tenure >= 24)"""


def _review(spark: SparkSession, sf_dir: str) -> Review:
    rows = snapshot(spark, sf_dir)
    p = SNAPSHOT_FORMULA.probability()
    scores = rows.select(
        "customerID",
        F.round(p, 4).alias("churn_probability"),
        decide(p, 0.5).alias("predicted_class"),
        tenure_band(F.col("tenure")).alias("band"),
    )
    seen = _trial(spark, sf_dir).join(rows.filter(F.col("tenure") >= 24).select("customerID"), "customerID")
    return run_review(
        scores,
        seen,
        "customerID",
        ("churn_probability",),
        ("observed_churn",),
        _drift(spark, sf_dir),
    )


@query(
    "i10_post_deployment_review",
    f"""WITH {REVIEW_CTE}, matched AS (SELECT 'all' AS scope, churn_probability AS p, observed_churn AS y_true, treatment_group, observed_churn
  FROM scored_customers JOIN outcomes USING ("customerID")),
{CURVE.format(k="scope", p="p", t="matched")}, rank_sums AS (SELECT {PR_AUC} AS pr_auc FROM curve),
b AS (SELECT count(*) AS matched_records, round(avg((p - y_true) * (p - y_true)), 4) AS brier_score FROM matched),
c AS ({campaign_sql("matched")}), {FEATURES_CTE}, drift AS ({REPORT_SQL}),
statistics AS (SELECT round(matched_records::double / (SELECT count(*) FROM scored_customers), 4) AS match_rate FROM b),
evaluation AS (SELECT pr_auc, brier_score FROM rank_sums, b), decision AS ({DECISION_SQL})
SELECT decision_code, triggers_fired, delayed_label_pr_auc, brier_score, max_psi, match_rate, n_treatment, n_control, campaign_roi_percent FROM decision, c""",
)
def post_deployment_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    review = _review(spark, sf_dir)
    advice = _shown(review.decision).select(
        "decision_code", "triggers_fired", "delayed_label_pr_auc", "brier_score", "max_psi", "match_rate"
    )
    effect = review.campaign.select("n_treatment", "n_control", "campaign_roi_percent")
    return side_by_side(advice, effect)
