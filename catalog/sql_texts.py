"""Queries written as SQL text over registered results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.drift_checks import CATEGORICAL, FEATURES_CTE, NUMERIC
from catalog.model_checks import KEY, SCORES_SQL, score_snapshot
from catalog.registry import query
from catalog.standins import SNAPSHOT_CTE, order_halves, snapshot, table
from riskspark.operators import drift, monitoring
from riskspark.plans.sql_surface import register_results

_TENURE = "CASE WHEN tenure <= 12 THEN '0-12 months' WHEN tenure <= 24 THEN '13-24 months' WHEN tenure <= 48 THEN '25-48 months' ELSE '49+ months' END"
_CHARGES = "CASE WHEN \"MonthlyCharges\" < 35 THEN '< $35' WHEN \"MonthlyCharges\" <= 70 THEN '$35 - $70' ELSE '> $70' END"


@query(
    "l01_decisions_by_band",
    f"""WITH {SNAPSHOT_CTE}, scores AS ({SCORES_SQL})
SELECT {_TENURE} AS tenure_band, {_CHARGES} AS charge_band, count(*) AS customers,
  cast(sum(CASE WHEN churn_probability >= 0.3 THEN 1 ELSE 0 END) as bigint) AS targeted, round(avg(churn_probability), 4) AS mean_probability
FROM scores JOIN snapshot USING ("customerID") GROUP BY 1, 2""",
)
def decisions_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_results(spark, {"scores": score_snapshot(spark, sf_dir), "customers": snapshot(spark, sf_dir)})
    return spark.sql(
        f"""SELECT risk_tenure_band(tenure) AS tenure_band, risk_charge_band(MonthlyCharges) AS charge_band, count(*) AS customers,
          sum(risk_decide(churn_probability, 0.3)) AS targeted, round(avg(churn_probability), 4) AS mean_probability
        FROM risk_scores JOIN risk_customers USING ({KEY}) GROUP BY ALL"""
    )


@query(
    "l02_features_by_status",
    f"""WITH {FEATURES_CTE} SELECT drift_status, feature_type, count(*) AS features, max(psi) AS max_psi FROM features GROUP BY 1, 2""",
)
def features_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = order_halves(spark, sf_dir)
    register_results(spark, {"features": drift.feature_drift(current, reference, NUMERIC, CATEGORICAL)})
    return spark.sql(
        """SELECT risk_drift_status(psi) AS drift_status, feature_type, count(*) AS features, max(psi) AS max_psi
        FROM risk_features GROUP BY ALL"""
    )


@query(
    "l03_worst_windows",
    """WITH w AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, count(*) FILTER (WHERE event_type = 'error') AS failures, count(*) AS requests FROM events GROUP BY 1)
SELECT cast(window_start as date) AS day, count(*) AS windows, max(round(failures::double / requests, 4)) AS worst, cast(sum(failures) as bigint) AS failures
FROM w GROUP BY 1 HAVING sum(failures) > 0""",
)
def worst_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = monitoring.error_rates(table(spark, sf_dir, "events"), "ts", F.col("event_type") == "error")
    register_results(spark, {"error_rates": rates})
    return spark.sql(
        """SELECT CAST(window_start AS DATE) AS day, count(*) AS windows, max(error_rate) AS worst, sum(failures) AS failures
        FROM risk_error_rates GROUP BY ALL HAVING sum(failures) > 0"""
    )
