"""Results as temporary views and the library's decisions as SQL functions, for users who write SQL text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

#: Name, parameters, result and body of each function; the same rules as in ``riskspark.functions``.
FUNCTIONS = (
    (
        "risk_decide",
        "probability DOUBLE, threshold DOUBLE",
        "INT",
        "CASE WHEN threshold BETWEEN 0 AND 1 THEN CAST(probability >= threshold AS INT) "
        "ELSE raise_error('decision threshold must lie in [0, 1]') END",
    ),
    (
        "risk_tenure_band",
        "tenure DOUBLE",
        "STRING",
        "CASE WHEN tenure <= 12 THEN '0-12 months' WHEN tenure <= 24 THEN '13-24 months' "
        "WHEN tenure <= 48 THEN '25-48 months' ELSE '49+ months' END",
    ),
    (
        "risk_charge_band",
        "charges DOUBLE",
        "STRING",
        "CASE WHEN charges < 35.0 THEN '< $35' WHEN charges <= 70.0 THEN '$35 - $70' ELSE '> $70' END",
    ),
    (
        "risk_charge_discrepancy",
        "tenure DOUBLE, monthly DOUBLE, total DOUBLE",
        "DOUBLE",
        "abs(total - tenure * monthly)",
    ),
    (
        "risk_drift_status",
        "psi DOUBLE",
        "STRING",
        "CASE WHEN psi >= 0.25 THEN 'significant_drift' WHEN psi >= 0.1 THEN 'moderate_drift' ELSE 'no_drift' END",
    ),
)


def register_functions(spark: SparkSession) -> list[str]:
    """Make the functions known to the session's SQL; they are expressions, not Python. Returns their names."""
    for name, parameters, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return [name for name, *_ in FUNCTIONS]


def register_results(spark: SparkSession, results: Mapping[str, DataFrame], prefix: str = "risk_") -> list[str]:
    """Make result tables known as temporary views ``risk_…``; returns their names. Nothing is computed yet."""
    register_functions(spark)
    for name, frame in results.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{name}" for name in results]
