"""SQL functions and views of results, and the sketch in front of the uniqueness check."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskspark.functions import bands, decisions
from riskspark.operators import profile
from riskspark.operators.drift import status
from riskspark.plans.sql_surface import FUNCTIONS, register_functions, register_results


def test_sql_functions_equal_the_column_functions(spark):
    assert register_functions(spark) == [name for name, *_ in FUNCTIONS] == register_functions(spark)
    values = [None, -1.0, 0.0, 0.0999, 0.1, 0.25, 0.4, 1.0, 12.0, 12.5, 24.0, 35.0, 48.0, 70.0, 70.5, 1e9]
    rows = spark.createDataFrame([(v, 3.0 * (v or 0)) for v in values], "v double, w double")
    v, w = F.col("v"), F.col("w")
    pairs = [
        ("risk_decide(v, 0.4)", decisions.decide(v, 0.4)),
        ("risk_tenure_band(v)", bands.tenure_band(v)),
        ("risk_charge_band(v)", bands.charge_band(v)),
        ("risk_charge_discrepancy(v, w, w)", bands.charge_discrepancy(v, w, w)),
        ("risk_drift_status(v)", status(v)),
    ]
    for text, column in pairs:
        got = rows.selectExpr(f"{text} AS x").collect()
        assert [r["x"] for r in got] == [r["x"] for r in rows.select(column.alias("x")).collect()], text
    with pytest.raises(Exception, match="threshold"):
        rows.selectExpr("risk_decide(w, 1.5)").collect()


def test_results_are_views(spark):
    assert register_results(spark, {"some": spark.range(3)}) == ["risk_some"]
    assert spark.sql("SELECT sum(risk_decide(id / 2.0D, 0.5D)) AS n FROM risk_some").first()["n"] == 2


def test_unique_keys(spark):
    unique = spark.range(20_000).withColumn("k", F.concat(F.lit("key"), "id"))
    once = unique.union(unique.limit(1))
    often = unique.withColumn("k", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("k")))
    missing = unique.withColumn("k", F.when(F.col("id") > 0, F.col("k")))
    for df, want, by_sketch in ((unique, True, False), (once, False, False), (often, False, True), (missing, False, True)):
        assert profile.keys_repeat_for_sure(df, "k") is by_sketch
        answer = profile.has_unique_ids(df, "k")
        assert answer.first()["customer_id_unique"] is want
        # Decided by the sketch, the answer's plan reads no keys.
        plan = answer._jdf.queryExecution().optimizedPlan().toString()
        assert ("Aggregate" in plan) is not by_sketch
    assert profile.has_unique_ids(unique.limit(0), "k").first()["customer_id_unique"] is True
