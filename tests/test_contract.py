"""Contract checks, quality report and the batch gate."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import customer, customers
from riskspark.functions.parsing import charge_is_bad, charge_value
from riskspark.models.scoring import LogisticFormula
from riskspark.operators import contract as checks
from riskspark.operators.contract import CUSTOMER_CONTRACT, ContractViolation
from riskspark.operators.quality import missing_values, quality_report
from riskspark.plans.scoring_job import ScoringJob, run_batch_scoring

FORMULA = LogisticFormula(-1.0, {"tenure": -0.01}, {"Contract": {"Month-to-month": 1.0}})


def errors_of(frame, training=True):
    rows = checks.validation_errors(frame, CUSTOMER_CONTRACT, training).collect()
    return {(r["check_type"], r["column"]): r for r in rows}


def test_valid_customers_pass(spark):
    frame = customers(spark, [customer(i) for i in range(30)])
    typed, report, errors = checks.validate(frame, CUSTOMER_CONTRACT)
    row = report.first()
    assert row["is_valid"] and row["valid_rows"] == row["clean_rows"] == 30
    assert row["summary"] == "Validation PASSED for 30 row(s) against schema v1.0.0."
    assert errors.isEmpty() and dict(typed.dtypes)["TotalCharges"] == "double"


DEFECTS = [
    ({"customerID": "  "}, ("null_primary_key", "customerID"), 2),
    ({"customerID": None}, ("non_blank_id", "customerID"), 1),
    ({"Contract": "Weekly"}, ("isin", "Contract"), 1),
    ({"Contract": None}, ("not_nullable", "Contract"), 1),
    ({"SeniorCitizen": 2}, ("isin", "SeniorCitizen"), 1),
    ({"tenure": -1}, ("greater_than_or_equal_to", "tenure"), 1),
    ({"TotalCharges": "N/A"}, ("invalid_type_conversion", "TotalCharges"), 1),
    ({"TotalCharges": "-5"}, ("greater_than_or_equal_to", "TotalCharges"), 1),
    ({"Churn": "Maybe"}, ("isin", "Churn"), 1),
]


def test_each_defect_is_found(spark):
    rows = [customer(i, **changes) for i, (changes, _, _) in enumerate(DEFECTS)]
    frame = customers(spark, [*rows, customer(50)])
    found = errors_of(frame)
    for _, key, count in DEFECTS:
        assert found[key]["invalid_count"] == count, key
    with pytest.raises(ContractViolation) as failure:
        checks.validate(frame, CUSTOMER_CONTRACT)
    assert failure.value.report["clean_rows"] == 1


def test_duplicates_count_copies_and_members(spark):
    rows = [customer(1), customer(1), customer(1), customer(2), customer(2, tenure=9), customer(3)]
    found = errors_of(customers(spark, rows))
    assert found[("duplicate_rows", None)]["invalid_count"] == 2
    keys = found[("duplicate_primary_key", "customerID")]
    assert keys["invalid_count"] == 5
    assert keys["sample_invalid_values"] == ["CUST-0001", "CUST-0002"]


def test_one_key_holding_most_rows(spark):
    frame = customers(spark, [customer(7)] * 200 + [customer(i) for i in range(20, 40)]).repartition(8)
    found = errors_of(frame)
    assert found[("duplicate_rows", None)]["invalid_count"] == 199
    assert found[("duplicate_primary_key", "customerID")]["invalid_count"] == 200


def test_missing_and_unexpected_columns(spark):
    frame = customers(spark, [customer(1)]).drop("customerID", "gender").withColumn("extra", F.lit(1))
    found = errors_of(frame)
    assert ("missing_column", "customerID") in found
    assert ("column_in_dataframe", "gender") in found and ("column_in_schema", "extra") in found
    wrong = customers(spark, [customer(1)]).withColumn("tenure", F.lit(1.5))
    assert ("dtype", "tenure") in errors_of(wrong)


def test_target_is_optional_for_scoring(spark):
    frame = customers(spark, [customer(1)]).drop("Churn")
    assert ("column_in_dataframe", "Churn") in errors_of(frame, training=True)
    assert errors_of(frame, training=False) == {}


def test_valid_rows_subtract_error_records(spark):
    """A row with two failing cells lowers the valid rows by two."""
    frame = customers(spark, [customer(i) for i in range(5)] + [customer(9, Contract="x", tenure=-3)])
    report = checks.validation_report(frame, CUSTOMER_CONTRACT).first()
    assert (report["total_rows"], report["valid_rows"], report["clean_rows"]) == (6, 4, 5)
    found = checks.violations(frame, CUSTOMER_CONTRACT).collect()
    assert {(r["customerID"], r["column"], r["value"]) for r in found} == {("CUST-0009", "Contract", "x"), ("CUST-0009", "tenure", "-3")}


def test_samples_are_the_first_five(spark):
    frame = customers(spark, [customer(i, Contract=f"bad{9 - i}") for i in range(8)])
    row = errors_of(frame)[("isin", "Contract")]
    assert row["invalid_count"] == 8
    assert row["sample_invalid_values"] == ["bad2", "bad3", "bad4", "bad5", "bad6"]


def test_charge_text(spark):
    texts = ["12.5", " 7 ", "", "  ", None, "1e3", "1.0d", "NaN", "abc", "-3", ".5", "1_000", "0x10"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in rows.select(charge_value(F.col("t")), charge_is_bad(F.col("t"))).collect()]
    assert got == [
        (12.5, False), (7.0, False), (None, False), (None, False), (None, False), (1000.0, False),
        (None, True), (None, True), (None, True), (-3.0, False), (0.5, False), (1000.0, False), (None, True),
    ]


def test_quality_report(spark):
    good = quality_report(customers(spark, [customer(1), customer(2)]), CUSTOMER_CONTRACT).first()
    assert (good["accepted_records"], good["rejected_records"], good["rejection_rate"]) == (2, 0, 0.0)
    bad = customers(spark, [customer(1), customer(1, gender="x", Contract="y", tenure=-1, TotalCharges="zz")])
    row = quality_report(bad, CUSTOMER_CONTRACT).first()
    assert not row["is_valid"] and row["rejected_records"] > 0 and row["duplicate_primary_keys"] == 2
    blank = customers(spark, [customer(1, Contract=None), customer(2)])
    assert [tuple(r) for r in missing_values(blank).collect()] == [("Contract", 1, 0.5)]


def test_gate_scores_all_or_nothing(spark, tmp_path):
    job = ScoringJob(str(tmp_path / "scores"), str(tmp_path / "quarantine"))
    good = customers(spark, [customer(i) for i in range(40)])
    first = run_batch_scoring(spark, good, FORMULA, job, "b1").select("customerID", "churn_probability", "predicted_class")
    first = sorted(tuple(r) for r in first.collect())
    again = run_batch_scoring(spark, good, FORMULA, job, "b1").select("customerID", "churn_probability", "predicted_class")
    assert len(first) == 40 and sorted(tuple(r) for r in again.collect()) == first
    with pytest.raises(ContractViolation):
        run_batch_scoring(spark, customers(spark, [customer(1), customer(1)]), FORMULA, job, "b2")
    assert not (tmp_path / "scores" / "batch_id=b2").exists()
    assert spark.read.parquet(str(tmp_path / "quarantine" / "batch_id=b2" / "rows")).count() == 2
