"""Contract checks over the raw text snapshot, the clean snapshot and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import query
from catalog.standins import LINE_CONTRACT, RAW_CTE, SNAPSHOT_CTE, raw_snapshot, snapshot, table
from riskspark.functions import bands, decisions, parsing
from riskspark.models.preprocessing import EXCLUDED_FEATURES, feature_columns
from riskspark.operators import contract as checks
from riskspark.operators import quality
from riskspark.operators.contract import CUSTOMER_CONTRACT

# Number text as both engines' regular expressions read it.
NUMBER = r"^[+-]?((\d+(_\d+)*(\.(\d+(_\d+)*)?)?)|(\.\d+(_\d+)*))([eE][+-]?\d+)?$"


def number_sql(column: str) -> str:
    return f"CASE WHEN regexp_matches(trim({column}), '{NUMBER}') THEN try_cast(trim({column}) as double) END"


def is_number_sql(column: str) -> str:
    return f"regexp_matches(trim({column}), '{NUMBER}')"


def _is_int(column: str) -> str:
    return f"regexp_matches(trim({column}), '^[+-]?[0-9]+$')"


def _checks_sql() -> list[tuple[str, str, str, bool]]:
    """(check, column, predicate, one error per row) of the raw snapshot."""
    out = [
        ("null_primary_key", "customerID", "\"customerID\" IS NULL OR trim(\"customerID\") = ''", False),
        ("not_nullable", "customerID", '"customerID" IS NULL', True),
        ("non_blank_id", "customerID", "trim(\"customerID\") = ''", True),
    ]
    for name, allowed in {**CUSTOMER_CONTRACT.categorical, "Churn": ("Yes", "No")}.items():
        words = ", ".join(f"'{a}'" for a in allowed)
        out.append(("not_nullable", name, f'"{name}" IS NULL', True))
        if name == "SeniorCitizen":
            out.append(("dtype", name, f'"{name}" IS NOT NULL AND NOT {_is_int(name)}', True))
            out.append(("isin", name, f'{_is_int(name)} AND trim("{name}") NOT IN ({words})', True))
        else:
            out.append(("isin", name, f'"{name}" NOT IN ({words})', True))
    out += [
        ("dtype", "tenure", f"tenure IS NOT NULL AND NOT {_is_int('tenure')}", True),
        ("not_nullable", "tenure", "tenure IS NULL", True),
        ("greater_than_or_equal_to", "tenure", f"{_is_int('tenure')} AND try_cast(tenure as bigint) < 0", True),
        ("dtype", "MonthlyCharges", f'"MonthlyCharges" IS NOT NULL AND NOT {is_number_sql(chr(34) + "MonthlyCharges" + chr(34))}', True),
        ("not_nullable", "MonthlyCharges", '"MonthlyCharges" IS NULL', True),
        ("greater_than_or_equal_to", "MonthlyCharges", f"{number_sql(chr(34) + 'MonthlyCharges' + chr(34))} < 0", True),
        (
            "invalid_type_conversion",
            "TotalCharges",
            f"trim(\"TotalCharges\") <> '' AND NOT {is_number_sql(chr(34) + 'TotalCharges' + chr(34))}",
            True,
        ),
        ("greater_than_or_equal_to", "TotalCharges", f"{number_sql(chr(34) + 'TotalCharges' + chr(34))} < 0", True),
    ]
    return out


def violations_cte(source: str = "raw") -> str:
    parts = [
        f"SELECT rid, \"customerID\", '{check}' AS check_type, '{column}' AS \"column\", "
        f'"{column}" AS value, {per_row} AS per_row FROM numbered WHERE {predicate}'
        for check, column, predicate, per_row in _checks_sql()
    ]
    return (
        f"numbered AS (SELECT *, row_number() OVER () AS rid FROM {source}),\nviolations AS ("
        + "\n  UNION ALL ".join(parts)
        + ")"
    )


DUPLICATES_CTE = """whole AS (SELECT sum(c - 1) AS extra_rows FROM (SELECT *, count(*) AS c FROM raw GROUP BY ALL) x),
keyed AS (SELECT "customerID" AS key, count(*) AS c FROM raw GROUP BY "customerID")"""

ERRORS_CTE = f"""{violations_cte()},
{DUPLICATES_CTE},
samples AS (SELECT check_type, "column", list_sort(list(value)) AS sample FROM (
    SELECT check_type, "column", value, row_number() OVER (PARTITION BY check_type, "column" ORDER BY value) AS rn
    FROM (SELECT DISTINCT check_type, "column", value FROM violations WHERE value IS NOT NULL) d) r
  WHERE rn <= 5 GROUP BY check_type, "column"),
errors AS (
  SELECT v.check_type, v."column", count(*) AS invalid_count,
    CASE WHEN bool_and(per_row) THEN count(*) ELSE 1 END AS error_records,
    coalesce(array_to_string(any_value(sample), '|'), '') AS samples
  FROM violations v LEFT JOIN samples s ON v.check_type = s.check_type AND v."column" = s."column"
  GROUP BY v.check_type, v."column"
  UNION ALL SELECT 'duplicate_rows', NULL, cast(extra_rows as bigint), 1, '' FROM whole WHERE extra_rows > 0
  UNION ALL SELECT 'duplicate_primary_key', 'customerID', cast(sum(c) as bigint), 1,
    (SELECT array_to_string(list_sort(list(key)), '|') FROM (SELECT key FROM keyed WHERE c > 1 ORDER BY key NULLS FIRST LIMIT 5) f)
  FROM keyed WHERE c > 1)"""

REPORT_CTE = f"""{ERRORS_CTE},
report AS (SELECT (SELECT count(*) FROM raw) AS total_rows,
  (SELECT count(*) FROM numbered WHERE rid NOT IN (SELECT rid FROM violations)) AS clean_rows,
  (SELECT cast(coalesce(sum(error_records), 0) as bigint) FROM errors) AS error_records)"""


def _shown(errors: DataFrame) -> DataFrame:
    """Error list with its samples joined to text."""
    return errors.withColumn("samples", F.array_join("sample_invalid_values", "|")).drop(
        "sample_invalid_values"
    )


@query(
    "c01_duplicate_rows",
    f"WITH {RAW_CTE}, {DUPLICATES_CTE} SELECT cast(extra_rows as bigint) AS duplicate_rows FROM whole",
)
def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_counts(raw_snapshot(spark, sf_dir), "customerID").select("duplicate_rows")


@query(
    "c02_missing_column",
    """SELECT 'missing_column' AS check_type, 'customerID' AS "column", count(*) AS invalid_count FROM lineitem
UNION ALL SELECT 'column_in_dataframe', unnest(['customerID', 'gender', 'tenure']), 1""",
)
def missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items lack the customer key and most contract columns."""
    errors = checks.validation_errors(table(spark, sf_dir, "lineitem"), CUSTOMER_CONTRACT)
    return errors.filter(F.col("column").isin("customerID", "gender", "tenure")).select(
        "check_type", "column", "invalid_count"
    )


def _one_check(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        counts = checks.check_counts(raw_snapshot(spark, sf_dir), CUSTOMER_CONTRACT)
        return (
            counts.filter(F.col("check_type") == name)
            .groupBy("check_type", "column")
            .agg(F.sum("n").alias("invalid_count"))
        )

    sql = f"""WITH {RAW_CTE}, {violations_cte()} SELECT check_type, "column", count(*) AS invalid_count
FROM violations WHERE check_type = '{name}' GROUP BY check_type, "column" """
    return run, sql


for _query_name, _check in (
    ("c03_null_primary_key", "null_primary_key"),
    ("c05_invalid_type_conversion", "invalid_type_conversion"),
    ("c06_domain_membership", "isin"),
    ("c07_lower_bounds", "greater_than_or_equal_to"),
    ("c08_not_null", "not_nullable"),
    ("c11_non_blank_id", "non_blank_id"),
):
    _run, _sql = _one_check(_check)
    query(_query_name, _sql)(_run)


@query(
    "c04_duplicate_primary_key",
    f"""WITH {RAW_CTE}, {DUPLICATES_CTE}
SELECT cast(sum(CASE WHEN c > 1 THEN c ELSE 0 END) as bigint) AS duplicate_primary_keys, cast(sum(c - 1) as bigint) AS extra_keys,
  count(key) AS distinct_keys FROM keyed""",
)
def duplicate_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_counts(raw_snapshot(spark, sf_dir), "customerID").select(
        "duplicate_primary_keys", "extra_keys", "distinct_keys"
    )


@query(
    "c04_duplicate_keys_large",
    """SELECT cast(sum(CASE WHEN c > 1 THEN c ELSE 0 END) as bigint) AS duplicate_primary_keys, cast(sum(c - 1) as bigint) AS extra_keys,
  count(*) AS distinct_keys FROM (SELECT concat_ws('-', l_orderkey, l_linenumber) AS key, count(*) AS c FROM lineitem GROUP BY key) k""",
)
def duplicate_keys_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by (order, line): a large table whose key is really duplicated."""
    rows = table(spark, sf_dir, "lineitem").withColumn(
        "line_key", F.concat_ws("-", "l_orderkey", "l_linenumber")
    )
    return checks.duplicate_counts(rows, "line_key").select(
        "duplicate_primary_keys", "extra_keys", "distinct_keys"
    )


_LINE_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()


@query(
    "c09_schema_problems",
    f"""SELECT check_type, "column", n AS invalid_count, n AS error_records, '' AS samples FROM (
  SELECT 'column_in_dataframe' AS check_type, unnest({CUSTOMER_CONTRACT.columns(True)}) AS "column"
  UNION ALL SELECT 'column_in_schema', unnest({_LINE_COLUMNS})) x, (SELECT cast(1 as bigint) AS n) y""",
)
def schema_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column-level findings of line items against the customer contract."""
    errors = checks.validation_errors(table(spark, sf_dir, "lineitem"), CUSTOMER_CONTRACT)
    return _shown(errors.filter(F.col("check_type").isin("column_in_dataframe", "column_in_schema")))


@query(
    "c10_target_domain",
    f"""WITH {RAW_CTE}, {violations_cte()} SELECT value, count(*) AS invalid_count FROM violations
WHERE "column" = 'Churn' GROUP BY value""",
)
def target_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checks.violations(raw_snapshot(spark, sf_dir), CUSTOMER_CONTRACT)
    return found.filter(F.col("column") == "Churn").groupBy("value").agg(
        F.count(F.lit(1)).alias("invalid_count")
    )


@query(
    "c12_violations",
    f'WITH {RAW_CTE}, {violations_cte()} SELECT "customerID", check_type, "column", value FROM violations',
)
def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.violations(raw_snapshot(spark, sf_dir), CUSTOMER_CONTRACT)


@query(
    "c12_violations_large",
    """SELECT cast(l_orderkey as varchar) AS l_orderkey, check_type, "column", value FROM (
  SELECT l_orderkey, 'isin' AS check_type, 'l_returnflag' AS "column", l_returnflag AS value FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
  UNION ALL SELECT l_orderkey, 'greater_than_or_equal_to', 'l_quantity', cast(l_quantity as varchar) FROM lineitem WHERE l_quantity < 2
  UNION ALL SELECT l_orderkey, 'greater_than_or_equal_to', 'l_extendedprice', cast(l_extendedprice as varchar) FROM lineitem WHERE l_extendedprice < 1000) v""",
)
def violations_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level violations of line items under narrowed domains and bounds."""
    found = checks.violations(table(spark, sf_dir, "lineitem"), LINE_CONTRACT)
    return found.withColumn("l_orderkey", F.col("l_orderkey").cast("string"))


@query("c13_validation_errors", f"WITH {RAW_CTE}, {ERRORS_CTE} SELECT * FROM errors")
def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(checks.validation_errors(raw_snapshot(spark, sf_dir), CUSTOMER_CONTRACT))


@query(
    "c13_validation_report",
    f"""WITH {RAW_CTE}, {REPORT_CTE}
SELECT error_records = 0 AS is_valid, '1.0.0' AS schema_version, total_rows,
  CASE WHEN error_records = 0 THEN total_rows ELSE greatest(0, total_rows - error_records) END AS valid_rows,
  clean_rows, error_records,
  CASE WHEN error_records = 0 THEN concat('Validation PASSED for ', total_rows, ' row(s) against schema v1.0.0.')
       ELSE concat('Validation FAILED with ', error_records, ' error(s) across ', total_rows, ' row(s).') END AS summary
FROM report""",
)
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.validation_report(raw_snapshot(spark, sf_dir), CUSTOMER_CONTRACT)


@query(
    "c14_scoring_batch_report",
    f"""WITH {SNAPSHOT_CTE} SELECT true AS is_valid, count(*) AS total_rows, count(*) AS valid_rows, count(*) AS clean_rows,
  cast(0 as bigint) AS error_records FROM snapshot""",
)
def scoring_batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean batch without its target passes."""
    _, report, _ = checks.validate_scoring_batch(
        snapshot(spark, sf_dir).drop("Churn"), CUSTOMER_CONTRACT
    )
    return report.select("is_valid", "total_rows", "valid_rows", "clean_rows", "error_records")


@query(
    "c15_quality_report",
    f"""WITH {RAW_CTE}, {REPORT_CTE}, v AS (SELECT *, greatest(0, total_rows - error_records) AS ok FROM report)
SELECT total_rows AS total_records, ok AS accepted_records, total_rows - ok AS rejected_records,
  round((total_rows - ok)::double / total_rows, 4) AS rejection_rate,
  (SELECT cast(extra_rows as bigint) FROM whole) AS duplicate_rows,
  (SELECT cast(sum(CASE WHEN c > 1 THEN c ELSE 0 END) as bigint) FROM keyed) AS duplicate_primary_keys,
  error_records AS schema_violations, error_records = 0 AS is_valid FROM v""",
)
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(raw_snapshot(spark, sf_dir), CUSTOMER_CONTRACT, training=True).drop(
        "summary"
    )


@query(
    "c15_missing_values",
    f"""WITH {RAW_CTE}, n AS (SELECT count(*) AS total FROM raw), m AS ("""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE \"{c}\" IS NULL) AS null_count FROM raw"
        for c in CUSTOMER_CONTRACT.columns(True)
    )
    + """) SELECT "column", null_count, round(null_count::double / total, 4) AS null_percentage FROM m, n WHERE null_count > 0""",
)
def missing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_values(raw_snapshot(spark, sf_dir))


# --- column functions ---------------------------------------------------------------


@query(
    "b01_parse_charges",
    f"""WITH {RAW_CTE} SELECT "customerID", "TotalCharges" AS raw_text, {number_sql('"TotalCharges"')} AS charge,
  coalesce(trim("TotalCharges") <> '' AND NOT {is_number_sql('"TotalCharges"')}, false) AS is_error FROM raw""",
)
def parse_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("TotalCharges")
    return raw_snapshot(spark, sf_dir).select(
        "customerID",
        text.alias("raw_text"),
        parsing.charge_value(text).alias("charge"),
        parsing.charge_is_bad(text).alias("is_error"),
    )


@query(
    "b02_binary_target",
    f"""WITH {SNAPSHOT_CTE} SELECT "customerID", CASE WHEN "Churn" = 'Yes' THEN 1 ELSE 0 END AS label FROM snapshot""",
)
def binary_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot(spark, sf_dir).select(
        "customerID", parsing.binary_target(F.col("Churn")).alias("label")
    )


@query(
    "b03_feature_projection",
    f'WITH {SNAPSHOT_CTE} SELECT * EXCLUDE ("customerID", gender, "SeniorCitizen", "Churn") FROM snapshot',
)
def feature_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot(spark, sf_dir)
    return rows.select(*feature_columns(rows.columns, "Churn", EXCLUDED_FEATURES))


@query(
    "b04_coerce_numeric",
    f"""WITH {RAW_CTE} SELECT "customerID", {number_sql("tenure")} AS tenure, {number_sql('"SeniorCitizen"')} AS senior FROM raw""",
)
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_snapshot(spark, sf_dir).select(
        "customerID",
        parsing.to_number(F.col("tenure")).alias("tenure"),
        parsing.to_number(F.col("SeniorCitizen")).alias("senior"),
    )


@query(
    "b05_b06_bands",
    f"""WITH {SNAPSHOT_CTE} SELECT "customerID",
  CASE WHEN tenure <= 12 THEN '0-12 months' WHEN tenure <= 24 THEN '13-24 months' WHEN tenure <= 48 THEN '25-48 months' ELSE '49+ months' END AS tenure_band,
  CASE WHEN "MonthlyCharges" < 35 THEN '< $35' WHEN "MonthlyCharges" <= 70 THEN '$35 - $70' ELSE '> $70' END AS monthly_charges_band FROM snapshot""",
)
def banded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot(spark, sf_dir).select(
        "customerID",
        bands.tenure_band(F.col("tenure")).alias("tenure_band"),
        bands.charge_band(F.col("MonthlyCharges")).alias("monthly_charges_band"),
    )


@query(
    "b07_decision",
    """SELECT event_id, CASE WHEN value / 500.0 >= 0.1 THEN 1 ELSE 0 END AS predicted_class FROM events""",
)
def decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", decisions.decide(F.col("value") / 500.0, 0.1).alias("predicted_class")
    )


@query(
    "b08_charge_discrepancy",
    f"""WITH {SNAPSHOT_CTE} SELECT "customerID", round(abs("TotalCharges" - tenure * "MonthlyCharges"), 4) AS gap FROM snapshot""",
)
def charge_discrepancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = bands.charge_discrepancy(F.col("tenure"), F.col("MonthlyCharges"), F.col("TotalCharges"))
    return snapshot(spark, sf_dir).select("customerID", F.round(gap, 4).alias("gap"))


# Event types and customer data carry arm words in mixed case and with spaces.
ARM_TEXT = "CASE event_type WHEN 'click' THEN ' Treatment ' WHEN 'view' THEN 'HOLDOUT' WHEN 'purchase' THEN '1' WHEN 'signup' THEN 'False' ELSE event_type END"


@query(
    "b09_treatment_arm",
    f"""SELECT event_id, CASE WHEN lower(trim(arm_text)) IN ('treatment', 'treated', '1', 'true', 'targeted') THEN 'treatment'
  WHEN lower(trim(arm_text)) IN ('control', 'holdout', '0', 'false', 'untargeted') THEN 'control' END AS arm
FROM (SELECT event_id, {ARM_TEXT} AS arm_text FROM events) e""",
)
def treatment_arm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", parsing.treatment_arm(F.expr(ARM_TEXT)).alias("arm")
    )


@query(
    "b10_binary_outcome",
    f"""WITH {RAW_CTE} SELECT "customerID", CASE WHEN lower(trim("Churn")) IN ('yes', '1', 'true', 'churn') THEN 1 ELSE 0 END AS from_text,
  cast(trunc(try_cast("MonthlyCharges" as double) / 30) as int) AS from_number FROM raw""",
)
def binary_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_snapshot(spark, sf_dir)
    name = parsing.outcome_column(rows.columns)
    return rows.select(
        "customerID",
        parsing.binary_outcome(F.col(name), "string").alias("from_text"),
        parsing.binary_outcome(
            parsing.to_number(F.col("MonthlyCharges")) / 30, "double"
        ).alias("from_number"),
    )


@query(
    "b12_flag_labels",
    f"""WITH {SNAPSHOT_CTE} SELECT "customerID", CASE "SeniorCitizen" WHEN 0 THEN 'Non-Senior' WHEN 1 THEN 'Senior' END AS senior FROM snapshot""",
)
def flag_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot(spark, sf_dir).select(
        "customerID", bands.flag_label(F.col("SeniorCitizen"), "Non-Senior", "Senior").alias("senior")
    )


@query(
    "c01_row_identity",
    "SELECT count(*) AS duplicate_rows, 3 * count(*) AS total_rows, count(*) AS distinct_keys FROM events",
)
def row_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of three rows a key, one differs by a microsecond and one by the sign of a zero: one is a copy."""
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.lit(0.0).alias("amount")
    )
    later = rows.withColumn("ts", F.expr("ts + INTERVAL '0.000001' SECOND"))
    signed = rows.withColumn("amount", F.lit(-0.0))
    counted = checks.duplicate_counts(rows.union(later).union(signed), "event_id")
    return counted.select("duplicate_rows", "total_rows", "distinct_keys")


@query(
    "c03_white_space_keys",
    "SELECT count(*) AS blank_keys, count(*) FILTER (WHERE o_orderkey % 3 = 2) AS bad_numbers FROM orders",
)
def white_space_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of any white space are blank; a number among white space is a number, white space alone is missing."""
    contract = checks.Contract("key", {}, {"amount": checks.NumericRule(nullable=True, lenient_text=True)})
    blank = F.element_at(F.array(*map(F.lit, ("\t", "\r\n", "\u00a0 "))), (F.col("o_orderkey") % 3 + 1).cast("int"))
    text = F.element_at(F.array(*map(F.lit, ("\t12.5\r", "\t", "\tx"))), (F.col("o_orderkey") % 3 + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select(blank.alias("key"), text.alias("amount"))
    errors = checks.validation_errors(rows, contract, training=False)
    return errors.agg(
        F.sum(F.when(F.col("check_type") == "null_primary_key", F.col("invalid_count"))).alias("blank_keys"),
        F.sum(F.when(F.col("check_type") == "invalid_type_conversion", F.col("invalid_count"))).alias("bad_numbers"),
    )
