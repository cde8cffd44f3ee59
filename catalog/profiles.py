"""Profiles and chart data over the snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import query
from catalog.standins import RAW_CTE, SNAPSHOT_CTE, raw_snapshot, snapshot, table
from riskspark.operators import charts, profile
from riskspark.operators.contract import CUSTOMER_CONTRACT
from riskspark.plans.profile_run import profile_table, run_profile

NUMERIC = profile.NUMERIC_COLUMNS
CATEGORICAL = tuple(CUSTOMER_CONTRACT.categorical)


def numeric_long(source: str = "snapshot", keep: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, \"{c}\"::double AS value{keep} FROM {source}" for c in NUMERIC
    )


def categorical_long(columns, source: str = "snapshot") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, cast(\"{c}\" as varchar) AS category, \"Churn\" FROM {source}" for c in columns
    )


NUMERIC_CTE = f"""long AS ({numeric_long()}),
q AS (SELECT feature, count(value) AS n, avg(value) AS m, stddev_samp(value) AS s, min(value) AS lo, max(value) AS hi,
    skewness(value) AS g, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3
  FROM long WHERE value IS NOT NULL GROUP BY feature),
o AS (SELECT feature, count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers_iqr
  FROM long JOIN q USING (feature) GROUP BY feature),
numeric_summary AS (SELECT feature, n AS "count", round(m, 2) AS mean, round(s, 2) AS std, round(lo, 2) AS min, round(q1, 2) AS p25,
  round(q2, 2) AS p50, round(q3, 2) AS p75, round(hi, 2) AS max, round(g, 2) AS skewness, round(q3 - q1, 2) AS iqr, outliers_iqr
  FROM q JOIN o USING (feature))"""


def categorical_cte(columns) -> str:
    return f"""cats AS ({categorical_long(columns)}),
categorical_summary AS (SELECT feature, category, count(*) AS "count",
  round(100.0::double * count(*) / (SELECT count(*) FROM snapshot), 2) AS percentage,
  count(*) FILTER (WHERE "Churn" = 'Yes') AS churn_count,
  round(100.0::double * (count(*) FILTER (WHERE "Churn" = 'Yes')::double / count(*)), 2) AS churn_rate
  FROM cats WHERE category IS NOT NULL GROUP BY feature, category)"""


DISCREPANCY_CTE = """gaps AS (SELECT "TotalCharges" AS t, abs("TotalCharges" - tenure * "MonthlyCharges") AS gap FROM snapshot),
discrepancy AS (SELECT count(*) FILTER (WHERE t IS NULL) AS blank_total_charges_count, round(avg(gap), 2) AS mean_abs_diff,
  round(quantile_cont(gap, 0.5), 2) AS median_abs_diff, round(stddev_samp(gap), 2) AS std_abs_diff, round(max(gap), 2) AS max_abs_diff FROM gaps)"""
OVERVIEW_SQL = """SELECT (SELECT count(*) FROM {t}) AS total_rows, 21 AS total_cols,
  (SELECT cast(sum(c - 1) as bigint) FROM (SELECT *, count(*) AS c FROM {t} GROUP BY ALL) x) AS duplicate_rows,
  (SELECT cast(sum(c - 1) as bigint) FROM (SELECT "customerID", count(*) AS c FROM {t} GROUP BY ALL) y) AS duplicate_customer_ids"""


@query("d01_overview", f"WITH {RAW_CTE} {OVERVIEW_SQL.format(t='raw')}")
def overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.overview(raw_snapshot(spark, sf_dir), "customerID")


@query(
    "d01_column_overview",
    f"WITH {RAW_CTE}, m AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE \"{c}\" IS NULL) AS missing_count, count(*) AS n FROM raw"
        for c in CUSTOMER_CONTRACT.columns(True)
    )
    + """) SELECT "column", 'string' AS dtype, missing_count,
  CASE WHEN missing_count > 0 THEN round(missing_count::double / n, 4) * 100 END AS missing_percentage FROM m""",
)
def column_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.column_overview(raw_snapshot(spark, sf_dir))


@query(
    "d02_target_distribution",
    f"""WITH {SNAPSHOT_CTE} SELECT "Churn" AS value, count(*) AS "count",
  round(100.0::double * count(*) / (SELECT count("Churn") FROM snapshot), 2) AS percentage FROM snapshot WHERE "Churn" IS NOT NULL GROUP BY "Churn" """,
)
def target_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.target_distribution(snapshot(spark, sf_dir), "Churn")


BALANCE_CTE = """balance AS (SELECT positives, negatives, round(positives::double / total, 4) AS churn_rate,
  CASE WHEN positives > 0 THEN round(negatives::double / positives, 4) ELSE 'infinity'::double END AS imbalance_ratio FROM (
  SELECT count(*) FILTER (WHERE "Churn" = 'Yes') AS positives, count(*) FILTER (WHERE "Churn" = 'No') AS negatives, count(*) AS total FROM snapshot) b)"""


@query("d02_target_balance", f"WITH {SNAPSHOT_CTE}, {BALANCE_CTE} SELECT * FROM balance")
def target_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.target_balance(snapshot(spark, sf_dir), "Churn")


@query("d03_numeric_summary", f"WITH {SNAPSHOT_CTE}, {NUMERIC_CTE} SELECT * FROM numeric_summary")
def numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.numeric_summary(snapshot(spark, sf_dir), NUMERIC)


_LINE_MEASURES = ("l_quantity", "l_extendedprice", "l_discount")


@query(
    "d03_numeric_summary_large",
    "WITH long AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value FROM lineitem" for c in _LINE_MEASURES)
    + ")," + NUMERIC_CTE.split("),", 1)[1] + " SELECT * FROM numeric_summary",
)
def numeric_summary_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quartiles and outliers of line-item measures, nearly all prices distinct."""
    return profile.numeric_summary(table(spark, sf_dir, "lineitem"), _LINE_MEASURES)


@query(
    "d04_categorical_summary",
    f"WITH {SNAPSHOT_CTE}, {categorical_cte(CATEGORICAL)} SELECT * FROM categorical_summary",
)
def categorical_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.categorical_summary(snapshot(spark, sf_dir), CATEGORICAL, "Churn")


_CORRELATION_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, "
    + (f'round(corr("{a}", "{b}"), 4)' if a != b else "1.0::double")
    + " AS correlation FROM snapshot"
    for a in NUMERIC
    for b in NUMERIC
).replace('1.0::double AS correlation FROM snapshot', '1.0::double AS correlation')


@query("d05_correlations", f"WITH {SNAPSHOT_CTE} {_CORRELATION_SQL}")
def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.correlations(snapshot(spark, sf_dir), NUMERIC)


@query("d06_charge_discrepancy", f"WITH {SNAPSHOT_CTE}, {DISCREPANCY_CTE} SELECT * FROM discrepancy")
def charge_discrepancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.charge_discrepancies(snapshot(spark, sf_dir))


@query(
    "d07_id_uniqueness",
    f"""WITH {RAW_CTE} SELECT count(DISTINCT "customerID") AS distinct_keys, count(*) AS total_rows,
  count(DISTINCT "customerID") = count(*) AS customer_id_unique FROM raw""",
)
def id_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.id_uniqueness(raw_snapshot(spark, sf_dir), "customerID")


@query(
    "d07_has_unique_ids",
    f"""WITH {RAW_CTE} SELECT 'raw customers' AS keys, count(DISTINCT "customerID") = count(*) AS customer_id_unique FROM raw
UNION ALL SELECT 'orders', count(DISTINCT o_orderkey) = count(*) FROM orders
UNION ALL SELECT 'customers of orders', count(DISTINCT o_custkey) = count(*) FROM orders""",
)
def unique_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yes/no form over keys that repeat a little, not at all and often; the last one is told by the sketch alone."""
    orders = table(spark, sf_dir, "orders")
    asked = (
        ("raw customers", raw_snapshot(spark, sf_dir), "customerID"),
        ("orders", orders, "o_orderkey"),
        ("customers of orders", orders, "o_custkey"),
    )
    parts = [profile.has_unique_ids(df, key).select(F.lit(name).alias("keys"), "*") for name, df, key in asked]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "d08_sensitive_rates",
    f"""WITH {SNAPSHOT_CTE}, {categorical_cte(("gender", "SeniorCitizen"))}
SELECT feature, category, "count", churn_count, churn_rate FROM categorical_summary""",
)
def sensitive_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.positive_rates(snapshot(spark, sf_dir), ["gender", "SeniorCitizen"], "Churn")


def _measures(source: str, section: str, item: str, names: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {item} AS item, '{n}' AS measure, \"{n}\"::double AS value FROM {source}"
        for n in names
    )


@query(
    "d09_profile_run",
    f"""WITH {SNAPSHOT_CTE}, {NUMERIC_CTE}, {categorical_cte(CATEGORICAL)}, {DISCREPANCY_CTE}, {BALANCE_CTE},
overview AS ({OVERVIEW_SQL.format(t="snapshot")})
{_measures("overview", "overview", "'table'", ["total_rows", "duplicate_rows", "duplicate_customer_ids"])}
UNION ALL {_measures("balance", "balance", "'table'", ["positives", "negatives", "churn_rate"])}
UNION ALL {_measures("numeric_summary", "numeric", "feature",
                     ["count", "mean", "std", "min", "p25", "p50", "p75", "max", "iqr", "outliers_iqr"])}
UNION ALL {_measures("categorical_summary", "categorical", "concat(feature, '=', category)",
                     ["count", "churn_count", "churn_rate"])}
UNION ALL {_measures("discrepancy", "discrepancy", "'table'", ["mean_abs_diff", "median_abs_diff", "max_abs_diff"])}""",
)
def profile_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_table(run_profile(snapshot(spark, sf_dir), categorical=CATEGORICAL))


# --- chart data -----------------------------------------------------------------------


@query(
    "e01_class_bars",
    f"""WITH {SNAPSHOT_CTE} SELECT "Churn" AS value, count(*) AS "count",
  round(100.0::double * count(*) / (SELECT count(*) FROM snapshot), 1) AS label_pct FROM snapshot WHERE "Churn" IS NOT NULL GROUP BY "Churn" """,
)
def class_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.class_bars(snapshot(spark, sf_dir), "Churn")


_LONG_BY_CLASS = numeric_long(keep=', "Churn"')


@query(
    "e02_class_histograms",
    f"""WITH {SNAPSHOT_CTE}, long AS ({_LONG_BY_CLASS}),
r AS (SELECT feature, min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 30.0::double AS width FROM long GROUP BY feature),
b AS (SELECT feature, "Churn", lo, width, CASE WHEN hi = lo THEN 0 ELSE least(29, cast(floor((value - lo) / width) as int)) END AS bin
  FROM long JOIN r USING (feature) WHERE value IS NOT NULL)
SELECT feature, "Churn", bin, count(*) AS "count", round(max(lo + bin * width), 4) AS bin_start FROM b GROUP BY feature, "Churn", bin""",
)
def class_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.class_histograms(snapshot(spark, sf_dir), NUMERIC, "Churn")


@query(
    "e03_box_statistics",
    f"""WITH {SNAPSHOT_CTE}, long AS ({_LONG_BY_CLASS}),
q AS (SELECT feature, "Churn", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
  FROM long WHERE value IS NOT NULL GROUP BY feature, "Churn"),
j AS (SELECT *, value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) AS inside FROM long JOIN q USING (feature, "Churn") WHERE value IS NOT NULL)
SELECT feature, "Churn", round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3,
  round(min(value) FILTER (WHERE inside), 4) AS whisker_low, round(max(value) FILTER (WHERE inside), 4) AS whisker_high,
  count(*) FILTER (WHERE NOT inside) AS outliers FROM j GROUP BY feature, "Churn" """,
)
def box_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.box_statistics(snapshot(spark, sf_dir), NUMERIC, "Churn")


@query(
    "e04_correlation_cells",
    f"WITH {SNAPSHOT_CTE}, c AS ({_CORRELATION_SQL}) SELECT * FROM c WHERE feature_x <= feature_y",
)
def correlation_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of one triangle of the heatmap."""
    return profile.correlations(snapshot(spark, sf_dir), NUMERIC).filter(
        F.col("feature_x") <= F.col("feature_y")
    )


@query(
    "e05_rate_bars",
    f"""WITH {SNAPSHOT_CTE}, {categorical_cte(charts.KEY_FEATURES)}
SELECT feature, category, churn_rate FROM categorical_summary""",
)
def rate_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.rate_bars(snapshot(spark, sf_dir), "Churn")


@query(
    "e06_scatter_grid",
    f"""WITH {SNAPSHOT_CTE} SELECT floor(tenure / 6.0::double) * 6.0::double AS x, floor("MonthlyCharges" / 10.0::double) * 10.0::double AS y,
  "Churn" AS value, count(*) AS "count" FROM snapshot GROUP BY ALL""",
)
def scatter_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.scatter_grid(snapshot(spark, sf_dir), "tenure", "MonthlyCharges", "Churn", 6.0, 10.0)


@query(
    "e07_sensitive_bars",
    f"""WITH {SNAPSHOT_CTE}, {categorical_cte(("gender", "SeniorCitizen"))}
SELECT feature, CASE WHEN feature = 'SeniorCitizen' THEN CASE category WHEN '1' THEN 'Senior' ELSE 'Non-Senior' END ELSE category END AS category,
  "count", churn_count, churn_rate FROM categorical_summary""",
)
def sensitive_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charts.sensitive_bars(snapshot(spark, sf_dir), "Churn")
