"""Drift between two periods of orders and of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import query
from catalog.standins import EVENT_MIDPOINT, ORDER_HALVES_CTE, event_halves, order_halves, table
from riskspark.operators import drift, reference_profile
from riskspark.session import new_scratch_path

NUMERIC = ("o_totalprice", "o_custkey", "aged_price")
CATEGORICAL = ("o_orderpriority", "o_orderstatus")

_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, cast({c} as double) AS value, is_ref FROM pair" for c in NUMERIC
)
_WORDS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, cast({c} as varchar) AS value, is_ref FROM pair" for c in CATEGORICAL
)
_STEPS = ", ".join(repr(i / 10) for i in range(11))

# p-value of the asymptotic distribution; values below a shape of 0.2 are 1.
P_VALUE = """CASE WHEN lam < 0.2 THEN 1.0::double ELSE greatest(0.0::double, least(1.0::double, 2.0::double *
  list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1.0::double ELSE -1.0::double END * exp(-2.0::double * k * k * lam * lam))))) END"""


def ks_sql(gap: str) -> str:
    """KS p-values of rows ``feature``, ``ks``, ``n_ref``, ``n_cur``: a walk inside the band for small sides, the series beyond."""
    return f"""WITH RECURSIVE shaped AS (SELECT *, ks * sqrt(n_ref::double * n_cur / (n_ref + n_cur)) AS lam,
    cast(n_ref as bigint) AS n, cast(n_cur as bigint) AS m, cast(n_ref + n_cur as bigint) AS t, round(ks * n_ref * n_cur) AS h FROM {gap}),
walk AS (SELECT feature, n, m, t, h, 0::bigint AS k, 0::bigint AS lo, [1.0::double] AS p FROM shaped WHERE greatest(n, m) <= 10000 AND lam < 4 AND h > 0
  UNION ALL SELECT feature, n, m, t, h, k + 1, lo2,
    list_transform(range(lo2, hi2 + 1), lambda i: (coalesce(p[i - lo], 0) * (n - i + 1) + coalesce(p[i - lo + 1], 0) * (m - k + i)) / (t - k))
  FROM (SELECT *, cast(greatest(0, k + 1 - m, floor(((k + 1) * n - h) / t) + 1) as bigint) AS lo2,
    cast(least(n, k + 1, ceil(((k + 1) * n + h) / t) - 1) as bigint) AS hi2 FROM walk WHERE k < t) s)
SELECT feature, round(ks, 4) AS ks_statistic, round(CASE WHEN h <= 0 THEN 1.0::double
  WHEN greatest(n, m) <= 10000 AND lam < 4 THEN greatest(0, least(1, 1 - coalesce(rest, 0))) ELSE {P_VALUE} END, 4) AS ks_p_value
FROM shaped LEFT JOIN (SELECT feature, list_sum(p) AS rest FROM walk WHERE k = t) w USING (feature)"""


NUMERIC_CTE = f"""{ORDER_HALVES_CTE}, long AS ({_LONG}), known AS (SELECT * FROM long WHERE value IS NOT NULL),
sizes AS (SELECT feature, sum(is_ref) AS n_ref, sum(1 - is_ref) AS n_cur FROM known GROUP BY feature),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{_STEPS}]))) AS edges FROM known WHERE is_ref = 1 GROUP BY feature),
binned AS (SELECT feature, is_ref, CASE WHEN value < edges[1] OR value > edges[-1] THEN NULL
    WHEN value = edges[-1] THEN len(edges) - 2 ELSE len(list_filter(edges, lambda e: e <= value)) - 1 END AS bin
  FROM known JOIN edges USING (feature) WHERE len(edges) >= 2),
shares AS (SELECT feature, bin, sum(is_ref) / any_value(n_ref)::double AS p0, sum(1 - is_ref) / any_value(n_cur)::double AS q0
  FROM binned JOIN sizes USING (feature) WHERE bin IS NOT NULL GROUP BY feature, bin),
psi AS (SELECT feature, round(greatest(0.0::double, sum((q - p) * ln(q / p))), 4) AS psi FROM (
  SELECT feature, CASE WHEN p0 = 0 THEN 0.0001::double ELSE p0 END AS p, CASE WHEN q0 = 0 THEN 0.0001::double ELSE q0 END AS q FROM shares) s GROUP BY feature),
steps AS (SELECT feature, value, sum(is_ref) AS r, sum(1 - is_ref) AS c FROM known GROUP BY feature, value),
running AS (SELECT feature, sum(r) OVER w AS cr, sum(c) OVER w AS cc FROM steps WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)),
gap AS (SELECT feature, max(abs(cr / n_ref::double - cc / n_cur::double)) AS ks, any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur
  FROM running JOIN sizes USING (feature) GROUP BY feature),
ks AS ({ks_sql("gap")})"""

CATEGORICAL_CTE = f"""words AS ({_WORDS}),
named AS (SELECT feature, coalesce(value, '__MISSING__') AS value, sum(is_ref) AS r, sum(1 - is_ref) AS c FROM words GROUP BY 1, 2),
cat_psi AS (SELECT feature, round(greatest(0.0::double, sum((q - p) * ln(q / p))), 4) AS psi FROM (
  SELECT feature, CASE WHEN r = 0 THEN 0.0001::double ELSE r::double / n_ref END AS p, CASE WHEN c = 0 THEN 0.0001::double ELSE c::double / n_cur END AS q
  FROM named JOIN (SELECT feature, sum(r) AS n_ref, sum(c) AS n_cur FROM named GROUP BY feature) t USING (feature)) s GROUP BY feature)"""


def missing_sql(source: str) -> str:
    return f"""SELECT feature, round(mr, 4) AS missing_rate_reference, round(mc, 4) AS missing_rate_scoring,
  round(abs(mc - mr), 4) AS missing_rate_delta FROM (SELECT feature,
    (count(*) FILTER (WHERE is_ref = 1 AND value IS NULL))::double / count(*) FILTER (WHERE is_ref = 1) AS mr,
    (count(*) FILTER (WHERE is_ref = 0 AND value IS NULL))::double / count(*) FILTER (WHERE is_ref = 0) AS mc
  FROM {source} GROUP BY feature) m"""


STATUS = """CASE WHEN psi >= 0.25 THEN 'significant_drift' WHEN psi >= 0.10 THEN 'moderate_drift' ELSE 'no_drift' END"""
FEATURES_CTE = f"""{NUMERIC_CTE}, {CATEGORICAL_CTE},
features AS (SELECT feature, 'numerical' AS feature_type, psi, ks_statistic, ks_p_value, missing_rate_reference, missing_rate_scoring,
    missing_rate_delta, {STATUS} AS drift_status FROM psi JOIN ks USING (feature) JOIN ({missing_sql("long")}) USING (feature)
  UNION ALL SELECT feature, 'categorical', psi, NULL, NULL, missing_rate_reference, missing_rate_scoring, missing_rate_delta,
    {STATUS} FROM cat_psi JOIN ({missing_sql("words")}) USING (feature))"""


def _numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.numeric_histogram(*order_halves(spark, sf_dir), NUMERIC)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = order_halves(spark, sf_dir)
    return drift.feature_drift(current, reference, NUMERIC, CATEGORICAL)


@query("h01_numeric_psi", f"WITH {NUMERIC_CTE} SELECT * FROM psi")
def numeric_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.numeric_psi(_numeric(spark, sf_dir), len(NUMERIC))


@query(
    "h01_numeric_psi_events",
    f"""WITH pair AS (SELECT value AS o_totalprice, user_id AS o_custkey, hour(ts) AS aged_price, event_type AS o_orderpriority,
  event_type AS o_orderstatus, CASE WHEN ts < TIMESTAMP '{EVENT_MIDPOINT}' THEN 1 ELSE 0 END AS is_ref FROM events),
{NUMERIC_CTE.split("), long AS", 1)[1].join(["long AS", ""])}
SELECT CASE feature WHEN 'o_totalprice' THEN 'value' WHEN 'o_custkey' THEN 'user_id' ELSE 'hour' END AS feature, psi FROM psi""",
)
def numeric_psi_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skewed values, ids and an hour of few distinct values, so edges repeat."""
    features = ["value", "user_id", "hour"]
    return drift.numeric_psi(
        drift.numeric_histogram(*event_halves(spark, sf_dir), features), len(features)
    )


@query("h02_categorical_psi", f"WITH {ORDER_HALVES_CTE}, {CATEGORICAL_CTE} SELECT * FROM cat_psi")
def categorical_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.categorical_psi(
        drift.categorical_histogram(*order_halves(spark, sf_dir), CATEGORICAL), len(CATEGORICAL)
    )


@query("h03_ks_statistic", f"WITH {NUMERIC_CTE} SELECT feature, ks_statistic FROM ks")
def ks_statistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.ks_statistics(_numeric(spark, sf_dir)).select("feature", "ks_statistic")


@query("h04_ks_p_value", f"WITH {NUMERIC_CTE} SELECT feature, ks_p_value FROM ks")
def ks_p_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.ks_statistics(_numeric(spark, sf_dir)).select("feature", "ks_p_value")


_GROUPS = "SELECT *, concat(event_type, '-', user_id % 40) AS feature, CASE WHEN day(ts) <= 15 THEN 1 ELSE 0 END AS is_ref FROM events"


@query(
    "h04_ks_small_samples",
    f"""WITH known AS ({_GROUPS}), sizes AS (SELECT feature, sum(is_ref) AS n_ref, sum(1 - is_ref) AS n_cur FROM known GROUP BY feature),
steps AS (SELECT feature, value, sum(is_ref) AS r, sum(1 - is_ref) AS c FROM known GROUP BY feature, value),
running AS (SELECT feature, sum(r) OVER w AS cr, sum(c) OVER w AS cc FROM steps WINDOW w AS (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING)),
gap AS (SELECT feature, max(abs(cr / n_ref::double - cc / n_cur::double)) AS ks, any_value(n_ref) AS n_ref, any_value(n_cur) AS n_cur
  FROM running JOIN sizes USING (feature) WHERE n_ref > 0 AND n_cur > 0 GROUP BY feature)
SELECT feature, ks_statistic, ks_p_value, cast(n_ref as bigint) AS n_ref, cast(n_cur as bigint) AS n_cur FROM ({ks_sql("gap")}) k JOIN sizes USING (feature)""",
)
def ks_small_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of the first and second half of a month, in groups of some ten rows by event type and user."""
    events = table(spark, sf_dir, "events").select(
        F.concat_ws("-", "event_type", (F.col("user_id") % 40).cast("string")).alias("feature"), "value", "ts"
    )
    early = F.dayofmonth("ts") <= 15
    histogram = events.groupBy("feature", "value").agg(
        F.count_if(early).alias("ref_n"), F.count_if(~early).alias("cur_n")
    )
    sizes = histogram.groupBy("feature").agg(F.sum("ref_n").alias("n_ref"), F.sum("cur_n").alias("n_cur"))
    return drift.ks_statistics(histogram).join(sizes.where("n_ref > 0 AND n_cur > 0"), "feature")


@query("h05_missing_rates", f"WITH {ORDER_HALVES_CTE}, long AS ({_LONG}) {missing_sql('long')}")
def missing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.missing_rates(_numeric(spark, sf_dir))


@query("h06_feature_drift", f"WITH {FEATURES_CTE} SELECT * FROM features")
def feature_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir)


REPORT_SQL = """SELECT (SELECT count(*) FROM pair WHERE is_ref = 1) AS reference_record_count,
  (SELECT count(*) FROM pair WHERE is_ref = 0) AS scoring_record_count,
  CASE WHEN max(psi) >= 0.25 THEN 'significant_drift' WHEN max(psi) >= 0.10 THEN 'moderate_drift' ELSE 'no_drift' END AS overall_drift_status,
  max(psi) AS max_psi, count(*) FILTER (WHERE drift_status = 'significant_drift') AS drifted_features_count,
  count(*) AS features_evaluated,
  coalesce(array_to_string(list_sort(list(feature) FILTER (WHERE drift_status = 'significant_drift')), '|'), '') AS drifted_features FROM features"""


@query("h07_from_stored_profile", f"WITH {FEATURES_CTE} {REPORT_SQL}")
def drift_from_stored_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report without the reference table: its profile is kept, from two parts that were profiled apart."""
    reference, current = order_halves(spark, sf_dir)
    odd = F.coalesce(F.col("o_custkey") % 2 == 1, F.lit(False))
    root = new_scratch_path(spark, "reference-profile")
    for part in (reference.where(odd), reference.where(~odd)):
        reference_profile.add_to_profile(spark, root, part, NUMERIC, CATEGORICAL)
    kept = reference_profile.load_profile(spark, root)
    _, report = reference_profile.drift_from_profile(current, kept, NUMERIC, CATEGORICAL)
    return report.withColumn("drifted_features", F.array_join("drifted_features", "|")).drop("summary")


@query("h07_drift_report", f"WITH {FEATURES_CTE} {REPORT_SQL}")
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference, current = order_halves(spark, sf_dir)
    _, report = drift.detect_drift(current, reference, NUMERIC, CATEGORICAL)
    return report.withColumn("drifted_features", F.array_join("drifted_features", "|")).drop("summary")
