"""Score-table evaluation over the scored line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import query
from catalog.standins import ROW_KEY, SCORE_DECIMALS, SCORED_CTE, scored
from riskspark.operators import calibration, capacity, classification, ranking, segments, suite
from riskspark.operators.distribution import side_by_side
from riskspark.operators.scores import by_dimension, score_table, skipped_rows
from riskspark.operators.split import hash_split

SEGMENTS = ("line_status", "quantity_band")
SENSITIVE = ("gender", "SeniorCitizen")
CAPACITY = 0.10
MODELS = {"champion": "y_prob", "challenger": "rival_prob"}
DIMENSION_VALUES = 2  # line_status has two values

# Histogram and curve of a score table, by key columns `k` and score `p`.
CURVE = """hist AS (SELECT {k}, {p} AS p, count(*) AS n, sum(y_true) AS pos FROM {t} GROUP BY {k}, {p}),
curve AS (SELECT {k}, p, n, pos, sum(n) OVER w AS cum_n, sum(pos) OVER w AS cum_pos,
    sum(n) OVER (PARTITION BY {k}) AS all_n, sum(pos) OVER (PARTITION BY {k}) AS all_pos
  FROM hist WINDOW w AS (PARTITION BY {k} ORDER BY p DESC ROWS UNBOUNDED PRECEDING))"""

PR_AUC = """CASE WHEN sum(pos) > 0 AND sum(n) > sum(pos)
    THEN round(sum(pos::double * cum_pos / cum_n) / sum(pos), 4) END"""
ROC_AUC = """CASE WHEN sum(pos) > 0 AND sum(n) > sum(pos)
    THEN round(sum((n - pos)::double * (cum_pos - pos / 2.0::double))
               / (sum(pos)::double * (sum(n) - sum(pos))::double), 4) END"""


def ratio(part: str, whole: str, empty: str = "0.0") -> str:
    return f"CASE WHEN {whole} <> 0 THEN ({part})::double / ({whole})::double ELSE {empty}::double END"


def r4(expression: str) -> str:
    return f"round({expression}, 4)"


def confusion_sql(p: str, threshold: str) -> str:
    return f"""cast(count(*) FILTER (WHERE {p} >= {threshold} AND y_true = 1) as bigint) AS tp,
    cast(count(*) FILTER (WHERE {p} >= {threshold} AND y_true = 0) as bigint) AS fp,
    cast(count(*) FILTER (WHERE {p} < {threshold} AND y_true = 0) as bigint) AS tn,
    cast(count(*) FILTER (WHERE {p} < {threshold} AND y_true = 1) as bigint) AS fn"""


PRECISION, RECALL = ratio("tp", "(tp + fp)"), ratio("tp", "(tp + fn)")
F1 = ratio("2 * tp", "(2 * tp + fp + fn)")
ACCURACY = ratio("tp + tn", "(tp + fp + tn + fn)")


def by_status(spark: SparkSession, sf_dir: str, score: str = "y_prob"):
    return score_table(
        scored(spark, sf_dir), score=score, keys=["line_status"], decimals=SCORE_DECIMALS
    )


@query(
    "g01_average_precision",
    f"""WITH {SCORED_CTE}, {CURVE.format(k="line_status", p="y_prob", t="scored")}
SELECT line_status, {PR_AUC} AS pr_auc FROM curve GROUP BY line_status""",
)
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranking_metrics(by_status(spark, sf_dir)).select("line_status", "pr_auc")


@query(
    "g02_roc_auc",
    f"""WITH {SCORED_CTE}, {CURVE.format(k="line_status", p="y_prob", t="scored")}
SELECT line_status, {ROC_AUC} AS roc_auc FROM curve GROUP BY line_status""",
)
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranking_metrics(by_status(spark, sf_dir)).select("line_status", "roc_auc")


@query(
    "g02_ranking_any_score",
    f"""WITH {SCORED_CTE}, {CURVE.format(k="line_status", p="l_extendedprice", t="scored")}
SELECT line_status, {PR_AUC} AS pr_auc, {ROC_AUC} AS roc_auc FROM curve GROUP BY line_status""",
)
def ranking_any_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearly all scores distinct and off any grid: the bucketed running totals."""
    return ranking.ranking_metrics(
        score_table(scored(spark, sf_dir), score="l_extendedprice", keys=["line_status"])
    )


@query(
    "g03_threshold_metrics",
    f"""WITH {SCORED_CTE}, c AS (SELECT line_status, {confusion_sql("y_prob", "0.5")} FROM scored GROUP BY line_status)
SELECT line_status, 0.5::double AS threshold, {r4(PRECISION)} AS precision, {r4(RECALL)} AS recall,
  {r4(F1)} AS f1_score, {r4(ACCURACY)} AS accuracy FROM c""",
)
def threshold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classification.threshold_metrics(by_status(spark, sf_dir), 0.5)


@query(
    "g00_binary_metrics",
    f"""WITH {SCORED_CTE}, {CURVE.format(k="line_status", p="y_prob", t="scored")},
rank_sums AS (SELECT line_status, {PR_AUC} AS pr_auc, {ROC_AUC} AS roc_auc FROM curve GROUP BY line_status),
c AS (SELECT line_status, {confusion_sql("y_prob", "0.5")}, round(avg((y_prob - y_true) * (y_prob - y_true)), 4) AS brier_score FROM scored GROUP BY line_status)
SELECT line_status, pr_auc, roc_auc, {r4(PRECISION)} AS precision, {r4(RECALL)} AS recall, {r4(F1)} AS f1_score, {r4(ACCURACY)} AS accuracy,
  brier_score, 0.5::double AS threshold, tn, fp, fn, tp FROM rank_sums JOIN c USING (line_status)""",
)
def binary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All binary metrics in one row per line status."""
    return classification.binary_metrics(by_status(spark, sf_dir), 0.5)


@query(
    "g04_confusion_matrix",
    f"WITH {SCORED_CTE} SELECT line_status, {confusion_sql('y_prob', '0.5')} FROM scored GROUP BY line_status",
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classification.confusion_matrix(by_status(spark, sf_dir), 0.5)


def _report_line(label: str, p: str, r: str, f: str, support: str) -> str:
    return (
        f"SELECT line_status, '{label}' AS label, {r4(p)} AS precision, {r4(r)} AS recall, "
        f"{r4(f)} AS f1_score, cast({support} as bigint) AS support FROM m"
    )


@query(
    "g05_classification_report",
    f"""WITH {SCORED_CTE}, c AS (SELECT line_status, {confusion_sql("y_prob", "0.5")} FROM scored GROUP BY line_status),
m AS (SELECT *, tn + fp AS nn, tp + fn AS np, {ratio("tn", "(tn + fn)")} AS p0, {ratio("tn", "(tn + fp)")} AS r0,
    {ratio("2 * tn", "(2 * tn + fp + fn)")} AS f0, {PRECISION} AS p1, {RECALL} AS r1, {F1} AS f1, {ACCURACY} AS acc FROM c)
{_report_line("No Churn", "p0", "r0", "f0", "nn")}
UNION ALL {_report_line("Churn", "p1", "r1", "f1", "np")}
UNION ALL {_report_line("accuracy", "acc", "acc", "acc", "nn + np")}
UNION ALL {_report_line("macro avg", "(p0 + p1) / 2.0", "(r0 + r1) / 2.0", "(f0 + f1) / 2.0", "nn + np")}
UNION ALL {_report_line("weighted avg", "(p0 * nn + p1 * np) / (nn + np)", "(r0 * nn + r1 * np) / (nn + np)",
                        "(f0 * nn + f1 * np) / (nn + np)", "nn + np")}""",
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classification.classification_report(by_status(spark, sf_dir), 0.5)


@query(
    "g06_brier_score",
    f"""WITH {SCORED_CTE} SELECT line_status, round(avg((y_prob - y_true) * (y_prob - y_true)), 4) AS brier_score,
  count(*) AS n FROM scored GROUP BY line_status""",
)
def brier_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classification.brier_score(by_status(spark, sf_dir))


_THRESHOLDS = ", ".join(str(t) for t in classification.DEFAULT_THRESHOLDS)


@query(
    "g07_threshold_sweep",
    f"""WITH {SCORED_CTE}, t AS (SELECT unnest([{_THRESHOLDS}])::double AS threshold),
c AS (SELECT line_status, threshold, {confusion_sql("y_prob", "threshold")} FROM scored, t GROUP BY line_status, threshold)
SELECT line_status, threshold, {r4(PRECISION)} AS precision, {r4(RECALL)} AS recall, {r4(F1)} AS f1_score,
  {r4(ACCURACY)} AS accuracy, tp, fp, tn, fn FROM c""",
)
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classification.threshold_sweep(by_status(spark, sf_dir))


_EDGES = ", ".join(repr(e) for e in calibration.uniform_edges(10))


@query(
    "g08_calibration_uniform",
    f"""WITH {SCORED_CTE}, e AS (SELECT [{_EDGES}]::double[] AS edges),
b AS (SELECT line_status, y_true, y_prob, cast(len(list_filter(edges, lambda x: x < y_prob)) as int) AS bin FROM scored, e)
SELECT line_status, bin, round(avg(y_true), 4) AS prob_true, round(avg(y_prob), 4) AS prob_pred, count(*) AS bin_count
FROM b GROUP BY line_status, bin""",
)
def calibration_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibration.calibration_uniform(by_status(spark, sf_dir), 10)


_DECILES = ", ".join(repr(i / 10) for i in range(1, 10))


@query(
    "g09_calibration_quantile",
    f"""WITH {SCORED_CTE},
e AS (SELECT line_status, quantile_cont(y_prob, [{_DECILES}]) AS edges FROM scored GROUP BY line_status),
b AS (SELECT line_status, y_true, y_prob, cast(len(list_filter(edges, lambda x: x < y_prob)) as int) AS bin
  FROM scored JOIN e USING (line_status))
SELECT line_status, bin, round(avg(y_true), 4) AS prob_true, round(avg(y_prob), 4) AS prob_pred, count(*) AS bin_count
FROM b GROUP BY line_status, bin""",
)
def calibration_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibration.calibration_quantile(by_status(spark, sf_dir), 10)


def capacity_sql(keys: str, p: str, source: str, fraction: float = CAPACITY) -> str:
    """Ranked rows with the targeted size of their key."""
    over = f"PARTITION BY {keys}" if keys else ""
    columns = f"{keys}," if keys else ""
    return f"""ranked AS (SELECT {columns} {p} AS p, y_true, row_number() OVER ({over} ORDER BY {p} DESC, row_hash) AS rn,
    greatest(1, cast(round_even(count(*) OVER ({over}) * {fraction}::double, 0) as bigint)) AS k FROM {source}),
cap AS (SELECT {columns} max(k) AS num_targeted_customers, count(*) AS total_customers,
    cast(sum(CASE WHEN rn <= k THEN y_true ELSE 0 END) as bigint) AS captured, cast(sum(y_true) as bigint) AS all_pos,
    min(CASE WHEN rn <= k THEN p END) AS cut FROM ranked {f"GROUP BY {keys}" if keys else ""})"""


@query(
    "g10_capacity_metrics",
    f"""WITH {SCORED_CTE}, {capacity_sql("line_status", "y_prob", "scored")}
SELECT line_status, {CAPACITY}::double AS campaign_capacity_fraction, num_targeted_customers, total_customers,
  {r4(ratio("captured", "num_targeted_customers"))} AS precision_at_capacity,
  {r4(ratio("captured", "all_pos"))} AS recall_at_capacity, round(cut, 4) AS capacity_threshold,
  captured AS retained_churners_captured, all_pos AS total_actual_churners FROM cap""",
)
def capacity_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capacity.capacity_metrics(
        scored(spark, sf_dir),
        CAPACITY,
        ROW_KEY,
        keys=["line_status"],
        decimals=SCORE_DECIMALS,
        max_keys=DIMENSION_VALUES,
    )


@query(
    "g11_worklist",
    f"""WITH {SCORED_CTE}, ranked AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, y_prob,
    row_number() OVER (ORDER BY y_prob DESC, row_hash) AS rn,
    greatest(1, cast(round_even(count(*) OVER () * {CAPACITY}::double, 0) as bigint)) AS k FROM scored)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, y_prob FROM ranked WHERE rn <= k""",
)
def worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capacity.worklist(
        scored(spark, sf_dir), CAPACITY, ROW_KEY, decimals=SCORE_DECIMALS
    ).select(*ROW_KEY, "y_prob")


def long_sql(dimensions: tuple[str, ...], source: str, extra: str = "") -> str:
    return "long AS (" + " UNION ALL ".join(
        f"SELECT {extra} '{d}' AS dimension, cast(\"{d}\" as varchar) AS value, y_true, y_prob FROM {source}"
        for d in dimensions
    ) + ")"


def group_sql(keys: str, cut: str) -> str:
    """Counts and ranking sums of the long table by (keys, dimension, value)."""
    return f"""{CURVE.format(k=keys, p="y_prob", t="long")},
rank_sums AS (SELECT {keys}, {PR_AUC} AS pr_auc, {ROC_AUC} AS roc_auc FROM curve GROUP BY {keys}),
c AS (SELECT {keys}, count(*) AS "count", cast(sum(y_true) as bigint) AS churn_count,
    round(sum(y_true)::double / count(*), 4) AS churn_rate, round(avg(y_prob), 4) AS mean_predicted_probability,
    round(avg((y_prob - y_true) * (y_prob - y_true)), 4) AS brier_score, {confusion_sql("y_prob", "0.5")},
    count(*) FILTER (WHERE y_prob >= {cut}) AS cap_n,
    cast(coalesce(sum(y_true) FILTER (WHERE y_prob >= {cut}), 0) as bigint) AS cap_pos
  FROM long GROUP BY {keys}),
g AS (SELECT * FROM c JOIN rank_sums USING ({keys}))"""


_CUT = "(SELECT cut FROM cap)"
_COMMON = 'dimension, value, "count", churn_count, churn_rate, mean_predicted_probability, pr_auc, roc_auc, brier_score'
FAIRNESS_COLUMNS = f"""{r4(ratio("tp + fp", '"count"'))} AS selection_rate, {r4(RECALL)} AS tpr,
  {r4(ratio("fp", "(fp + tn)"))} AS fpr, {r4(ratio("cap_n", '"count"'))} AS capacity_selection_rate"""


@query(
    "g12_segment_metrics",
    f"""WITH {SCORED_CTE}, {capacity_sql("", "y_prob", "scored")}, {long_sql(SEGMENTS, "scored")},
{group_sql("dimension, value", _CUT)}
SELECT {_COMMON}, {r4(ACCURACY)} AS accuracy,
  CASE WHEN pr_auc IS NULL THEN 0.0::double ELSE {r4(F1)} END AS f1_score,
  cap_n AS selected_count_at_capacity, {r4(ratio("cap_pos", "cap_n"))} AS precision_at_capacity,
  {r4(ratio("cap_pos", "churn_count"))} AS recall_at_capacity FROM g""",
)
def segment_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir)
    cut = capacity.capacity_cut(score_table(rows, decimals=SCORE_DECIMALS), CAPACITY)
    return segments.segment_metrics(by_dimension(rows, SEGMENTS, decimals=SCORE_DECIMALS), 0.5, cut)


def _subgroups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir)
    cut = capacity.capacity_cut(score_table(rows, decimals=SCORE_DECIMALS), CAPACITY)
    return segments.fairness_metrics(by_dimension(rows, SENSITIVE, decimals=SCORE_DECIMALS), 0.5, cut)


@query(
    "g13_fairness_subgroups",
    f"""WITH {SCORED_CTE}, {capacity_sql("", "y_prob", "scored")}, {long_sql(SENSITIVE, "scored")},
{group_sql("dimension, value", _CUT)}
SELECT {_COMMON}, {FAIRNESS_COLUMNS} FROM g""",
)
def fairness_subgroups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subgroups(spark, sf_dir)


DISPARITY_COLUMNS = f"""round(max(selection_rate) - min(selection_rate), 4) AS demographic_parity_difference,
  {r4(ratio("min(selection_rate)", "max(selection_rate)", "1.0"))} AS demographic_parity_ratio,
  round(max(tpr) - min(tpr), 4) AS equalized_odds_tpr_difference,
  round(max(fpr) - min(fpr), 4) AS equalized_odds_fpr_difference,
  round(max(brier_score) - min(brier_score), 4) AS brier_score_disparity"""


@query(
    "g14_fairness_disparities",
    f"""WITH {SCORED_CTE}, {capacity_sql("", "y_prob", "scored")}, {long_sql(SENSITIVE, "scored")},
{group_sql("dimension, value", _CUT)}, f AS (SELECT {_COMMON}, {FAIRNESS_COLUMNS} FROM g)
SELECT dimension, {DISPARITY_COLUMNS} FROM f GROUP BY dimension HAVING count(*) >= 2""",
)
def fairness_disparities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.fairness_disparities(_subgroups(spark, sf_dir))


# --- several models and splits ------------------------------------------------------

SPLIT_SQL = """CASE WHEN pos < 40265318 THEN 'test' WHEN pos < 80530637 THEN 'val' ELSE 'train' END"""
SUITE_CTE = f"""{SCORED_CTE},
dealt AS (SELECT *, {SPLIT_SQL} AS split FROM (SELECT *, cast(concat('0x', substr(md5(concat_ws('|', '42', l_orderkey, l_partkey,
    l_suppkey, l_linenumber)), 1, 7)) as bigint) AS pos FROM scored)),
models AS (SELECT * EXCLUDE (y_prob), 'champion' AS model, y_prob FROM dealt
  UNION ALL SELECT * EXCLUDE (y_prob), 'challenger' AS model, rival_prob AS y_prob FROM dealt)"""
SUMMARY_CTE = f"""{CURVE.format(k="model, split", p="y_prob", t="models")},
rank_sums AS (SELECT model, split, {PR_AUC} AS pr_auc, {ROC_AUC} AS roc_auc FROM curve GROUP BY model, split),
counts AS (SELECT model, split, {confusion_sql("y_prob", "0.5")},
   round(avg((y_prob - y_true) * (y_prob - y_true)), 4) AS brier_score FROM models GROUP BY model, split),
{capacity_sql("model, split", "y_prob", "models")},
summary AS (SELECT model, split, pr_auc, roc_auc, {r4(PRECISION)} AS precision, {r4(RECALL)} AS recall,
  {r4(F1)} AS f1_score, {r4(ACCURACY)} AS accuracy, brier_score, 0.5::double AS threshold, tn, fp, fn, tp,
  {CAPACITY}::double AS campaign_capacity_fraction, num_targeted_customers, total_customers,
  {r4(ratio("captured", "num_targeted_customers"))} AS precision_at_capacity,
  {r4(ratio("captured", "all_pos"))} AS recall_at_capacity, round(cut, 4) AS capacity_threshold,
  captured AS retained_churners_captured, all_pos AS total_actual_churners
  FROM rank_sums JOIN counts USING (model, split) JOIN cap USING (model, split))"""
PARITY_CTE = f"""rates AS (SELECT model, split, gender, round(avg(CASE WHEN y_prob >= 0.5 THEN 1.0 ELSE 0.0 END), 4) AS rate
  FROM models GROUP BY model, split, gender),
parity AS (SELECT model, split, round(max(rate) - min(rate), 4) AS dp FROM rates GROUP BY model, split)"""


def _evaluation(spark: SparkSession, sf_dir: str) -> suite.Evaluation:
    rows = hash_split(scored(spark, sf_dir), ROW_KEY)
    return suite.evaluate_suite(
        rows,
        MODELS,
        ROW_KEY,
        fraction=CAPACITY,
        segment_dimensions=SEGMENTS,
        sensitive_dimensions=SENSITIVE,
        decimals=SCORE_DECIMALS,
    )


@query("g15_full_suite", f"WITH {SUITE_CTE}, {SUMMARY_CTE} SELECT * FROM summary")
def full_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluation(spark, sf_dir).summary




@query(
    "g15_suite_subgroups",
    f"""WITH {SUITE_CTE}, {capacity_sql("model, split", "y_prob", "models")},
long AS (SELECT l.*, cut FROM (SELECT model, split, 'gender' AS dimension, gender AS value, y_true, y_prob FROM models
    UNION ALL SELECT model, split, 'SeniorCitizen', cast("SeniorCitizen" as varchar), y_true, y_prob FROM models) l
  JOIN cap USING (model, split)),
{group_sql("model, split, dimension, value", "cut")}
SELECT model, split, {_COMMON}, {FAIRNESS_COLUMNS} FROM g""",
)
def suite_subgroups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluation(spark, sf_dir).subgroups


def _side(model: str, metric: str) -> str:
    return f"max(CASE WHEN model = '{model}' THEN {metric} END)"


_COMPARE_COLUMNS = ", ".join(
    f"{_side(m, metric)} AS {m}_{metric}" for m in MODELS for metric in suite.SUMMARY_METRICS
)
_DIFFERENCES = ", ".join(
    f"round({_side('challenger', m)} - {_side('champion', m)}, 4) AS {m}_diff"
    for m in ("pr_auc", "roc_auc", "brier_score", "precision_at_capacity", "recall_at_capacity")
)
COMPARE_CTE = f"""{SUITE_CTE}, {SUMMARY_CTE}, {PARITY_CTE},
compared AS (SELECT split, max(total_customers) AS sample_size, count(DISTINCT model) AS models_present, {_COMPARE_COLUMNS},
  {_DIFFERENCES}, round({_side("challenger", "dp")} - {_side("champion", "dp")}, 4) AS parity_change
  FROM summary JOIN parity USING (model, split) GROUP BY split)"""


def _comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suite.compare_models(_evaluation(spark, sf_dir), "champion", "challenger")


@query("g16_model_comparison", f"WITH {COMPARE_CTE} SELECT * FROM compared")
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparison(spark, sf_dir)


# Every fifth label and every seventh score is missing.
_HOLES_CTE = f"""{SCORED_CTE}, holed AS (SELECT 'all' AS scope, CASE WHEN l_orderkey % 5 <> 0 THEN y_true END AS y_true,
  CASE WHEN l_orderkey % 7 <> 0 THEN y_prob END AS y_prob FROM scored),
known AS (SELECT * FROM holed WHERE y_true IS NOT NULL AND y_prob IS NOT NULL)"""


def _holed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select(
        F.when(F.col("l_orderkey") % 5 != 0, F.col("y_true")).alias("y_true"),
        F.when(F.col("l_orderkey") % 7 != 0, F.col("y_prob")).alias("y_prob"),
    )


@query(
    "g03_missing_labels_and_scores",
    f"""WITH {_HOLES_CTE}, {CURVE.format(k="scope", p="y_prob", t="known")}, r AS (SELECT {PR_AUC} AS pr_auc, {ROC_AUC} AS roc_auc FROM curve),
c AS (SELECT {confusion_sql("y_prob", "0.5")} FROM known)
SELECT pr_auc, roc_auc, tn, fp, fn, tp, (SELECT count(*) FROM holed) AS rows, (SELECT count(*) FROM holed) - (SELECT count(*) FROM known) AS skipped FROM r, c""",
)
def missing_labels_and_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without label or score are in no metric and are counted."""
    rows = _holed(spark, sf_dir)
    metrics = classification.binary_metrics(score_table(rows)).select("pr_auc", "roc_auc", "tn", "fp", "fn", "tp")
    return side_by_side(metrics, skipped_rows(rows))


@query(
    "g17_acceptance_gates",
    f"""WITH {COMPARE_CTE} SELECT split AS selection_split, sample_size AS selection_sample_size, pr_auc_diff,
  brier_score_diff, parity_change, pr_auc_diff >= 0.01 AS pr_auc_gate_passed,
  brier_score_diff <= 0.02 AS calibration_gate_passed, parity_change <= 0.05 AS fairness_gate_passed,
  models_present = 2 AS operational_gate_passed,
  (pr_auc_diff >= 0.01 AND brier_score_diff <= 0.02 AND parity_change <= 0.05 AND models_present = 2) AS all_gates_passed
FROM compared WHERE split = 'val'""",
)
def acceptance_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suite.acceptance_gates(_comparison(spark, sf_dir))


@query(
    "g18_decision_record",
    f"""WITH {COMPARE_CTE}, gate AS (SELECT pr_auc_diff, (pr_auc_diff >= 0.01 AND brier_score_diff <= 0.02 AND parity_change <= 0.05 AND models_present = 2) AS passed
  FROM compared WHERE split = 'val')
SELECT CASE WHEN passed THEN 'challenger' ELSE 'champion' END AS selected_model_name, passed AS all_gates_passed, 'val' AS selection_split,
  'test' AS evaluation_split, 'champion|challenger' AS models_compared, pr_auc_diff AS gate_pr_auc_diff,
  (SELECT sample_size FROM compared WHERE split = 'test') AS report_sample_size, true AS has_segments FROM gate""",
)
def decision_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record parsed again: its fields must agree with comparison and gates."""
    evaluation = _evaluation(spark, sf_dir)
    comparison = suite.compare_models(evaluation, "champion", "challenger")
    row = suite.decision_record(evaluation, comparison, "champion", "challenger")

    def of(path: str):
        return F.get_json_object("record", "$." + path)

    compared = F.from_json(of("models_compared"), "array<string>")
    return row.select(
        of("selected_model_name").alias("selected_model_name"),
        "all_gates_passed",
        of("selection_split").alias("selection_split"),
        of("evaluation_split").alias("evaluation_split"),
        F.array_join(compared, "|").alias("models_compared"),
        of("acceptance_gates.pr_auc_diff").cast("double").alias("gate_pr_auc_diff"),
        of("metrics_summary[0].sample_size").cast("bigint").alias("report_sample_size"),
        (of("segment_analysis[0]").isNotNull() & of("fairness_review[0]").isNotNull()).alias("has_segments"),
    )


@query(
    "e08_roc_points",
    f"""WITH {SCORED_CTE}, {CURVE.format(k="line_status", p="y_prob", t="scored")}
SELECT line_status, p AS threshold, round((cum_n - cum_pos)::double / (all_n - all_pos)::double, 4) AS fpr,
  round(cum_pos::double / all_pos::double, 4) AS tpr FROM curve""",
)
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.roc_points(by_status(spark, sf_dir))


@query(
    "e09_precision_recall_points",
    f"""WITH {SCORED_CTE}, {CURVE.format(k="line_status", p="y_prob", t="scored")}
SELECT line_status, p AS threshold, round(cum_pos::double / cum_n::double, 4) AS precision,
  round(cum_pos::double / all_pos::double, 4) AS recall, round(all_pos::double / all_n::double, 4) AS no_skill FROM curve""",
)
def precision_recall_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.precision_recall_points(by_status(spark, sf_dir))


@query(
    "e10_evaluation_charts",
    f"""WITH {SCORED_CTE}, e AS (SELECT [{_EDGES}]::double[] AS edges),
b AS (SELECT y_true, y_prob, cast(len(list_filter(edges, lambda x: x < y_prob)) as int) AS bin FROM scored, e),
t AS (SELECT unnest([{_THRESHOLDS}])::double AS threshold),
c AS (SELECT threshold, {confusion_sql("y_prob", "threshold")} FROM scored, t GROUP BY threshold),
m AS (SELECT {confusion_sql("y_prob", "0.5")} FROM scored)
SELECT 'reliability' AS chart, cast(bin as varchar) AS series, round(avg(y_prob), 4) AS x, round(avg(y_true), 4) AS y FROM b GROUP BY bin
UNION ALL SELECT 'threshold', 'precision', threshold, {r4(PRECISION)} FROM c
UNION ALL SELECT 'threshold', 'recall', threshold, {r4(RECALL)} FROM c
UNION ALL SELECT 'threshold', 'f1_score', threshold, {r4(F1)} FROM c
UNION ALL SELECT 'confusion', 'tn', 0.0, tn::double FROM m UNION ALL SELECT 'confusion', 'fp', 0.0, fp::double FROM m
UNION ALL SELECT 'confusion', 'fn', 0.0, fn::double FROM m UNION ALL SELECT 'confusion', 'tp', 0.0, tp::double FROM m""",
)
def evaluation_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the reliability, threshold and confusion charts in one long table."""
    whole = score_table(scored(spark, sf_dir), decimals=SCORE_DECIMALS).histogram()
    reliability = calibration.calibration_uniform(whole, 10).select(
        F.lit("reliability").alias("chart"),
        F.col("bin").cast("string").alias("series"),
        F.col("prob_pred").alias("x"),
        F.col("prob_true").alias("y"),
    )
    sweep = classification.threshold_sweep(whole).unpivot(
        ["threshold"], ["precision", "recall", "f1_score"], "series", "y"
    ).select(F.lit("threshold").alias("chart"), "series", F.col("threshold").alias("x"), "y")
    cells = classification.confusion_matrix(whole, 0.5).unpivot(
        [], ["tn", "fp", "fn", "tp"], "series", "y"
    ).select(
        F.lit("confusion").alias("chart"), "series", F.lit(0.0).alias("x"), F.col("y").cast("double").alias("y")
    )
    return reliability.unionByName(sweep).unionByName(cells)
