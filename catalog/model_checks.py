"""Splits, fitted constants, model fits and scoring over the snapshot."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import query
from catalog.standins import (
    FORMULA_SQL,
    ROW_KEY,
    SCORED_CTE,
    SNAPSHOT_CTE,
    SNAPSHOT_FORMULA,
    raw_snapshot,
    scored,
    snapshot,
    table,
)
from riskspark.functions.decisions import batch_stamp
from riskspark.models import boosting, newton, preprocessing, training
from riskspark.models.scoring import load_version, save_version, score_batch
from riskspark.operators import split
from riskspark.operators.contract import CUSTOMER_CONTRACT, ContractViolation, typed
from riskspark.plans.scoring_job import ScoringJob, run_batch_scoring
from riskspark.plans.selection import run_selection
from riskspark.session import new_scratch_path
from riskspark.sources.commits import file_system

NUMERIC = preprocessing.NUMERIC_FEATURES
CATEGORICAL = preprocessing.CATEGORICAL_FEATURES
KEY = "customerID"


def split_sql(source: str, stratum: str, seed_hash: str) -> str:
    """Exact stratified split: sizes by ceiling, strata by largest remainder, rows in hash order."""
    return f"""strata AS (SELECT {stratum} AS stratum, count(*) AS size FROM {source} GROUP BY {stratum}),
totals AS (SELECT sum(size) AS n, cast(ceil(round(sum(size) * 0.15::double, 9)) as bigint) AS test_total FROM strata),
t1 AS (SELECT stratum, size, n, test_total, floor(size::double * test_total / n) AS base,
    size::double * test_total / n - floor(size::double * test_total / n) AS rem FROM strata, totals),
t2 AS (SELECT *, cast(base + CASE WHEN row_number() OVER (ORDER BY rem DESC, stratum) <= test_total - sum(base) OVER () THEN 1 ELSE 0 END as bigint) AS test_n FROM t1),
v0 AS (SELECT stratum, size, test_n, size - test_n AS rest, n - test_total AS rest_n,
    cast(ceil(round((n - test_total) * (0.15::double / 0.85::double), 9)) as bigint) AS val_total FROM t2),
v1 AS (SELECT *, floor(rest::double * val_total / rest_n) AS base, rest::double * val_total / rest_n - floor(rest::double * val_total / rest_n) AS rem FROM v0),
quotas AS (SELECT stratum, size, test_n, cast(base + CASE WHEN row_number() OVER (ORDER BY rem DESC, stratum) <= val_total - sum(base) OVER () THEN 1 ELSE 0 END as bigint) AS val_n FROM v1),
split AS (SELECT s.*, CASE WHEN rn <= test_n THEN 'test' WHEN rn <= test_n + val_n THEN 'val' ELSE 'train' END AS split FROM (
  SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY {seed_hash}) AS rn FROM {source}) s JOIN quotas ON {stratum} = stratum)"""


SNAPSHOT_SPLIT = split_sql("snapshot", '"Churn"', "md5(concat_ws('|', '42', \"customerID\"))")


@query(
    "f01_stratified_split",
    f'WITH {SNAPSHOT_CTE}, {SNAPSHOT_SPLIT} SELECT "customerID", "Churn", split FROM split',
)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.exact_split(snapshot(spark, sf_dir), [KEY], "Churn").select(KEY, "Churn", "split")


@query(
    "f01_stratified_split_large",
    f"""WITH {SCORED_CTE}, {split_sql("scored", "y_true", "md5(concat_ws('|', '42', l_orderkey, l_partkey, l_suppkey, l_linenumber))")}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, y_true, split FROM split""",
)
def stratified_split_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir).select(*ROW_KEY, "y_true")
    return split.exact_split(rows, ROW_KEY, "y_true")


@query(
    "f01_hash_split",
    """SELECT l_orderkey, l_linenumber, CASE WHEN pos < 40265318 THEN 'test' WHEN pos < 80530637 THEN 'val' ELSE 'train' END AS split FROM (
  SELECT l_orderkey, l_linenumber, cast(concat('0x', substr(md5(concat_ws('|', '42', l_orderkey, l_partkey, l_suppkey, l_linenumber)), 1, 7)) as bigint) AS pos
  FROM lineitem) x""",
)
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.hash_split(scored(spark, sf_dir), ROW_KEY).select("l_orderkey", "l_linenumber", "split")


@query(
    "f02_evaluation_partition",
    f"""WITH {SNAPSHOT_CTE}, {SNAPSHOT_SPLIT} SELECT "customerID" FROM split WHERE split = 'val'""",
)
def evaluation_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split.exact_split(snapshot(spark, sf_dir), [KEY], "Churn")
    return split.partition_of(rows, "val").select(KEY)


_TRAIN = f"{SNAPSHOT_CTE}, {SNAPSHOT_SPLIT}, train AS (SELECT * FROM split WHERE split = 'train')"
_NUMERIC_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, \"{c}\"::double AS value FROM train" for c in NUMERIC
)
_CATEGORY_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, \"{c}\" AS category FROM train" for c in CATEGORICAL
)


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.partition_of(split.exact_split(snapshot(spark, sf_dir), [KEY], "Churn"), "train")


@query(
    "f03_impute_and_scale",
    f"""WITH {_TRAIN}, long AS ({_NUMERIC_LONG}),
med AS (SELECT feature, quantile_cont(value, 0.5) AS median FROM long WHERE value IS NOT NULL GROUP BY feature)
SELECT feature, round(any_value(median), 4) AS median, round(avg(coalesce(value, median)), 4) AS mean, round(stddev_pop(coalesce(value, median)), 4) AS std
FROM long JOIN med USING (feature) GROUP BY feature""",
)
def impute_and_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    constants = preprocessing.numeric_constants(_train(spark, sf_dir), NUMERIC)
    return constants.select("feature", *[F.round(c, 4).alias(c) for c in ("median", "mean", "std")])


@query(
    "f04_modes",
    f"""WITH {_TRAIN}, long AS ({_CATEGORY_LONG}), n AS (SELECT feature, category, count(*) AS n FROM long WHERE category IS NOT NULL GROUP BY ALL)
SELECT feature, category AS mode FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, category) AS rn FROM n) r WHERE rn = 1""",
)
def modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocessing.modes(_train(spark, sf_dir), CATEGORICAL)


@query(
    "f04_one_hot_positions",
    f"""WITH {_TRAIN}, long AS ({_CATEGORY_LONG}), n AS (SELECT DISTINCT feature, category FROM long WHERE category IS NOT NULL)
SELECT feature, cast(row_number() OVER (PARTITION BY feature ORDER BY category) - 1 as int) AS position, category FROM n""",
)
def one_hot_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocessing.categories(_train(spark, sf_dir), CATEGORICAL)


_FILLED_LONG = "SELECT feature, category FROM long WHERE category IS NOT NULL UNION ALL SELECT feature, mode FROM long JOIN modes USING (feature) WHERE category IS NULL"
_ORDER_CASE = "CASE feature " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(CATEGORICAL)) + " END"
_SLOTS_CTE = f"""long AS ({_CATEGORY_LONG}), counted AS (SELECT feature, category, count(*) AS n FROM long WHERE category IS NOT NULL GROUP BY ALL),
modes AS (SELECT feature, category AS mode FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, category) AS rn FROM counted) r WHERE rn = 1),
filled AS ({_FILLED_LONG}),
slots AS (SELECT slot, feature, 0.0::double AS mean FROM (VALUES {', '.join(f"({i}, '{c}')" for i, c in enumerate(NUMERIC))}) v(slot, feature)
  UNION ALL SELECT {len(NUMERIC)} - 1 + row_number() OVER (ORDER BY {_ORDER_CASE}, category), concat(feature, '_', category),
    round(count(*)::double / (SELECT count(*) FROM train), 4) FROM filled GROUP BY feature, category)"""


@query("f05_feature_vector", f"WITH {_TRAIN}, {_SLOTS_CTE} SELECT cast(slot as int) AS slot, feature, mean FROM slots")
def feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and mean of each slot of the assembled training vector; scaled numbers have mean zero."""
    train = _train(spark, sf_dir)
    fitted = preprocessing.fit_preprocessing(train, NUMERIC, CATEGORICAL)
    model = Pipeline(stages=preprocessing.encoding_stages(fitted)).fit(train)
    names = training.feature_names(model)
    slots = model.transform(train).select(F.posexplode(vector_to_array("features")).alias("slot", "value"))
    labels = F.array(*[F.lit(n) for n in names])
    # Adding zero turns a negative zero into zero.
    mean = F.round(F.avg("value"), 4) + F.lit(0.0)
    return slots.groupBy("slot").agg(mean.alias("mean")).select(
        "slot", F.element_at(labels, F.col("slot") + 1).alias("feature"), "mean"
    )


def _trained(spark: SparkSession, sf_dir: str, spec: training.ModelSpec) -> training.TrainedModel:
    return training.train_model(snapshot(spark, sf_dir), spec)


@query("f06_logistic_regression")
def logistic_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficient, magnitude and odds ratio of every slot; its stationarity is a test."""
    trained = _trained(spark, sf_dir, training.ModelSpec())
    return training.feature_importance(trained.model, trained.rows)


_NEWTON = """SELECT k + 1 AS k,
    b0 + (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det AS b0,
    b1 + (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det AS b1,
    b2 + (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det AS b2
  FROM (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det FROM (
    SELECT k, b0, b1, b2, sum(w) AS h00, sum(w * x1) AS h01, sum(w * x2) AS h02, sum(w * x1 * x1) + 1 AS h11, sum(w * x1 * x2) AS h12,
      sum(w * x2 * x2) + 1 AS h22, sum(y - p) AS g0, sum((y - p) * x1) - b1 AS g1, sum((y - p) * x2) - b2 AS g2
    FROM (SELECT *, p * (1 - p) AS w FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM newton, points WHERE k < 8) a) c GROUP BY k, b0, b1, b2) d) e"""


@query(
    "f06_newton_steps",
    f"""WITH RECURSIVE points AS (SELECT l_quantity / 50.0::double AS x1, l_discount * 10.0::double AS x2, CASE WHEN l_returnflag = 'R' THEN 1.0::double ELSE 0.0::double END AS y FROM lineitem),
newton AS (SELECT 0 AS k, 0.0::double AS b0, 0.0::double AS b1, 0.0::double AS b2 UNION ALL {_NEWTON}),
last AS (SELECT * FROM newton WHERE k = 8)
SELECT '(intercept)' AS feature, round(b0, 4) AS coefficient, round(exp(b0), 4) AS odds_ratio FROM last
UNION ALL SELECT 'quantity', round(b1, 4), round(exp(b1), 4) FROM last UNION ALL SELECT 'discount', round(b2, 4), round(exp(b2), 4) FROM last""",
)
def newton_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients of a fit over all line items; the SQL replays its steps."""
    points = table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") / 50).alias("quantity"),
        (F.col("l_discount") * 10).alias("discount"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
    )
    fitted = newton.fit_logistic(points, ["quantity", "discount"], "y").frame(spark)
    return fitted.select("feature", *[F.round(c, 4).alias(c) for c in ("coefficient", "odds_ratio")])


@query("f07_gradient_boosting")
def gradient_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability and class of every row after all published rounds."""
    spec = training.ModelSpec("candidate_gradient_boosting", "GradientBoosting")
    trained = _trained(spark, sf_dir, spec)
    return training.predict(trained.model, trained.rows).select(KEY, "split", "churn_probability", "churn_prediction")


@query("f08_histogram_boosting")
def histogram_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability and class of every row after as many rounds and as deep trees as the published candidate has."""
    published = {"max_iter": 100, "max_depth": 3, "learning_rate": 0.05}
    trained = _trained(spark, sf_dir, training.ModelSpec("candidate_histogram", "HistGradientBoosting", published))
    return training.predict(trained.model, trained.rows).select(KEY, "split", "churn_probability", "churn_prediction")


_LINES = ("l_quantity", "l_discount", "l_linenumber", "l_extendedprice", "known_tax")
_LINES_LONG = " UNION ALL ".join(f"SELECT '{c}' AS feature, cast({c} as double) AS v, y FROM lines" for c in _LINES)
_GAIN = "(gl * gl / hl + gr * gr / hr - g * g / h)"


@query(
    "f08_first_splits",
    f"""WITH lines AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN l_tax END AS known_tax FROM lineitem),
base AS (SELECT avg(y) AS p FROM lines), long AS ({_LINES_LONG}),
sizes AS (SELECT feature, count(DISTINCT v) AS k FROM long GROUP BY feature),
neighbours AS (SELECT feature, (v + lead(v) OVER (PARTITION BY feature ORDER BY v)) / 2 AS edge FROM (SELECT DISTINCT feature, v FROM long WHERE v IS NOT NULL) d),
edges AS (SELECT feature, edge FROM neighbours JOIN sizes USING (feature) WHERE k <= 255 AND edge IS NOT NULL
  UNION SELECT feature, unnest(quantile_cont(v, [{", ".join(repr(i / 255) for i in range(1, 255))}])) FROM long JOIN sizes USING (feature) WHERE k > 255 AND v IS NOT NULL GROUP BY feature),
totals AS (SELECT feature, count(*) AS n, sum(y) AS s, count(*) FILTER (WHERE v IS NULL) AS n0, coalesce(sum(y) FILTER (WHERE v IS NULL), 0) AS s0 FROM long GROUP BY feature),
below AS (SELECT feature, edge, count(*) AS nb, sum(y) AS sb FROM edges JOIN long USING (feature) WHERE v <= edge GROUP BY feature, edge
  UNION ALL SELECT feature, NULL, n - n0, s - s0 FROM totals WHERE n0 > 0),
sides AS (SELECT feature, edge, false AS missing_left, nb AS nl, sb AS sl, n, s, n0 FROM below JOIN totals USING (feature)
  UNION ALL SELECT feature, edge, true, nb + n0, sb + s0, n, s, n0 FROM below JOIN totals USING (feature) WHERE n0 > 0 AND edge IS NOT NULL),
sums AS (SELECT *, nl * p - sl AS gl, (n - nl) * p - (s - sl) AS gr, n * p - s AS g, nl * p * (1 - p) AS hl, (n - nl) * p * (1 - p) AS hr, n * p * (1 - p) AS h
  FROM sides, base WHERE nl >= 20 AND n - nl >= 20),
ranked AS (SELECT *, {_GAIN} AS gain, row_number() OVER (PARTITION BY feature ORDER BY round({_GAIN}, 6) DESC, missing_left, edge NULLS LAST) AS rn FROM sums)
SELECT feature, round(edge, 6) AS threshold, CASE WHEN n0 > 0 THEN missing_left ELSE nl >= n - nl END AS missing_left, round(gain, 3) AS gain,
  cast(nl as bigint) AS left_rows, cast(n - nl as bigint) AS right_rows FROM ranked WHERE rn = 1""",
)
def first_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the first tree over all line items chooses from: the best split of each feature, one of them often missing."""
    lines = table(spark, sf_dir, "lineitem").withColumns(
        {
            "y": (F.col("l_returnflag") == "R").cast("int"),
            "known_tax": F.when(F.col("l_shipdate") < "1998-01-01", F.col("l_tax")),
        }
    )
    found = boosting.first_splits(lines, _LINES, "y")
    return found.select(
        "feature",
        F.round("threshold", 6).alias("threshold"),
        "missing_left",
        F.round("gain", 3).alias("gain"),
        "left_rows",
        "right_rows",
    )


@query("f09_train_workflow")
def train_workflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name, type, sizes, accuracies and feature names of a training run."""
    metadata = _trained(spark, sf_dir, training.ModelSpec()).metadata()
    return metadata.withColumn("feature_names", F.array_join("feature_names", "|"))


@query(
    "f09_split_sizes",
    f"""WITH {_TRAIN}, {_SLOTS_CTE} SELECT (SELECT count(*) FROM split WHERE split = 'train') AS train_rows,
  (SELECT count(*) FROM split WHERE split = 'val') AS val_rows, (SELECT count(*) FROM split WHERE split = 'test') AS test_rows,
  string_agg(feature, '|' ORDER BY slot) AS feature_names FROM slots""",
)
def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of the same training run."""
    return train_workflow(spark, sf_dir).select("train_rows", "val_rows", "test_rows", "feature_names")


@query("f10_predict")
def predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained = _trained(spark, sf_dir, training.ModelSpec())
    return training.predict(trained.model, snapshot(spark, sf_dir)).select(KEY, "churn_probability", "churn_prediction")


@query("f11_feature_importance")
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances of a boosted model; ``bar`` marks the longest ones, which the chart shows."""
    spec = training.ModelSpec("candidate_gradient_boosting", "GradientBoosting")
    trained = _trained(spark, sf_dir, spec)
    shown = training.feature_importance(trained.model, trained.rows)
    bars = training.importance_bars(shown).select("feature", F.lit(True).alias("bar"))
    return shown.join(bars, "feature", "left").withColumn("bar", F.coalesce("bar", F.lit(False)))


BATCH, VERSION = "batch_20240101_000000_abc123", "2.1.0"
SCORED_AT = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCORES_SQL = f"""SELECT "customerID", round(p, 4) AS churn_probability, CASE WHEN p >= 0.4 THEN 1 ELSE 0 END AS predicted_class,
  0.4::double AS decision_threshold, '{VERSION}' AS model_version, '{BATCH}' AS batch_id FROM (SELECT "customerID", {FORMULA_SQL} AS p FROM snapshot) s"""


@query("f12_score_batch", f"WITH {SNAPSHOT_CTE} {SCORES_SQL}")
def score_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_batch(
        snapshot(spark, sf_dir), SNAPSHOT_FORMULA, KEY, 0.4, VERSION, BATCH, SCORED_AT
    ).drop("scoring_timestamp")


@query("f13_batch_job", f"WITH {SNAPSHOT_CTE} {SCORES_SQL}")
def batch_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validate, gate, score and write; the written batch is read back."""
    root = new_scratch_path(spark, "job")
    job = ScoringJob(f"{root}/scores", f"{root}/quarantine", threshold=0.4, model_version=VERSION)
    out = run_batch_scoring(
        spark, snapshot(spark, sf_dir), SNAPSHOT_FORMULA, job, BATCH, scored_at=SCORED_AT
    )
    return out.drop("scoring_timestamp")


@query("f14_registered_version")
def registered_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the latest of two stored versions, and those of the model before it was stored."""
    root = new_scratch_path(spark, "models")
    trained = _trained(spark, sf_dir, training.ModelSpec())
    for _ in range(2):
        latest = save_version(spark, trained.model, root, {"name": trained.spec.name})
    model = load_version(spark, root, "latest")
    rows = snapshot(spark, sf_dir)
    stored = score_batch(rows, model, KEY, 0.5, str(latest), BATCH, SCORED_AT)
    direct = score_batch(rows, trained.model, KEY, 0.5, str(latest), BATCH, SCORED_AT)
    direct = direct.select(KEY, F.col("churn_probability").alias("before_storing"))
    return stored.join(direct, KEY).select(KEY, "model_version", "churn_probability", "predicted_class", "before_storing")


@query(
    "b13_batch_stamp",
    f"""WITH {SNAPSHOT_CTE} SELECT "customerID", 0.5::double AS decision_threshold, '{VERSION}' AS model_version,
  cast({int(SCORED_AT.timestamp())} as bigint) AS scoring_second, '{BATCH}' AS batch_id FROM snapshot""",
)
def stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = snapshot(spark, sf_dir).select(KEY, *batch_stamp(0.5, VERSION, BATCH, SCORED_AT))
    return rows.withColumn("scoring_second", F.unix_seconds("scoring_timestamp")).drop("scoring_timestamp")


@query(
    "c16_batch_gate",
    f"WITH {SNAPSHOT_CTE} SELECT 0 AS scored_batches, count(*) AS quarantined_rows FROM "
    + "(SELECT c_custkey FROM history LEFT JOIN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') p ON c_custkey = o_custkey) r",
)
def batch_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw batch is rejected whole: nothing is scored, every row is quarantined."""
    root = new_scratch_path(spark, "gate")
    job = ScoringJob(f"{root}/scores", f"{root}/quarantine")
    try:
        run_batch_scoring(spark, raw_snapshot(spark, sf_dir), SNAPSHOT_FORMULA, job, BATCH)
        scored_batches = 1
    except ContractViolation:
        fs, path = file_system(spark, job.output)
        scored_batches = int(fs.exists(path))
    held = spark.read.parquet(f"{job.quarantine}/batch_id={BATCH}/rows")
    return held.agg(
        F.lit(scored_batches).alias("scored_batches"), F.count(F.lit(1)).alias("quarantined_rows")
    )


@query("g16_trained_selection")
def trained_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic champion against boosted challenger, both fitted on one split: their comparison."""
    selection = run_selection(
        typed(snapshot(spark, sf_dir), CUSTOMER_CONTRACT),
        training.ModelSpec(),
        training.ModelSpec("candidate_gradient_boosting", "GradientBoosting"),
    )
    return selection.comparison
