"""Operational metrics, alerts, redaction, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.contract_checks import REPORT_CTE
from catalog.drift_checks import CATEGORICAL, FEATURES_CTE, NUMERIC
from catalog.model_checks import BATCH, SCORED_AT, VERSION
from catalog.registry import query
from catalog.standins import (
    FORMULA_SQL,
    RAW_CTE,
    SNAPSHOT_CTE,
    SNAPSHOT_FORMULA,
    late_labels,
    order_halves,
    predictions,
    raw_snapshot,
    snapshot,
    table,
)
from riskspark.functions.redaction import redact_columns, redact_json
from riskspark.models.scoring import score_batch
from riskspark.operators import drift, monitoring, quality
from riskspark.operators.contract import CUSTOMER_CONTRACT, validation_errors, validation_report
from riskspark.session import new_scratch_path
from riskspark.sources.manifest import file_checksums, source_manifest
from riskspark.sources.sinks import quarantine_batch, read_scored, write_one_file, write_report, write_scored
from riskspark.sources.tables import as_table, load_scoring_batch, load_training_table, read_table

# Event values stand in for latencies of up to some hundred milliseconds.
LATENCY_CTE = "calls AS (SELECT ts, event_type, value / 1000.0::double AS latency FROM events)"


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("latency", F.col("value") / 1000.0)


def _failed():
    return F.col("event_type") == "error"


@query(
    "j01_request_rate",
    """SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start, event_type, count(*) AS requests,
  round(count(*) / 60.0::double, 4) AS rate_per_second FROM events GROUP BY 1, 2""",
)
def request_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.request_rates(table(spark, sf_dir, "events"), "ts", ["event_type"])


def quantile_sql(q: float) -> str:
    edges = monitoring.LATENCY_BUCKETS
    branches = []
    for i, upper in enumerate(edges):
        below, lower = (f"b{i - 1}", edges[i - 1]) if i else ("0", 0.0)
        width = repr(float(upper) - float(lower))
        branches.append(
            f"WHEN b{i} >= requests * {q}::double THEN {lower}::double + {width}::double * "
            f"CASE WHEN b{i} - {below} <> 0 THEN (requests * {q}::double - {below}) / (b{i} - {below})::double ELSE 0 END"
        )
    return "round(CASE " + " ".join(branches) + f" ELSE {edges[-1]}::double END, 4)"


_BUCKETS = ", ".join(
    f"count(*) FILTER (WHERE latency <= {e}::double) AS b{i}" for i, e in enumerate(monitoring.LATENCY_BUCKETS)
)


@query(
    "j02_latency_quantiles",
    f"""WITH {LATENCY_CTE}, c AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, event_type, count(*) AS requests, {_BUCKETS} FROM calls GROUP BY 1, 2)
SELECT window_start, event_type, requests, {quantile_sql(0.95)} AS p95, {quantile_sql(0.99)} AS p99 FROM c""",
)
def latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.latency_quantiles(_calls(spark, sf_dir), "ts", "latency", ["event_type"])


@query(
    "j03_prediction_volume",
    """SELECT CASE WHEN round((n_chars % 9000 + 500) / 10000.0::double, 4) >= 0.5 THEN 1 ELSE 0 END AS predicted_class, source AS model_version,
  count(*) AS predictions FROM documents GROUP BY 1, 2""",
)
def prediction_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = predictions(spark, sf_dir).withColumn(
        "predicted_class", (F.col("churn_probability") >= 0.5).cast("int")
    )
    return monitoring.prediction_volume(rows)


@query(
    "j04_batch_counters",
    f"""WITH {RAW_CTE}, {REPORT_CTE}, v AS (SELECT *, greatest(0, total_rows - error_records) AS ok FROM report),
clean AS (SELECT count(*) AS n FROM history)
SELECT cast(1 as bigint) AS batches_success, cast(1 as bigint) AS batches_rejected, ok + n AS records_accepted,
  total_rows - ok AS records_rejected, error_records AS validation_failures FROM v, clean""",
)
def batch_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters over the reports of one clean and one defective batch."""
    return monitoring.batch_counters(_reports(spark, sf_dir))


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(snapshot(spark, sf_dir), CUSTOMER_CONTRACT, True).unionByName(
        quality.quality_report(raw_snapshot(spark, sf_dir), CUSTOMER_CONTRACT, True)
    )


@query(
    "j05_failure_counts",
    """SELECT event_type, count(*) FILTER (WHERE event_type = 'error') AS failures, count(*) AS events FROM events GROUP BY event_type""",
)
def failure_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.failure_counts(table(spark, sf_dir, "events"), "event_type", _failed())


@query(
    "j06_alerts",
    f"""WITH {RAW_CTE}, {REPORT_CTE}, v AS (SELECT *, greatest(0, total_rows - error_records) AS ok FROM report),
q AS (SELECT round((total_rows - ok)::double / total_rows, 4) AS rejection_rate FROM v), {FEATURES_CTE},
w AS (SELECT time_bucket(INTERVAL '5 minutes', ts) AS s, count(*) FILTER (WHERE event_type = 'error') AS f, count(*) AS n FROM events GROUP BY 1)
SELECT 'High_Prediction_Error_Rate' AS alert, 'P1' AS severity, strftime(s, '%Y-%m-%d %H:%M:%S') AS subject, round(f::double / n, 4) AS measured FROM w WHERE f::double / n > 0.05
UNION ALL SELECT 'High_Validation_Failure_Rate', 'P2', 'batch', rejection_rate FROM q WHERE rejection_rate > 0.05
UNION ALL SELECT 'Significant_Data_Drift', 'P2', feature, psi FROM features WHERE drift_status = 'significant_drift'
UNION ALL SELECT 'Model_Load_Failure', 'P1', 'error', n::double FROM (SELECT count(*) AS n FROM events WHERE event_type = 'error') e WHERE n > 0""",
)
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    reference, current = order_halves(spark, sf_dir)
    failures = monitoring.failure_counts(events, "event_type", _failed())
    return (
        monitoring.error_rate_alerts(monitoring.error_rates(events, "ts", _failed()))
        .unionByName(monitoring.rejection_alerts(_reports(spark, sf_dir)))
        .unionByName(
            monitoring.drift_alerts(drift.feature_drift(current, reference, NUMERIC, CATEGORICAL))
        )
        .unionByName(monitoring.load_failure_alerts(failures, "event_type", "error"))
    )


# --- redaction ------------------------------------------------------------------------


@query(
    "b11_redact_json",
    """SELECT event_id, concat('{"Name":"[REDACTED]","k":', json_extract(props, '$.k'), '}') AS payload_text FROM events""",
)
def redact_json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties with an added name, masked inside the JSON text."""
    named = F.regexp_replace("props", r"^\{", '{"Name": "user", ')
    return table(spark, sf_dir, "events").select("event_id", redact_json(named).alias("payload_text"))


@query(
    "b11_redact_nested_json",
    """SELECT event_id, concat('{"a":{"email":"[REDACTED]","n":', event_id, '},"list":[{"Address":"[REDACTED]","t":"', event_type, '"},1.5,null,true],"payload":"[REDACTED]"}') AS payload_text FROM events""",
)
def redact_nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensitive keys inside objects, arrays and above whole objects; other values keep their types."""
    text = F.format_string(
        '{"a": {"email": "x@y", "n": %d}, "list": [{"Address": 7, "t": "%s"}, 1.5, null, true], "payload": {"k": [1]}}',
        "event_id",
        "event_type",
    )
    return table(spark, sf_dir, "events").select("event_id", redact_json(text).alias("payload_text"))


@query(
    "b11_redact_typed_maps",
    """SELECT c_custkey, '[REDACTED]' AS number_masked, cast(c_nationkey as varchar) AS number_kept, '[REDACTED]' AS struct_masked,
  concat('{"segment":"', c_mktsegment, '","email":"[REDACTED]"}') AS struct_kept FROM customer""",
)
def redact_typed_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps whose values are numbers or structs are masked by key as well."""
    inner = F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("email"))
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.create_map(F.lit("customer_id"), F.col("c_nationkey"), F.lit("k"), F.col("c_nationkey")).alias("numbers"),
        F.create_map(F.lit("Email"), inner, F.lit("k"), inner).alias("structs"),
    )
    return redact_columns(rows).select(
        "c_custkey",
        F.col("numbers.customer_id").alias("number_masked"),
        F.col("numbers.k").alias("number_kept"),
        F.col("structs.Email").alias("struct_masked"),
        F.col("structs.k").alias("struct_kept"),
    )


@query(
    "b11_redact_columns",
    """SELECT c_custkey, '[REDACTED]' AS "Gender", c_mktsegment AS inner_segment, '[REDACTED]' AS inner_email,
  '[REDACTED]' AS tag_name, c_mktsegment AS tag_other FROM customer""",
)
def redact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-level, struct and map values under sensitive keys."""
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_name").alias("Gender"),
        F.array(
            F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("email"))
        ).alias("inner"),
        F.create_map(F.lit("NAME"), F.col("c_name"), F.lit("other"), F.col("c_mktsegment")).alias("tags"),
    )
    clean = redact_columns(rows)
    return clean.select(
        "c_custkey",
        "Gender",
        F.col("inner")[0]["segment"].alias("inner_segment"),
        F.col("inner")[0]["email"].alias("inner_email"),
        F.col("tags")["NAME"].alias("tag_name"),
        F.col("tags")["other"].alias("tag_other"),
    )


# --- sources and sinks ------------------------------------------------------------------


def _as_csv(df: DataFrame, spark: SparkSession, label: str) -> str:
    path = new_scratch_path(spark, label)
    # Blanks are data here; the writer would trim them by default.
    df.write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


@query("a01_read_training_csv", f"WITH {SNAPSHOT_CTE} SELECT * FROM snapshot")
def read_training_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot through CSV: read as text, validated, typed."""
    path = _as_csv(snapshot(spark, sf_dir), spark, "training")
    return load_training_table(spark, path, CUSTOMER_CONTRACT)


@query("a02_read_scoring_csv", f"WITH {RAW_CTE} SELECT * FROM raw")
def read_scoring_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw batch through CSV keeps its defects, and its target column, as text."""
    path = _as_csv(raw_snapshot(spark, sf_dir), spark, "batch")
    return load_scoring_batch(spark, path, CUSTOMER_CONTRACT)


@query(
    "a03_read_predictions_and_labels",
    "SELECT d.doc_id, lang, quality AS observed_churn FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def read_predictions_and_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions from a path, labels passed through as a table."""
    path = _as_csv(predictions(spark, sf_dir), spark, "predictions")
    left = as_table(spark, path).select(F.col("doc_id").cast("bigint"), "lang")
    right = as_table(spark, late_labels(spark, sf_dir)).select("doc_id", "observed_churn")
    return left.join(right, "doc_id")


@query(
    "a04_write_scored_batches",
    f"""WITH {SNAPSHOT_CTE}, p AS (SELECT "customerID", round({FORMULA_SQL}, 4) AS churn_probability FROM snapshot)
SELECT *, 'one' AS batch_id FROM p UNION ALL SELECT *, 'two' FROM p""",
)
def write_scored_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch 'one' written twice and batch 'two' once: each is there once."""
    path = new_scratch_path(spark, "scores")
    for batch_id in ("one", "two", "one"):
        write_scored(
            score_batch(snapshot(spark, sf_dir), SNAPSHOT_FORMULA, "customerID", 0.5, VERSION, batch_id, SCORED_AT),
            path,
        )
    return read_scored(spark, path).select("customerID", "churn_probability", "batch_id")


@query("a05_quarantine", f"WITH {RAW_CTE} SELECT * FROM raw")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of a rejected batch as kept in quarantine."""
    rows = raw_snapshot(spark, sf_dir)
    errors = validation_errors(rows, CUSTOMER_CONTRACT)
    report = validation_report(rows, CUSTOMER_CONTRACT, errors=errors)
    folder = quarantine_batch(report, errors, rows, new_scratch_path(spark, "quarantine"), BATCH)
    return read_table(spark, f"{folder}/rows")


@query("a06_report_sink", f"WITH {FEATURES_CTE} SELECT feature, psi, drift_status FROM features")
def report_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drift report through the JSON sink."""
    reference, current = order_halves(spark, sf_dir)
    path = new_scratch_path(spark, "report")
    write_report(drift.feature_drift(current, reference, NUMERIC, CATEGORICAL), path)
    return read_table(spark, path, "json").select("feature", "psi", "drift_status")


@query("a07_source_manifest", "SELECT count(*) AS row_count, true AS all_hashed FROM orders")
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data lines over all files of a delivery, each with its checksum."""
    path = _as_csv(table(spark, sf_dir, "orders"), spark, "delivery")
    files = source_manifest(spark, f"{path}/*.csv")
    return files.agg(
        F.sum("row_count").alias("row_count"),
        F.min(F.length("file_sha256") == 64).alias("all_hashed"),
    )


_DELIVERY = "SELECT sha256(string_agg(cast(o_orderkey as varchar), chr(10) ORDER BY o_orderkey) || chr(10)) AS file_sha256, sum(length(cast(o_orderkey as varchar)) + 1) AS file_bytes FROM orders"


@query(
    "a07_file_checksums",
    f"WITH d AS ({_DELIVERY}) SELECT how, file_sha256, cast(file_bytes as bigint) AS file_bytes FROM d, (VALUES ('whole'), ('blocks')) v(how)",
)
def checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 of one delivered file, as one value and block by block."""
    path = new_scratch_path(spark, "checksums")
    ordered = table(spark, sf_dir, "orders").select("o_orderkey").orderBy("o_orderkey")
    file = write_one_file(ordered.select(F.col("o_orderkey").cast("string").alias("value")), path)
    whole = file_checksums(spark, file).withColumn("how", F.lit("whole"))
    blocks = file_checksums(spark, file, whole_bytes=0).withColumn("how", F.lit("blocks"))
    return whole.unionByName(blocks).select("how", "file_sha256", "file_bytes")
