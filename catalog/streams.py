"""Streams over the driver tables, run until the available data is used up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import query
from catalog.operations import quantile_sql
from catalog.standins import FORMULA_SQL, LINE_CONTRACT, SNAPSHOT_CTE, SNAPSHOT_FORMULA, snapshot, table
from riskspark.operators import monitoring as batch
from riskspark.operators.contract import CUSTOMER_CONTRACT
from riskspark.session import new_scratch_path, written
from riskspark.sources.sinks import read_scored
from riskspark.streaming import labels as label_streams
from riskspark.streaming import monitoring, panes, runs, scoring

DELAY = "10 minutes"


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = table(spark, sf_dir, name).schema
    return runs.file_stream(spark, sf_dir, schema, name_glob=f"{name}.parquet")


def _stored(spark: SparkSession, rows: DataFrame, label: str, files: int) -> DataFrame:
    """Rows written as several files and streamed one file at a time."""
    path = new_scratch_path(spark, label)
    rows.repartition(files).write.parquet(path)
    return runs.file_stream(spark, path, rows.schema, files_per_trigger=1)


def _collected(spark: SparkSession, stream: DataFrame, label: str, partition_by=()) -> DataFrame:
    root = new_scratch_path(spark, label)
    runs.run_to_files(stream, f"{root}/rows", f"{root}/checkpoint", partition_by)
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def _zoneless(df: DataFrame, *columns: str) -> DataFrame:
    """Times back in the zone-less type of the events table."""
    for column in columns:
        df = df.withColumn(column, F.col(column).cast("timestamp_ntz"))
    return df


@query(
    "k01_score_stream",
    f"""WITH {SNAPSHOT_CTE} SELECT "customerID", round({FORMULA_SQL}, 4) AS churn_probability,
  CASE WHEN {FORMULA_SQL} >= 0.5 THEN 1 ELSE 0 END AS predicted_class, sha256(concat_ws('|', "customerID", '1.0.0')) AS correlation_id FROM snapshot""",
)
def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stored(spark, snapshot(spark, sf_dir), "arrivals", 3)
    scored = scoring.score_stream(rows, SNAPSHOT_FORMULA, "customerID")
    return _collected(spark, scored, "scored").select(
        "customerID", "churn_probability", "predicted_class", "correlation_id"
    )


@query(
    "k02_validate_stream",
    """SELECT verdict, count(*) AS n, cast(sum(l_orderkey) as bigint) AS keys FROM (SELECT l_orderkey,
  CASE WHEN l_returnflag NOT IN ('A', 'N') OR l_quantity < 2 OR l_extendedprice < 1000 THEN 'rejected' ELSE 'accepted' END AS verdict FROM lineitem) v GROUP BY verdict""",
)
def validate_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = scoring.judge_stream(_stream(spark, sf_dir, "lineitem"), LINE_CONTRACT, training=True)
    out = _collected(spark, judged, "judged", ["verdict"])
    return out.groupBy("verdict").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys")
    )


# The second batch repeats keys, which only a whole-batch check can see.
@query(
    "k03_gate_stream",
    f"""WITH {SNAPSHOT_CTE} SELECT "customerID", round({FORMULA_SQL}, 4) AS churn_probability FROM snapshot""",
)
def gate_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A clean and a defective micro-batch: only the clean one is scored."""
    root = new_scratch_path(spark, "gate")
    rows = written(snapshot(spark, sf_dir).drop("Churn"), "gate-rows")
    handle = scoring.gate_and_score(
        CUSTOMER_CONTRACT, SNAPSHOT_FORMULA, f"{root}/scores", f"{root}/quarantine"
    )
    runs.arrive_in_turn(
        [rows, rows.unionByName(rows)],
        f"{root}/in",
        lambda stream, more: runs.run_per_batch(stream, handle, f"{root}/checkpoint"),
    )
    return read_scored(spark, f"{root}/scores").select("customerID", "churn_probability")


@query(
    "k04_late_label_join",
    """SELECT p.event_id, p.user_id, o.event_id AS outcome_id, o.value AS outcome_value
FROM events p JOIN events o ON p.user_id = o.user_id AND o.ts >= p.ts AND o.ts <= p.ts + INTERVAL '6 hours'
WHERE p.event_type = 'view' AND o.event_type = 'purchase'""",
)
def late_label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views as predictions, purchases within six hours as their outcomes."""
    return _labelled(spark, sf_dir, F.col("user_id"), "inner")


# Two thirds of the users count as one, so a key holds most rows.
_HOT = "CASE WHEN user_id % 3 > 0 THEN 0 ELSE user_id END"


@query(
    "k04_late_label_outer",
    f"""WITH e AS (SELECT event_id, {_HOT} AS user_id, ts, event_type, value FROM events),
v AS (SELECT * FROM e WHERE event_type = 'view'), b AS (SELECT * FROM e WHERE event_type = 'purchase'),
m AS (SELECT least((SELECT max(ts) FROM v), (SELECT max(ts) FROM b)) - INTERVAL '10 minutes' AS mark),
j AS (SELECT v.event_id, v.user_id, v.ts, b.event_id AS outcome_id, b.value AS outcome_value
  FROM v LEFT JOIN b ON v.user_id = b.user_id AND b.ts >= v.ts AND b.ts <= v.ts + INTERVAL '6 hours')
SELECT event_id, user_id, outcome_id, outcome_value FROM j, m WHERE outcome_id IS NOT NULL OR ts + INTERVAL '6 hours' < mark""",
)
def late_label_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views without a purchase come out when their six hours have passed."""
    return _labelled(spark, sf_dir, F.expr(_HOT), "left_outer")


def _labelled(spark: SparkSession, sf_dir: str, key, how: str) -> DataFrame:
    events = _stream(spark, sf_dir, "events").withColumn("user_id", key)
    asked = events.filter(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    seen = events.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("outcome_id"),
        F.col("user_id"),
        F.col("ts").alias("observed_at"),
        F.col("value").alias("outcome_value"),
    )
    joined = label_streams.match_stream(
        asked, seen, "user_id", "ts", "observed_at", "6 hours", DELAY, DELAY, how
    )
    # Only what is asked for is written.
    return _collected(spark, joined.select("event_id", "user_id", "outcome_id", "outcome_value"), "matched")


@query(
    "k05_latest_per_key",
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) e WHERE rn = 1""",
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-last over a stream of several micro-batches."""
    root = new_scratch_path(spark, "latest")
    stream = _stored(spark, table(spark, sf_dir, "events"), "arrivals", 4)
    runs.run_per_batch(
        stream, label_streams.latest_log(f"{root}/log", "user_id", ["ts", "event_id"]), f"{root}/checkpoint"
    )
    log = spark.read.parquet(f"{root}/log")
    return label_streams.latest_rows(log, "user_id", ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type"
    )


@query(
    "k05_compacted_log",
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) e WHERE rn = 1""",
)
def compacted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log merged into one epoch, and the same events arriving again after it."""
    root, order = new_scratch_path(spark, "compact"), ["ts", "event_id"]
    events = table(spark, sf_dir, "events")
    stream = _stored(spark, events, "compact-arrivals", 4)
    runs.run_per_batch(stream, label_streams.latest_log(f"{root}/log", "user_id", order), f"{root}/checkpoint")
    label_streams.compact_log(spark.read.parquet(f"{root}/log"), "user_id", order, f"{root}/base")
    again = label_streams.latest_log(f"{root}/base", "user_id", order)
    again(events, 1_000_000)
    log = spark.read.parquet(f"{root}/base")
    return label_streams.latest_rows(log, "user_id", order).select("user_id", "event_id", "event_type")


@query(
    "k05_merged_while_running",
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) e WHERE rn = 1""",
)
def merged_while_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published log that is merged after every micro-batch but the last."""
    root, order = new_scratch_path(spark, "published"), ["ts", "event_id"]
    publish = label_streams.published_log(root, "user_id", order)

    def handle(batch: DataFrame, number: int) -> None:
        publish(batch, number)
        if number < 3:
            label_streams.merge_published(spark, root, "user_id", order)

    runs.run_per_batch(_stored(spark, table(spark, sf_dir, "events"), "published-arrivals", 4), handle, f"{root}-checkpoint")
    return label_streams.published_rows(spark, root, "user_id", order).select("user_id", "event_id", "event_type")


@query("k05_first_per_key", "SELECT DISTINCT user_id, event_type FROM events")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First arrival per user and type, with a delay longer than the month of data."""
    stream = label_streams.first_per_key(
        _stream(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", "60 days"
    )
    return _collected(spark, stream, "first").select("user_id", "event_type")


# A window is final once the watermark, the latest time less the delay, has passed its end.
_FINAL = "(SELECT max(ts) - INTERVAL '10 minutes' AS mark FROM events) m"


@query(
    "k06_request_rates",
    f"""SELECT s AS window_start, event_type, n AS requests, round(n / 60.0::double, 4) AS rate_per_second FROM (
  SELECT time_bucket(INTERVAL '1 minute', ts) AS s, event_type, count(*) AS n FROM events GROUP BY 1, 2) w, {_FINAL} WHERE s + INTERVAL '1 minute' <= mark""",
)
def request_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = monitoring.request_rate_stream(_stream(spark, sf_dir, "events"), "ts", ["event_type"], DELAY)
    return _zoneless(_collected(spark, rates, "rates"), "window_start")


@query(
    "k06_sliding_error_rates",
    f"""SELECT s AS window_start, f AS failures, n AS requests, round(f::double / n, 4) AS error_rate FROM (
  SELECT time_bucket(INTERVAL '1 minute', ts) - i * INTERVAL '1 minute' AS s, count(*) FILTER (WHERE event_type = 'error') AS f, count(*) AS n
  FROM events, (SELECT unnest(range(0, 5)) AS i) r GROUP BY 1) w, {_FINAL} WHERE s + INTERVAL '5 minutes' <= mark""",
)
def sliding_error_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = monitoring.error_rate_stream(
        _stream(spark, sf_dir, "events"), "ts", F.col("event_type") == "error", DELAY
    )
    return _zoneless(_collected(spark, stream, "errors"), "window_start")


@query(
    "k06_sessions",
    f"""SELECT user_id, session_start, session_end, events FROM (
  SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end, count(*) AS events FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM (
      SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL '30 minutes' THEN 1 ELSE 0 END AS fresh
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)) a) b GROUP BY user_id, session) s, {_FINAL} WHERE session_end <= mark""",
)
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = monitoring.session_stream(_stream(spark, sf_dir, "events"), "user_id", "ts", DELAY)
    return _zoneless(_collected(spark, stream, "sessions"), "session_start", "session_end")


# Panes: three arrivals by event time, every seventh row of the first two only with the third.


def _arrivals(rows: DataFrame, time: str, key: str, cuts: tuple[str, str]) -> list[DataFrame]:
    """Rows before each cut and after, with every seventh of the earlier ones late."""
    first, second = (F.lit(c).cast("timestamp_ntz") for c in cuts)
    at, late = F.col(time).cast("timestamp_ntz"), F.col(key) % 7 == 0
    parts = ((at < first) & ~late, (at >= first) & (at < second) & ~late, (at >= second) | late)
    return [rows.where(part) for part in parts]


def _panes(spark: SparkSession, arrivals: list[DataFrame], counted: Callable[[DataFrame], DataFrame], label: str) -> DataFrame:
    """Panes of the stream in which each arrival is one micro-batch."""
    root = new_scratch_path(spark, label)
    schema = None

    def run(stream: DataFrame, more: bool) -> None:
        nonlocal schema
        made = counted(stream)
        schema = made.schema
        runs.run_to_files(made, f"{root}/rows", f"{root}/checkpoint", more=more)

    runs.arrive_in_turn(arrivals, f"{root}/in", run)
    return spark.read.schema(schema).parquet(f"{root}/rows")


def _on_time(source: str, time: str, key: str, cuts: tuple[str, str], pane: str, delay: str) -> str:
    """Rows of ``source`` that reach a pane, and ``newest``, the end of the newest pane written.

    A late row comes with the third arrival; panes that the first one's watermark has passed are closed by then.
    """
    end = f"time_bucket(INTERVAL '{pane}', {time}) + INTERVAL '{pane}'"
    return f"""marks AS (SELECT max({time}) FILTER (WHERE {time} < TIMESTAMP '{cuts[0]}' AND {key} % 7 <> 0) - INTERVAL '{delay}' AS closed,
  max({time}) - INTERVAL '{delay}' AS mark FROM {source}),
kept AS (SELECT s.* FROM {source} s, marks WHERE {end} <= mark AND NOT ({key} % 7 = 0 AND {time} < TIMESTAMP '{cuts[1]}' AND {end} <= closed)),
newest AS (SELECT max({end}) AS newest FROM kept)"""


def _window(width: str, time: str) -> str:
    return f"time_bucket(INTERVAL '{width}', {time}, TIMESTAMP '1970-01-01')"


_CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")
_EVENTS_ON_TIME = _on_time("events", "ts", "event_id", _CUTS, "1 minute", DELAY)
_WITHIN = ", ".join(
    f"count(*) FILTER (WHERE value / 1000.0::double <= {e}::double) AS b{i}" for i, e in enumerate(batch.LATENCY_BUCKETS)
)


@query(
    "k06_latency_quantiles",
    f"WITH {_EVENTS_ON_TIME} "
    + " UNION ALL ".join(
        f"""SELECT {m} AS minutes, window_start, event_type, requests, {quantile_sql(0.95)} AS p95, {quantile_sql(0.99)} AS p99
  FROM (SELECT {_window(f"{m} minutes", "ts")} AS window_start, event_type, count(*) AS requests, {_WITHIN} FROM kept GROUP BY 1, 2) c, newest
  WHERE window_start + INTERVAL '{m} minutes' <= newest"""
        for m in (1, 5, 60)
    ),
)
def latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles over 1, 5 and 60 minutes, the longer ones from the shorter ones' panes."""
    calls = table(spark, sf_dir, "events").withColumn("latency", F.col("value") / 1000.0)
    minute = _panes(
        spark,
        _arrivals(calls, "ts", "event_id", _CUTS),
        lambda stream: panes.latency_panes(stream, "ts", "latency", ["event_type"], DELAY),
        "latency-panes",
    )
    five = panes.merge_panes(minute, ["event_type"], "5 minutes")
    hour = panes.merge_panes(minute, ["event_type"], "60 minutes")
    parts = [
        panes.pane_quantiles(rows, ["event_type"]).select(F.lit(m).alias("minutes"), "*")
        for m, rows in ((1, minute), (5, five), (60, hour))
    ]
    return _zoneless(parts[0].unionByName(parts[1]).unionByName(parts[2]), "window_start")


@query(
    "k06_volume",
    f"""WITH served AS (SELECT *, CASE WHEN value >= 50 THEN 1 ELSE 0 END AS predicted_class, event_type AS model_version FROM events),
{_on_time("served", "ts", "event_id", _CUTS, "1 minute", DELAY)}
SELECT window_start, predicted_class, model_version, predictions FROM (
  SELECT {_window("60 minutes", "ts")} - i * INTERVAL '15 minutes' + INTERVAL '45 minutes' AS window_start, predicted_class, model_version, count(*) AS predictions
  FROM (SELECT *, unnest(range(0, 7)) AS i FROM kept) k
  WHERE ts >= {_window("60 minutes", "ts")} - i * INTERVAL '15 minutes' + INTERVAL '45 minutes'
    AND ts < {_window("60 minutes", "ts")} - i * INTERVAL '15 minutes' + INTERVAL '105 minutes' GROUP BY ALL) w, newest
WHERE window_start + INTERVAL '60 minutes' <= newest""",
)
def volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions per class and version over an hour, every quarter of an hour."""
    by = ["predicted_class", "model_version"]
    served = table(spark, sf_dir, "events").withColumns(
        {"predicted_class": (F.col("value") >= 50).cast("int"), "model_version": F.col("event_type")}
    )
    arrived = _arrivals(served, "ts", "event_id", _CUTS)
    minute = _panes(spark, arrived, lambda stream: panes.volume_panes(stream, "ts", by, DELAY), "volume-panes")
    hours = panes.merge_panes(minute, by, "60 minutes", "15 minutes")
    return _zoneless(hours, "pane_start").select(F.col("pane_start").alias("window_start"), *by, "predictions")


_DAYS, _DAYS_LATE = ("1997-01-01 00:00:00", "1999-01-01 00:00:00"), "10 days"


@query(
    "k06_batch_counters",
    f"""WITH reports AS (SELECT o_orderkey, any_value(o_orderdate) AS created, count(*) FILTER (WHERE l_quantity >= 2 AND l_extendedprice >= 1000) AS accepted,
  count(*) FILTER (WHERE l_quantity < 2 OR l_extendedprice < 1000) AS rejected,
  count(*) FILTER (WHERE l_quantity < 2) + count(*) FILTER (WHERE l_extendedprice < 1000) AS violations
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey),
{_on_time("reports", "created", "o_orderkey", _DAYS, "1 day", _DAYS_LATE)}
SELECT window_start, batches_success, batches_rejected, records_accepted, records_rejected, validation_failures FROM (
  SELECT {_window("7 days", "created")} AS window_start, count(*) FILTER (WHERE violations = 0) AS batches_success,
    count(*) FILTER (WHERE violations > 0) AS batches_rejected, cast(sum(accepted) as bigint) AS records_accepted,
    cast(sum(rejected) as bigint) AS records_rejected, cast(sum(violations) as bigint) AS validation_failures FROM kept GROUP BY 1) w, newest
WHERE window_start + INTERVAL '7 days' <= newest""",
)
def batch_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as batches of lines: their quality reports per week, from panes of a day."""
    small, cheap = F.col("l_quantity") < 2, F.col("l_extendedprice") < 1000
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    reports = lines.groupBy("o_orderkey").agg(
        F.any_value("o_orderdate").alias("created"),
        F.count_if(~small & ~cheap).alias("accepted_records"),
        F.count_if(small | cheap).alias("rejected_records"),
        (F.count_if(small) + F.count_if(cheap)).alias("schema_violations"),
    )
    reports = written(reports.withColumn("is_valid", F.col("schema_violations") == 0), "reports")
    arrived = _arrivals(reports, "created", "o_orderkey", _DAYS)
    days = _panes(spark, arrived, lambda stream: panes.report_panes(stream, "created", _DAYS_LATE, "1 day"), "report-panes")
    weeks = _zoneless(panes.merge_panes(days, [], "7 days"), "pane_start")
    return weeks.select(F.col("pane_start").alias("window_start"), *batch.report_counters())


@query(
    "k06_failures",
    f"""WITH {_EVENTS_ON_TIME}
SELECT window_start, event_type, failures, events FROM (SELECT {_window("60 minutes", "ts")} AS window_start, event_type,
  count(*) FILTER (WHERE value > 90) AS failures, count(*) AS events FROM kept GROUP BY 1, 2) w, newest
WHERE window_start + INTERVAL '60 minutes' <= newest""",
)
def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures per reason and hour."""
    minute = _panes(
        spark,
        _arrivals(table(spark, sf_dir, "events"), "ts", "event_id", _CUTS),
        lambda stream: panes.failure_panes(stream, "ts", "event_type", F.col("value") > 90, DELAY),
        "failure-panes",
    )
    hour = panes.merge_panes(minute, ["event_type"], "60 minutes")
    return _zoneless(hour, "pane_start").select(F.col("pane_start").alias("window_start"), "event_type", "failures", "events")
