"""Stand-in tables for the customer domain, derived from the driver tables.

Each is given twice: as a DataFrame and as the text of a SQL common table
expression. Amounts are computed in whole cents so both engines agree exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.models.scoring import LogisticFormula
from riskspark.operators.contract import Contract, NumericRule


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- customer snapshot -------------------------------------------------------

# Column expressions shared by both engines; {div} is integer division.
_SNAPSHOT_COLUMNS = {
    "customerID": "cast(c_custkey as {text})",
    "gender": "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Female' ELSE 'Male' END",
    "SeniorCitizen": "CASE WHEN c_acctbal < 1000 THEN 1 ELSE 0 END",
    "Partner": "CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END",
    "Dependents": "CASE WHEN c_nationkey % 3 = 0 THEN 'Yes' ELSE 'No' END",
    "PhoneService": "CASE WHEN c_nationkey < 23 THEN 'Yes' ELSE 'No' END",
    "MultipleLines": "CASE WHEN c_nationkey >= 23 THEN 'No phone service' WHEN n_orders > 10 THEN 'Yes' ELSE 'No' END",
    "InternetService": "CASE WHEN c_nationkey % 5 = 0 THEN 'No' WHEN c_acctbal > 4000 THEN 'Fiber optic' ELSE 'DSL' END",
    "OnlineSecurity": "CASE WHEN c_nationkey % 5 = 0 THEN 'No internet service' WHEN c_nationkey % 5 = 1 THEN 'Yes' ELSE 'No' END",
    "OnlineBackup": "CASE WHEN c_nationkey % 5 = 0 THEN 'No internet service' WHEN c_nationkey % 5 = 2 THEN 'Yes' ELSE 'No' END",
    "DeviceProtection": "CASE WHEN c_nationkey % 5 = 0 THEN 'No internet service' WHEN c_acctbal > 6000 THEN 'Yes' ELSE 'No' END",
    "TechSupport": "CASE WHEN c_nationkey % 5 = 0 THEN 'No internet service' WHEN c_acctbal < 3000 THEN 'Yes' ELSE 'No' END",
    "StreamingTV": "CASE WHEN c_nationkey % 5 = 0 THEN 'No internet service' WHEN n_orders >= 9 THEN 'Yes' ELSE 'No' END",
    "StreamingMovies": "CASE WHEN c_nationkey % 5 = 0 THEN 'No internet service' WHEN n_orders >= 11 THEN 'Yes' ELSE 'No' END",
    "Contract": "CASE WHEN n_orders >= 12 THEN 'Two year' WHEN n_orders >= 9 THEN 'One year' ELSE 'Month-to-month' END",
    "PaperlessBilling": "CASE WHEN c_acctbal >= 5000 THEN 'Yes' ELSE 'No' END",
    "PaymentMethod": "CASE c_nationkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check' "
    "WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END",
    "tenure": "cast(coalesce(months, 0) as int)",
    "MonthlyCharges": "coalesce(cents {div} (greatest(months, 1) * 1000), 0) / cast(100 as double)",
    "TotalCharges": "(cents {div} 1000) / cast(100 as double)",
    "Churn": "CASE WHEN idle_days > 365 THEN 'Yes' ELSE 'No' END",
}

_CENTS = "cast(round(o_totalprice * 100) as bigint)"


def _columns(expressions: dict[str, str], spark_dialect: bool) -> dict[str, str]:
    words = {"div": "div", "text": "string"} if spark_dialect else {"div": "//", "text": "varchar"}
    return {name: text.format(**words) for name, text in expressions.items()}


def _customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their order history; one row per customer."""
    orders = table(spark, sf_dir, "orders")
    history = orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
        F.sum(F.expr(_CENTS)).alias("cents"),
        F.count(F.lit(1)).alias("n_orders"),
    )
    # One row: the snapshot day.
    day = orders.agg(F.max("o_orderdate").alias("snap")).withColumn("_one", F.lit(1))
    joined = (
        table(spark, sf_dir, "customer")
        .join(history, F.col("c_custkey") == F.col("o_custkey"), "left")
        .withColumn("_one", F.lit(1))
        .join(F.broadcast(day), "_one")
    )
    return joined.select(
        "c_custkey",
        "c_nationkey",
        "c_acctbal",
        "c_mktsegment",
        "cents",
        F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        F.floor(F.datediff("snap", "first_order") / 30).alias("months"),
        F.datediff("snap", "last_order").alias("idle_days"),
    )


_HISTORY_CTE = f"""history AS (
  SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment, cents, coalesce(n_orders, 0) AS n_orders,
         cast(floor(date_diff('day', first_order, snap) / 30.0) as bigint) AS months,
         date_diff('day', last_order, snap) AS idle_days
  FROM customer LEFT JOIN (
    SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
           cast(sum({_CENTS}) as bigint) AS cents, count(*) AS n_orders
    FROM orders GROUP BY o_custkey) o ON c_custkey = o_custkey
  CROSS JOIN (SELECT max(o_orderdate) AS snap FROM orders) d)"""


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean typed snapshot in the shape of the customer contract."""
    history = _customer_history(spark, sf_dir)
    return history.select(
        *[F.expr(text).alias(name) for name, text in _columns(_SNAPSHOT_COLUMNS, True).items()]
    )


def _select_list(expressions: dict[str, str]) -> str:
    return ",\n    ".join(f'{text} AS "{name}"' for name, text in _columns(expressions, False).items())


SNAPSHOT_CTE = f"""{_HISTORY_CTE},
snapshot AS (SELECT
    {_select_list(_SNAPSHOT_COLUMNS)}
  FROM history)"""


# --- raw text snapshot with real violations ----------------------------------

# The join with pending orders repeats customers, which gives duplicated keys and
# rows; balance ranges decide which rows carry a defect.
_RAW_COLUMNS = {
    **{
        name: text
        for name, text in _SNAPSHOT_COLUMNS.items()
        if name not in ("customerID", "SeniorCitizen", "Contract", "tenure", "MonthlyCharges", "TotalCharges", "Churn")
    },
    "customerID": "CASE WHEN c_acctbal < -900 THEN '  ' WHEN c_acctbal < -850 THEN NULL ELSE cast(c_custkey as {text}) END",
    "SeniorCitizen": "CASE WHEN c_acctbal > 9800 THEN '2' WHEN c_acctbal > 9700 THEN 'senior' "
    "WHEN c_acctbal < 1000 THEN '1' ELSE '0' END",
    "Contract": "CASE WHEN c_acctbal BETWEEN 8000 AND 8100 THEN 'Weekly' WHEN c_acctbal BETWEEN 8100 AND 8150 THEN NULL "
    "WHEN n_orders >= 12 THEN 'Two year' WHEN n_orders >= 9 THEN 'One year' ELSE 'Month-to-month' END",
    "tenure": "CASE WHEN c_acctbal BETWEEN 9000 AND 9050 THEN 'n/a' WHEN c_acctbal BETWEEN 8900 AND 9000 THEN '-1' "
    "ELSE cast(coalesce(months, 0) as {text}) END",
    "MonthlyCharges": "cast(coalesce(cents {div} (greatest(months, 1) * 100000), 0) as {text})",
    "TotalCharges": "CASE WHEN c_acctbal BETWEEN 7000 AND 7100 THEN ' ' WHEN c_acctbal BETWEEN 7100 AND 7200 THEN 'unknown' "
    "WHEN c_acctbal BETWEEN 7200 AND 7250 THEN '1.0d' WHEN c_acctbal BETWEEN 7250 AND 7300 THEN '-12.5' "
    "ELSE concat(cast(cents {div} 100000 as {text}), '.', lpad(cast((cents {div} 1000) % 100 as {text}), 2, '0')) END",
    "Churn": "CASE WHEN c_acctbal BETWEEN 6000 AND 6050 THEN 'Maybe' WHEN idle_days > 365 THEN 'Yes' ELSE 'No' END",
}
RAW_ORDER = list(_SNAPSHOT_COLUMNS)


def raw_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text snapshot as delivered, one row per customer and pending order."""
    pending = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P").select("o_custkey")
    rows = _customer_history(spark, sf_dir).join(
        pending, F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    texts = _columns(_RAW_COLUMNS, True)
    return rows.select(*[F.expr(texts[name]).alias(name) for name in RAW_ORDER])


RAW_CTE = f"""{_HISTORY_CTE},
raw AS (SELECT
    {_select_list({name: _RAW_COLUMNS[name] for name in RAW_ORDER})}
  FROM history LEFT JOIN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') p ON c_custkey = o_custkey)"""


# --- scored snapshot ----------------------------------------------------------

# An expression scorer with made-up weights for the snapshot.
SNAPSHOT_FORMULA = LogisticFormula(
    intercept=-1.2,
    numeric={"tenure": -0.004, "MonthlyCharges": 0.02},
    categorical={
        "Contract": {"Month-to-month": 0.9, "One year": 0.3},
        "InternetService": {"Fiber optic": 0.4, "No": -0.5},
        "PaperlessBilling": {"Yes": 0.2},
    },
)

FORMULA_SQL = """(1.0::double / (1.0::double + exp(-(-1.2::double + coalesce(tenure, 0) * (-0.004)::double
   + coalesce("MonthlyCharges", 0) * 0.02::double
   + CASE "Contract" WHEN 'Month-to-month' THEN 0.9 WHEN 'One year' THEN 0.3 ELSE 0.0 END::double
   + CASE "InternetService" WHEN 'Fiber optic' THEN 0.4 WHEN 'No' THEN -0.5 ELSE 0.0 END::double
   + CASE "PaperlessBilling" WHEN 'Yes' THEN 0.2 ELSE 0.0 END::double))))"""


# --- scored line items ----------------------------------------------------------

ROW_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
# Scores lie on a grid of four decimals, as stored scores do.
SCORE_DECIMALS = 4


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large score table: two models, a binary outcome, bands and two sensitive flags."""
    y = (F.col("l_returnflag") == "R").cast("int")
    k = {c: F.col(c) for c in ROW_KEY}

    def on_grid(points):
        return points / F.lit(10000.0)

    return table(spark, sf_dir, "lineitem").select(
        *ROW_KEY,
        y.alias("y_true"),
        on_grid(
            (k["l_orderkey"] * 31 + k["l_partkey"] * 17 + k["l_linenumber"] * 7) % 7000 + 3000 * y
        ).alias("y_prob"),
        on_grid(
            (k["l_orderkey"] * 17 + k["l_partkey"] * 31 + k["l_linenumber"] * 13) % 6500 + 3500 * y
        ).alias("rival_prob"),
        F.col("l_linestatus").alias("line_status"),
        F.when(F.col("l_quantity") <= 12, "small")
        .when(F.col("l_quantity") <= 36, "medium")
        .otherwise("large")
        .alias("quantity_band"),
        F.when(F.col("l_discount") > 0.05, "Female").otherwise("Male").alias("gender"),
        F.when(F.col("l_tax") > 0.06, 1).otherwise(0).alias("SeniorCitizen"),
        F.col("l_extendedprice"),
    )


SCORED_CTE = """scored AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, y AS y_true,
    ((l_orderkey * 31 + l_partkey * 17 + l_linenumber * 7) % 7000 + 3000 * y) / 10000.0::double AS y_prob,
    ((l_orderkey * 17 + l_partkey * 31 + l_linenumber * 13) % 6500 + 3500 * y) / 10000.0::double AS rival_prob,
    l_linestatus AS line_status,
    CASE WHEN l_quantity <= 12 THEN 'small' WHEN l_quantity <= 36 THEN 'medium' ELSE 'large' END AS quantity_band,
    CASE WHEN l_discount > 0.05::double THEN 'Female' ELSE 'Male' END AS gender,
    CASE WHEN l_tax > 0.06::double THEN 1 ELSE 0 END AS "SeniorCitizen",
    l_extendedprice,
    md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber)) AS row_hash
  FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem))"""


# --- line items as a table with really duplicated keys ---------------------------

LINE_CONTRACT = Contract(
    primary_key="l_orderkey",
    categorical={"l_returnflag": ("A", "N"), "l_linestatus": ("F", "O")},
    numeric={
        "l_quantity": NumericRule(minimum=2.0),
        "l_extendedprice": NumericRule(minimum=1000.0),
        "l_linenumber": NumericRule(integer=True),
    },
    strict_columns=False,
)


# --- predictions and late labels -------------------------------------------------

PREDICTIONS_CTE = """predictions AS (SELECT doc_id,
    round((n_chars % 9000 + 500) / 10000.0::double, 4) AS churn_probability,
    source AS model_version, lang, n_chars AS scoring_order FROM documents),
late AS (SELECT doc_id, quality AS observed_churn, toxic, doc_id AS observation_order FROM labels)"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored predictions: one per document, the score from its length."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.round((F.col("n_chars") % 9000 + 500) / F.lit(10000.0), 4).alias("churn_probability"),
        F.col("source").alias("model_version"),
        "lang",
        F.col("n_chars").alias("scoring_order"),
    )


def late_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes that arrived later for some of the documents."""
    return table(spark, sf_dir, "labels").select(
        "doc_id",
        F.col("quality").alias("observed_churn"),
        "toxic",
        F.col("doc_id").alias("observation_order"),
    )


# --- events as request log ----------------------------------------------------------

EVENT_MIDPOINT = "2024-01-16 00:00:00"


def event_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events before and from the middle of the month: reference and current table."""
    events = table(spark, sf_dir, "events").withColumn("hour", F.hour("ts"))
    middle = F.lit(EVENT_MIDPOINT).cast("timestamp_ntz")
    return events.filter(F.col("ts") < middle), events.filter(F.col("ts") >= middle)


def order_halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders before and from 1998-07-01, with a drifting measure and category."""
    orders = table(spark, sf_dir, "orders").select(
        "o_totalprice",
        F.when(F.col("o_totalprice") < 400000, F.col("o_custkey")).alias("o_custkey"),
        (F.col("o_totalprice") + 50.0 * F.datediff("o_orderdate", F.lit("1995-01-01"))).alias("aged_price"),
        "o_orderpriority",
        F.when(F.year("o_orderdate") < 1998, F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderdate",
    )
    middle = F.lit("1998-07-01 00:00:00").cast("timestamp_ntz")
    return orders.filter(F.col("o_orderdate") < middle), orders.filter(F.col("o_orderdate") >= middle)


ORDER_HALVES_CTE = """pair AS (SELECT o_totalprice,
    CASE WHEN o_totalprice < 400000 THEN o_custkey END AS o_custkey,
    o_totalprice + 50.0::double * date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS aged_price,
    o_orderpriority,
    CASE WHEN year(o_orderdate) < 1998 THEN o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderdate < TIMESTAMP '1998-07-01' THEN 1 ELSE 0 END AS is_ref FROM orders)"""
