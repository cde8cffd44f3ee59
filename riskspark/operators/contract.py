"""Data contract checks at table scale.

All row-level checks run in one map-only pass that turns each failing (row,
check) into a violation row; these are counted once and the counts written, and
errors, samples and report read the counts. The two duplicate checks take a second
pass, which shuffles ids with a row digest, never whole rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.parsing import BLANKS, NUMERAL_PATTERN
from riskspark.operators.distribution import side_by_side
from riskspark.session import written

SAMPLE_SIZE = 5

ERROR_SCHEMA = (
    "check_type string, column string, invalid_count bigint, "
    "error_records bigint, sample_invalid_values array<string>"
)


@dataclass(frozen=True)
class NumericRule:
    """Bounds of one measure. ``lenient_text`` marks text columns whose blanks mean missing."""

    minimum: float = 0.0
    nullable: bool = False
    integer: bool = False
    lenient_text: bool = False


@dataclass(frozen=True)
class Contract:
    """Key, closed domains, numeric bounds and target of one snapshot table."""

    primary_key: str
    categorical: Mapping[str, tuple]
    numeric: Mapping[str, NumericRule]
    target: str | None = None
    target_values: tuple[str, ...] = ("Yes", "No")
    allow_duplicate_rows: bool = False
    strict_columns: bool = True
    version: str = "1.0.0"
    integer_categorical: tuple[str, ...] = field(default=())

    def columns(self, training: bool) -> list[str]:
        names = [self.primary_key, *self.categorical, *self.numeric]
        if self.target and training:
            names.append(self.target)
        return list(dict.fromkeys(names))


# The customer snapshot contract.
_YES_NO = ("Yes", "No")
_NET = ("No internet service", "No", "Yes")
CUSTOMER_CONTRACT = Contract(
    primary_key="customerID",
    categorical={
        "gender": ("Female", "Male"),
        "SeniorCitizen": (0, 1),
        "Partner": _YES_NO,
        "Dependents": _YES_NO,
        "PhoneService": _YES_NO,
        "MultipleLines": ("No phone service", "No", "Yes"),
        "InternetService": ("DSL", "Fiber optic", "No"),
        "OnlineSecurity": _NET,
        "OnlineBackup": _NET,
        "DeviceProtection": _NET,
        "TechSupport": _NET,
        "StreamingTV": _NET,
        "StreamingMovies": _NET,
        "Contract": ("Month-to-month", "One year", "Two year"),
        "PaperlessBilling": _YES_NO,
        "PaymentMethod": (
            "Electronic check",
            "Mailed check",
            "Bank transfer (automatic)",
            "Credit card (automatic)",
        ),
    },
    numeric={
        "tenure": NumericRule(integer=True),
        "MonthlyCharges": NumericRule(),
        "TotalCharges": NumericRule(nullable=True, lenient_text=True),
    },
    target="Churn",
    integer_categorical=("SeniorCitizen",),
)


class ContractViolation(ValueError):
    """A whole batch failed its contract; ``report`` holds the one-row summary."""

    def __init__(self, message: str, report: dict | None = None) -> None:
        super().__init__(message)
        self.report = report


@dataclass(frozen=True)
class RowCheck:
    """One row predicate as SQL: where ``bad`` holds, ``value`` is what failed."""

    check_type: str
    column: str
    bad: str
    value: str
    per_row: bool = True


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _text(value: object) -> str:
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _stripped(text: str) -> str:
    """SQL text of a value without white space at both ends."""
    return f"btrim({text}, {_text(BLANKS)})"


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.StringType, T.VarcharType, T.CharType))


def _is_number(column: str) -> str:
    return f"{_stripped(_name(column))} RLIKE r'{NUMERAL_PATTERN}'"


def _number(df: DataFrame, column: str, integer: bool = False) -> str:
    """Typed value of a column that may have been read as text."""
    name = _name(column)
    if not _is_text(df, column):
        return name
    if integer:
        return f"try_cast({_stripped(name)} AS int)"
    return (
        f"CASE WHEN {_is_number(column)} "
        f"THEN try_cast(replace({_stripped(name)}, '_', '') AS double) END"
    )


def typed(df: DataFrame, contract: Contract, training: bool = True) -> DataFrame:
    """Contract columns in contract order with contract types; bad text becomes null."""
    out = []
    for column in contract.columns(training):
        if column not in df.columns:
            continue
        if column in contract.numeric:
            integer = contract.numeric[column].integer
            value, kind = _number(df, column, integer), "int" if integer else "double"
        elif column in contract.integer_categorical:
            value, kind = _number(df, column, True), "int"
        else:
            value, kind = _name(column), "string"
        out.append(f"CAST({value} AS {kind}) AS {_name(column)}")
    return df.selectExpr(*out)


def row_checks(df: DataFrame, contract: Contract, training: bool = True) -> list[RowCheck]:
    """Every predicate of the contract that looks at one row only.

    Predicates are SQL text, so a contract of many columns becomes one expression.
    """
    checks: list[RowCheck] = []

    def add(kind: str, column: str, bad: str, value: str, per_row: bool = True) -> None:
        checks.append(
            RowCheck(kind, column, f"coalesce({bad}, false)", f"CAST({value} AS string)", per_row)
        )

    key = contract.primary_key
    if key in df.columns:
        text = f"CAST({_name(key)} AS string)"
        add("null_primary_key", key, f"{text} IS NULL OR {_stripped(text)} = ''", text, per_row=False)
        add("not_nullable", key, f"{text} IS NULL", text)
        add("non_blank_id", key, f"{_stripped(text)} = ''", text)

    domains: dict[str, tuple] = dict(contract.categorical)
    if contract.target and contract.target in df.columns:
        domains[contract.target] = contract.target_values
    for column, allowed in domains.items():
        if column not in df.columns:
            continue
        name = _name(column)
        if column in contract.integer_categorical:
            value = _number(df, column, True)
            if _is_text(df, column):
                add("dtype", column, f"{name} IS NOT NULL AND {value} IS NULL", name)
        else:
            value = f"CAST({name} AS string)"
        add("not_nullable", column, f"{name} IS NULL", name)
        add("isin", column, f"{value} NOT IN ({', '.join(_text(v) for v in allowed)})", value)

    for column, rule in contract.numeric.items():
        if column not in df.columns:
            continue
        value, name = _number(df, column, rule.integer), _name(column)
        if _is_text(df, column):
            if rule.lenient_text:
                bad_text = f"{_stripped(name)} <> '' AND NOT {_is_number(column)}"
                add("invalid_type_conversion", column, bad_text, name)
            else:
                add("dtype", column, f"{name} IS NOT NULL AND {value} IS NULL", name)
        if not rule.nullable:
            add("not_nullable", column, f"{name} IS NULL", name)
        add("greater_than_or_equal_to", column, f"{value} < {rule.minimum}", name)
    return checks


def schema_problems(df: DataFrame, contract: Contract, training: bool = True) -> list[tuple[str, str]]:
    """Column-level findings: missing key, missing, unexpected or wrongly typed columns."""
    found: list[tuple[str, str]] = []
    if contract.primary_key not in df.columns:
        found.append(("missing_column", contract.primary_key))
    for name in contract.columns(training):
        if name not in df.columns:
            found.append(("column_in_dataframe", name))
    known = set(contract.columns(True))
    if contract.strict_columns:
        found += [("column_in_schema", name) for name in df.columns if name not in known]
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    numbers = (*whole, T.FloatType, T.DoubleType, T.DecimalType)
    for name in df.columns:
        if name not in known or _is_text(df, name):
            continue
        kind = df.schema[name].dataType
        if name in contract.numeric:
            expected = whole if contract.numeric[name].integer else numbers
        elif name in contract.integer_categorical:
            expected = whole
        else:
            expected = ()
        if not isinstance(kind, expected):
            found.append(("dtype", name))
    return found


VIOLATIONS_TYPE = "array<struct<check_type:string,column:string,value:string,per_row:boolean>>"


def violation_list(df: DataFrame, contract: Contract, training: bool = True) -> Column:
    """The violations of a row as an array of structs; empty for a clean row.

    One compiled disjunction decides whether a row is clean; the list is only
    built for rows that are not.
    """
    none = f"CAST(array() AS {VIOLATIONS_TYPE})"
    checks = row_checks(df, contract, training)
    if not checks:
        return F.expr(none)
    cells = [
        f"CASE WHEN {c.bad} THEN named_struct('check_type', {_text(c.check_type)}, 'column', {_text(c.column)}, "
        f"'value', {c.value}, 'per_row', {str(c.per_row).lower()}) END"
        for c in checks
    ]
    unclean = " OR ".join(c.bad for c in checks)
    return F.expr(f"CASE WHEN {unclean} THEN array_compact(array({', '.join(cells)})) ELSE {none} END")


def _exploded(df: DataFrame, contract: Contract, training: bool, keep: list[str]) -> DataFrame:
    """Rows fanned out to their violations; a clean row stays once with null violation."""
    found = violation_list(df, contract, training)
    return df.select(*keep, F.posexplode_outer(found).alias("_pos", "_v")).select(*keep, "_pos", "_v.check_type", "_v.column", "_v.value", "_v.per_row")


def violations(df: DataFrame, contract: Contract, training: bool = True) -> DataFrame:
    """One row per failing (row, check): key, check, column, offending value. No shuffle."""
    key = contract.primary_key
    return (
        _exploded(df, contract, training, [key])
        .filter(F.col("check_type").isNotNull())
        .select(key, "check_type", "column", "value")
    )


def check_counts(df: DataFrame, contract: Contract, training: bool = True) -> DataFrame:
    """Violations counted per (check, column, value), with the rows they start at.

    The null check counts the clean rows, so one aggregation yields the table
    size, the clean rows and every violation count.
    """
    starts = F.sum(F.when(F.coalesce(F.col("_pos"), F.lit(0)) == 0, 1).otherwise(0))
    return (
        _exploded(df, contract, training, [])
        .groupBy("check_type", "column", "value", "per_row")
        .agg(F.count(F.lit(1)).alias("n"), starts.alias("rows_started"))
    )


# Times are written to the microsecond and nulls by name, so different rows have different text.
DIGEST_FORM = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}


def _plain(df: DataFrame, column: str) -> Column:
    """A column as the row digest sees it: both zeros are one number."""
    value = F.col(_name(column))
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        value = F.when(value == 0, F.lit(0.0)).otherwise(value)
    return value.alias(column)


def written_counts(df: DataFrame, contract: Contract, training: bool = True) -> DataFrame:
    """The check counts, written once: errors, samples and report read them without the table."""
    return written(check_counts(df, contract, training), "check-counts")


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Per key: rows ``n`` and extra whole-row copies ``extra`` (null is a key of its own).

    Two aggregations with map-side combine, so neither a key nor a row that makes
    up a third of the table lands whole on one task.
    """
    digest = F.sha2(F.to_json(F.struct(*[_plain(df, c) for c in df.columns]), DIGEST_FORM), 256)
    return (
        df.select(F.col(key).cast("string").alias("key"), digest.alias("_digest"))
        .groupBy("key", "_digest")
        .agg(F.count(F.lit(1)).alias("_c"))
        .groupBy("key")
        .agg(F.sum("_c").alias("n"), F.sum(F.col("_c") - 1).alias("extra"))
    )


def duplicate_counts(df: DataFrame, key: str) -> DataFrame:
    """One row: extra whole-row copies, members of duplicated keys, extra key copies, totals."""
    return key_counts(df, key).agg(
        F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias(
            "duplicate_primary_keys"
        ),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_keys"),
        F.count("key").alias("distinct_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
    )


def _literal_errors(df: DataFrame, rows: list[tuple[str, str, Column]]) -> DataFrame:
    cells = [
        F.struct(
            F.lit(kind).alias("check_type"),
            F.lit(column).alias("column"),
            count.cast("bigint").alias("invalid_count"),
            F.lit(1).cast("bigint").alias("error_records"),
            F.array().cast("array<string>").alias("sample_invalid_values"),
        )
        for kind, column, count in rows
    ]
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return total.select(F.explode(F.array(*cells)).alias("_e")).select("_e.*")


def validation_errors(
    df: DataFrame,
    contract: Contract,
    training: bool = True,
    counts: DataFrame | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """The error list: one row per (check, column) with its count and up to five samples.

    ``error_records`` is how many entries the check adds to an error list that has
    one entry per failing value, or one per table for the table-level checks.
    """
    counts = written_counts(df, contract, training) if counts is None else counts
    found = counts.filter(F.col("check_type").isNotNull())
    totals = found.groupBy("check_type", "column", "per_row").agg(F.sum("n").alias("invalid_count"))
    first = Window.partitionBy("check_type", "column").orderBy("value")
    samples = (
        found.filter(F.col("value").isNotNull())
        .withColumn("_rn", F.row_number().over(first))
        .filter(F.col("_rn") <= SAMPLE_SIZE)
        .groupBy("check_type", "column")
        .agg(F.array_sort(F.collect_list("value")).alias("sample_invalid_values"))
    )
    listed = totals.join(samples, ["check_type", "column"], "left").select(
        "check_type",
        "column",
        "invalid_count",
        F.when(F.col("per_row"), F.col("invalid_count")).otherwise(F.lit(1)).cast("bigint").alias("error_records"),
        F.coalesce("sample_invalid_values", F.array().cast("array<string>")).alias(
            "sample_invalid_values"
        ),
    )

    key = contract.primary_key
    if key in df.columns:
        # Keys that stand alone have no say below; the others are few and read three times.
        keys = key_counts(df, key) if keys is None else keys
        repeated = written(keys.filter(F.col("n") > 1), "repeated-keys")
        first_keys = repeated.orderBy("key").limit(SAMPLE_SIZE).agg(
            F.array_sort(F.collect_list("key")).alias("sample_invalid_values")
        )
        dup_keys = (
            side_by_side(repeated.agg(F.sum("n").alias("invalid_count")), first_keys)
            .filter(F.col("invalid_count") > 0)
            .select(
                F.lit("duplicate_primary_key").alias("check_type"),
                F.lit(key).alias("column"),
                "invalid_count",
                F.lit(1).cast("bigint").alias("error_records"),
                "sample_invalid_values",
            )
        )
        listed = listed.unionByName(dup_keys)
        if not contract.allow_duplicate_rows:
            dup_rows = (
                repeated.agg(F.sum("extra").alias("invalid_count"))
                .filter(F.col("invalid_count") > 0)
                .select(
                    F.lit("duplicate_rows").alias("check_type"),
                    F.lit(None).cast("string").alias("column"),
                    "invalid_count",
                    F.lit(1).cast("bigint").alias("error_records"),
                    F.array().cast("array<string>").alias("sample_invalid_values"),
                )
            )
            listed = listed.unionByName(dup_rows)

    problems = schema_problems(df, contract, training)
    if problems:
        rows = [
            (kind, column, F.col("total") if kind == "missing_column" else F.lit(1))
            for kind, column in problems
        ]
        listed = listed.unionByName(_literal_errors(df, rows))
    return listed


def validation_report(
    df: DataFrame,
    contract: Contract,
    training: bool = True,
    errors: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """One row: validity, table size, valid rows, clean rows, error count, summary.

    ``valid_rows`` is the table size less the number of error records (never below
    zero); ``clean_rows`` counts the rows without any row-level violation.
    """
    counts = written_counts(df, contract, training) if counts is None else counts
    errors = validation_errors(df, contract, training, counts) if errors is None else errors
    none = F.lit(0).cast("bigint")
    sized = counts.select(
        F.col("rows_started").cast("bigint").alias("total_rows"),
        F.when(F.col("check_type").isNull(), F.col("rows_started")).otherwise(none).alias("clean_rows"),
        none.alias("error_records"),
    )
    failed = errors.select(none.alias("total_rows"), none.alias("clean_rows"), "error_records")
    summed = sized.unionByName(failed).agg(
        *[F.coalesce(F.sum(c), none).alias(c) for c in ("total_rows", "clean_rows", "error_records")]
    )
    valid = F.col("error_records") == 0
    rows = F.col("total_rows").cast("string")
    return summed.select(
        valid.alias("is_valid"),
        F.lit(contract.version).alias("schema_version"),
        "total_rows",
        F.when(valid, F.col("total_rows"))
        .otherwise(F.greatest(none, F.col("total_rows") - F.col("error_records")))
        .alias("valid_rows"),
        "clean_rows",
        "error_records",
        F.when(
            valid,
            F.concat(
                F.lit("Validation PASSED for "), rows, F.lit(f" row(s) against schema v{contract.version}.")
            ),
        )
        .otherwise(
            F.concat(
                F.lit("Validation FAILED with "),
                F.col("error_records").cast("string"),
                F.lit(" error(s) across "),
                rows,
                F.lit(" row(s)."),
            )
        )
        .alias("summary"),
    )


def validate(
    df: DataFrame, contract: Contract, training: bool = True, raise_on_error: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Typed rows, one-row report and error list; raises on request when anything failed."""
    counts = written_counts(df, contract, training)
    errors = written(validation_errors(df, contract, training, counts), "validation-errors")
    report = validation_report(df, contract, training, errors, counts)
    if raise_on_error:
        require_valid(report, errors)
    return typed(df, contract, training), report, errors


def validate_scoring_batch(
    df: DataFrame, contract: Contract, raise_on_error: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Contract check of a batch to be scored: the target is optional."""
    return validate(df, contract, training=False, raise_on_error=raise_on_error)


def require_valid(report: DataFrame, errors: DataFrame | None = None) -> None:
    """The whole-batch gate: read the one-row report and raise unless it is valid.

    With the error list the message also names the first error, by column and check.
    """
    row = report.first().asDict()
    if row["is_valid"]:
        return
    message = f"data validation failed: {row['summary']}"
    if errors is not None:
        order = [F.col("column").asc_nulls_first(), "check_type"]
        first = errors.orderBy(*order).first()
        message += (
            f"\nfirst error: {first['check_type']} on column '{first['column']}', "
            f"{first['invalid_count']} value(s), such as {list(first['sample_invalid_values'])}"
        )
    raise ContractViolation(message, row)
