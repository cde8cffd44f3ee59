"""Operational quality report of a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.rounding import round4, share
from riskspark.operators.contract import (
    Contract,
    check_counts,
    key_counts,
    validation_errors,
    validation_report,
)
from riskspark.operators.distribution import side_by_side


def missing_values(df: DataFrame, only_present: bool = True) -> DataFrame:
    """Null count and share per column, from one aggregation of the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_m{i}") for i, c in enumerate(df.columns)],
    )
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("null_count"))
            for i, c in enumerate(df.columns)
        ]
    )
    out = counts.select("_total", F.explode(cells).alias("_c")).select(
        "_c.column",
        "_c.null_count",
        round4(share(F.col("_c.null_count"), F.col("_total"))).alias("null_percentage"),
    )
    return out.filter(F.col("null_count") > 0) if only_present else out


def quality_report(df: DataFrame, contract: Contract, training: bool = False) -> DataFrame:
    """One row: accepted and rejected records, rejection rate, duplicates, violations."""
    counts = check_counts(df, contract, training)
    keys = key_counts(df, contract.primary_key)
    errors = validation_errors(df, contract, training, counts, keys)
    report = validation_report(df, contract, training, errors, counts)
    copies = keys.agg(
        F.coalesce(F.sum("extra"), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_primary_keys"),
    )
    rejected = F.col("total_rows") - F.col("valid_rows")
    rate = round4(share(rejected, F.col("total_rows")))
    return (
        side_by_side(report, copies)
        .select(
            F.col("total_rows").alias("total_records"),
            F.col("valid_rows").alias("accepted_records"),
            rejected.alias("rejected_records"),
            rate.alias("rejection_rate"),
            "duplicate_rows",
            "duplicate_primary_keys",
            F.col("error_records").alias("schema_violations"),
            "is_valid",
            F.concat(
                F.lit("Operational Quality Report: "),
                F.col("valid_rows").cast("string"),
                F.lit("/"),
                F.col("total_rows").cast("string"),
                F.lit(" accepted ("),
                F.format_string("%.2f", rate * 100),
                F.lit("% rejected, "),
                F.col("error_records").cast("string"),
                F.lit(" check failure(s))."),
            ).alias("summary"),
        )
    )
