"""Readers of snapshots, scoring batches, predictions and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark.operators.contract import Contract, validate


def read_text_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header, every column as text, so type errors can be counted, not thrown.

    Only the header line is looked at up front; only an empty cell means missing. Quotes
    inside a quoted cell are doubled. A row with more or fewer cells than the header fails the
    job, and so does a file of the folder whose header differs: no value is dropped or moved.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("nullValue", "")
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .option("enforceSchema", False)
        .csv(path)
    )


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table in any of the supported formats; a missing path is an error."""
    if fmt == "csv":
        return read_text_table(spark, path)
    if fmt in ("parquet", "orc", "json"):
        return spark.read.format(fmt).load(path)
    raise ValueError(f"unsupported format '{fmt}'")


def as_table(spark: SparkSession, source: str | DataFrame, fmt: str = "csv") -> DataFrame:
    """Pass a DataFrame through, or read the path."""
    return source if isinstance(source, DataFrame) else read_table(spark, source, fmt)


def load_training_table(
    spark: SparkSession, source: str | DataFrame, contract: Contract, fmt: str = "csv"
) -> DataFrame:
    """Read a training snapshot, require a valid contract, return typed rows."""
    rows, _, _ = validate(as_table(spark, source, fmt), contract, training=True)
    return rows


def load_scoring_batch(
    spark: SparkSession, source: str | DataFrame, contract: Contract, fmt: str = "csv"
) -> DataFrame:
    """Read a scoring batch as is.

    A target column, which a batch may have, is checked like any other and stays in quarantined
    rows; typed rows of a batch do not have it.
    """
    return as_table(spark, source, fmt)
