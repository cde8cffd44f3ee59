"""Source manifest: checksum, line count and identity of each delivered file."""

from __future__ import annotations

from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.parsing import stripped


# A file up to this size is hashed as one value, a larger one block by block.
WHOLE_BYTES = 256 << 20
BLOCK_BYTES = 8 << 20


def _streamed_sha256(paths: Column) -> Column:
    """SHA-256 of files of any size, read in blocks by the tasks that hold their rows."""
    block = BLOCK_BYTES

    @F.pandas_udf("string")
    def digest(batch: pd.Series) -> pd.Series:
        import hashlib
        import re

        import pandas
        from pyarrow import fs

        def one(uri: str) -> str:
            # Spark writes local files with one slash, Arrow wants three.
            store, name = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))
            total = hashlib.sha256()
            with store.open_input_stream(name) as stream:
                while data := stream.read(block):
                    total.update(data)
            return total.hexdigest()

        return pandas.Series([one(uri) for uri in batch])

    return digest(paths)


def file_checksums(spark: SparkSession, path: str, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """SHA-256 and size per file; no file is held whole if it has more than ``whole_bytes``."""
    files = spark.read.format("binaryFile").load(path)
    small = files.where(F.col("length") <= whole_bytes)
    large = files.where(F.col("length") > whole_bytes).select("path", "length")
    named = [F.col("path").alias("source_path"), "file_sha256", F.col("length").alias("file_bytes")]
    return (
        small.withColumn("file_sha256", F.sha2("content", 256))
        .select(*named)
        .unionByName(large.withColumn("file_sha256", _streamed_sha256(F.col("path"))).select(*named))
    )


def data_line_counts(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines per text file, header excluded; large files are read in splits."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source_path"), F.col("value")
    )
    return (
        lines.groupBy("source_path")
        .agg(F.count(F.when(stripped(F.col("value")) != "", 1)).alias("_lines"))
        .select("source_path", F.greatest(F.lit(0), F.col("_lines") - 1).alias("row_count"))
    )


def source_manifest(
    spark: SparkSession, path: str, schema_version: str = "1.0.0", quality_report: str | None = None
) -> DataFrame:
    """One row per file: path, receipt time, rows, checksum, schema version, report path."""
    received = datetime.now(timezone.utc).isoformat()
    sums, counts = file_checksums(spark, path), data_line_counts(spark, path)
    # Both readers name files by URI but differ in slashes after the scheme.
    plain = F.regexp_replace("source_path", "^file:/+", "/")
    return (
        sums.withColumn("source_path", plain)
        .join(counts.withColumn("source_path", plain), "source_path", "left")
        .select(
            "source_path",
            F.lit(received).cast("timestamp").alias("received_timestamp"),
            F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"),
            "file_sha256",
            "file_bytes",
            F.lit(schema_version).alias("schema_version"),
            F.lit(quality_report).cast("string").alias("quality_report_path"),
        )
    )
