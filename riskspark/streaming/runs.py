"""Starting streams over files and running them until the available data is used up."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# Whether a query makes a micro-batch without rows for what the watermark has closed.
_WITHOUT_ROWS = "spark.sql.streaming.noDataMicroBatches.enabled"


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    name_glob: str | None = None,
) -> DataFrame:
    """Stream of files appearing in the folder ``path``, by name pattern if given."""
    reader = spark.readStream.schema(schema).format(fmt)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def event_timed(stream: DataFrame, time: str) -> DataFrame:
    """Event time as an instant: watermarks do not take zone-less timestamps."""
    return stream.withColumn(time, F.col(time).cast("timestamp"))


def run_to_files(
    stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), more: bool = False
) -> None:
    """Append what is available to parquet files, exactly once per checkpoint.

    With ``more`` another run will follow: this one ends with its last rows, and what its watermark closes comes out in the next.
    """
    writer = stream.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    conf = stream.sparkSession.conf
    without_rows = conf.get(_WITHOUT_ROWS)
    # A query keeps the settings it was started with.
    if more:
        conf.set(_WITHOUT_ROWS, "false")
    try:
        query = writer.start()
    finally:
        conf.set(_WITHOUT_ROWS, without_rows)
    query.awaitTermination()


def run_per_batch(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "append",
) -> None:
    """Hand each micro-batch to ``handle``, which must be safe to repeat for one batch number."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def arrive_in_turn(arrivals: Sequence[DataFrame], path: str, run: Callable[[DataFrame, bool], None]) -> None:
    """Write each arrival to the folder ``path`` and ``run`` the stream of the folder after it.

    With one checkpoint for all runs an arrival is one micro-batch, however many files its tasks write. ``run`` is told whether more will come.
    """
    for number, rows in enumerate(arrivals, 1):
        rows.write.mode("append").parquet(path)
        run(file_stream(rows.sparkSession, path, rows.schema), number < len(arrivals))
