"""Sinks of scored batches, quarantined batches and reports."""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.sources.commits import CommitLog, file_system, move_new

# Tasks carry this module's functions with them, so a cluster needs no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 8 << 20


def write_scored(scored: DataFrame, path: str) -> None:
    """Publish all batches of a frame at once; a batch that was there before is replaced. Read with :func:`read_scored`."""
    log = CommitLog(scored.sparkSession, path)
    folder = log.draft()
    scored.write.partitionBy("batch_id").parquet(log.path(folder))
    fs, place = file_system(scored.sparkSession, log.path(folder))
    names = [s.getPath().getName() for s in fs.listStatus(place)]
    batches = {n: f"{folder}/{n}" for n in names if n.startswith("batch_id=")}
    if batches:
        log.commit(batches)


def read_scored(spark: SparkSession, path: str, batch_id: str | None = None) -> DataFrame:
    """The published batches, or one of them; an error if there is none."""
    rows = CommitLog(spark, path).frame("" if batch_id is None else f"batch_id={batch_id}")
    return rows if batch_id is None else rows.where(F.col("batch_id") == batch_id)


def quarantine_batch(
    report: DataFrame, errors: DataFrame, rows: DataFrame, path: str, batch_id: str
) -> str:
    """Persist report, error list and raw rows of a rejected batch; returns its folder.

    The three are written beside it and moved into place together, so the folder is complete whenever it is there. A
    batch that is quarantined again takes the place of the earlier one, which stays under ``_replaced``.
    """
    spark, root = rows.sparkSession, path.rstrip("/")
    folder, draft = f"{root}/batch_id={batch_id}", f"{root}/_drafts/{uuid.uuid4().hex}"
    report.withColumn("quarantined_batch", F.lit(batch_id)).write.json(f"{draft}/report")
    errors.write.json(f"{draft}/errors")
    rows.write.parquet(f"{draft}/rows")
    while not move_new(spark, draft, folder):
        move_new(spark, folder, f"{root}/_replaced/batch_id={batch_id}-{uuid.uuid4().hex}")
    return folder


def write_report(report: DataFrame, path: str, fmt: str = "json") -> None:
    """Write a report frame; reports are small by construction."""
    if fmt not in ("json", "parquet", "csv"):
        raise ValueError(f"unsupported report format '{fmt}'")
    writer = report.write.mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def write_one_file(lines: DataFrame, path: str) -> str:
    """Write text lines, one string column, in the frame's order as one file under ``path``; returns the file.

    All tasks write their part. One task then puts the parts one after the other, a block of bytes at a time; a task that is
    run again makes a file of its own.
    """
    spark, block = lines.sparkSession, BLOCK_BYTES
    lines.write.text(f"{path}/parts")

    def copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            # Spark takes local names with one slash, Arrow wants three.
            store, root = pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
            parts = [f.path for f in store.get_file_info(pafs.FileSelector(f"{root}/parts")) if f.base_name.startswith("part-")]
            store.create_dir(f"{root}/whole", recursive=True)
            name = f"{uuid.uuid4().hex}.txt"
            with store.open_output_stream(f"{root}/whole/{name}") as out:
                # Longer numbers are greater ones.
                for part in sorted(parts, key=lambda p: (len(p), p)):
                    with store.open_input_stream(part) as stream:
                        while data := stream.read(block):
                            out.write(data)
            yield pa.RecordBatch.from_pydict({"name": [name]})

    name = spark.range(0, 1, 1, 1).mapInArrow(copied, "name string").collect()[0]["name"]
    return f"{path}/whole/{name}"
