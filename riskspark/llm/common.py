"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.session import new_scratch_path


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


#: Rows of an Arrow batch at most, as a batch of texts is held whole by a Python worker.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches of this session have ``BATCH_ROWS`` rows at most; a smaller setting is kept."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def worker_memory(key: tuple, make: Callable):
    """What a Python worker keeps from one task to the next, by key; one thing of a kind at a time.

    It holds only what can be made again, so a new worker loses nothing but time.
    """
    held = sys.__dict__.setdefault("_riskspark_worker_memory", {})
    kind, rest = key
    if held.get(kind, (None, None))[0] != rest:
        held[kind] = (rest, make())
    return held[kind][1]


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and go on from its files.

    Lineage ends at the files, so a lost executor repeats no earlier step, and
    the shuffle files of the finished step are released at once.
    """
    spark = df.sparkSession
    path = new_scratch_path(spark, label)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")
    return F.pmod(F.crc32(text), F.lit(modulus))


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes of a text; null counts as empty."""
    return text.encode("utf-8", "surrogatepass") if text else b""


def hashed_sample(rows: DataFrame, order: Column, size: int, *ties: str) -> DataFrame:
    """About the first ``size`` rows by a hash, never more.

    Rows are counted first and cut by their hash, so all tasks together offer little more than ``size`` rows
    however many there are.
    """
    place = F.pmod(order, F.lit(1 << 30))
    limit = min(1.0, 1.2 * size / max(rows.count(), 1)) * (1 << 30)
    return rows.where(place < int(limit)).orderBy(place, *ties).limit(size)


def labelled_texts(
    docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, usable: Column, size: int
) -> DataFrame:
    """Whole texts of at most ``size`` labelled documents of each class 0 and 1: ``__id``, ``__y``, ``__text``, ``__half``.

    Drawn by a hash of the id among rows that are ``usable``, whatever their length. Ids are chosen first, from narrow
    rows; their texts are fetched with a broadcast of these ids, at most ``2 * size``, and written, not gathered. Repeated
    ids count once, with their least label and text; rows without a label or id are not drawn. ``__half`` deals the
    documents of each class by turns to 0 and 1.
    """
    one = labels.groupBy(F.col(id).alias("__id")).agg(F.min(label).cast("int").alias("__y"))
    rows = docs.where(usable & F.col(id).isNotNull()).select(F.col(id).alias("__id"), F.col(text).alias("__text"))
    known = stored(rows.select("__id").distinct().join(one, "__id"), "labelled-ids")
    order = F.xxhash64(F.col("__id").cast("string"), F.lit("sample"))
    chosen = None
    for y in (0, 1):
        part = hashed_sample(known.where(F.col("__y") == y), order, size, "__id")
        # At most ``size`` narrow rows.
        turn = F.row_number().over(Window.partitionBy("__y").orderBy(F.col("__id").cast("string")))
        part = part.withColumn("__half", (turn - 1) % 2)
        chosen = part if chosen is None else chosen.union(part)
    chosen = stored(chosen, "sample-ids")
    found = rows.join(F.broadcast(chosen), "__id").groupBy("__id", "__y", "__half")
    return stored(found.agg(F.min("__text").alias("__text")), "sample-texts")
