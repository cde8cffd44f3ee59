"""Exact selection of the first k rows per key in hash order, without sorting a key.

Rows are split by the first four hex digits of an md5 (65,536 even slices). Slice
counts decide almost every row; only rows of a slice that a cut point falls into
are ranked, and such a slice holds 1/65,536 of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.distribution import small

PREFIX_DIGITS = 4
SLICES = 16**PREFIX_DIGITS


def _slot(rank: Column) -> Column:
    """How many cut points lie before this rank (ranks start at 1)."""
    return F.size(F.filter(F.col("cuts"), lambda c: c < rank))


def slots_by_hash(
    df: DataFrame,
    keys: Sequence[str],
    hash_text: Column,
    cuts: DataFrame,
    tiebreak: Sequence[str],
    max_keys: int | None = None,
    out: str = "slot",
) -> DataFrame:
    """Number each row by the stretch of its key's hash order it falls into.

    ``cuts`` has one row per key with an ascending bigint array ``cuts``: rows
    ranked up to the first cut get slot 0, up to the second slot 1, and so on.
    ``max_keys`` is a bound on the number of keys, where one is known; it decides
    whether the slice table may be broadcast.
    """
    keys = list(keys)
    rows = df.withColumn("_hash", hash_text).withColumn(
        "_slice", F.substring("_hash", 1, PREFIX_DIGITS)
    )
    counts = rows.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = (
        Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    spans = (
        counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .join(small(cuts, max_keys), keys)
        .select(
            *keys,
            "_slice",
            "_before",
            "cuts",
            _slot(F.col("_before") + 1).alias("_first"),
            _slot(F.col("_before") + F.col("_n")).alias("_last"),
        )
    )
    marked = rows.join(small(spans, max_keys and SLICES * max_keys), [*keys, "_slice"])
    settled = marked.filter(F.col("_first") == F.col("_last")).select(
        *df.columns, F.col("_first").alias(out)
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy("_hash", *tiebreak)
    ranked = (
        marked.filter(F.col("_first") < F.col("_last"))
        .withColumn("_rank", F.col("_before") + F.row_number().over(inside))
        .select(*df.columns, _slot(F.col("_rank")).alias(out))
    )
    return settled.unionByName(ranked)
