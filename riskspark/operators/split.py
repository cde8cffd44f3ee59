"""Reproducible stratified train/validation/test splits as a pure function of seed and id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.selection import slots_by_hash

SPLITS = ("test", "val", "train")


def split_hash(ids: Sequence[str], seed: int = 42) -> Column:
    """md5 of seed and id: the order rows are dealt in."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(i).cast("string") for i in ids]))


def _quota(strata: DataFrame, size: str, wanted: Column, out: str) -> DataFrame:
    """Split ``wanted`` rows over the strata in proportion to ``size``, exactly.

    ``strata`` has one row per target class.
    """
    everything = Window.partitionBy("_one")
    total = F.sum(size).over(everything)
    exact = F.col(size).cast("double") * wanted.cast("double") / total.cast("double")
    with_base = strata.withColumn("_base", F.floor(exact)).withColumn("_rem", exact - F.floor(exact))
    left = wanted - F.sum("_base").over(everything)
    order = Window.partitionBy("_one").orderBy(F.col("_rem").desc(), F.col("stratum"))
    return with_base.withColumn(
        out, (F.col("_base") + F.when(F.row_number().over(order) <= left, 1).otherwise(0)).cast("bigint")
    ).drop("_base", "_rem")


def stratum_quotas(
    df: DataFrame, target: str, test_size: float = 0.15, val_size: float = 0.15
) -> DataFrame:
    """Rows of each class that go to test and to validation.

    Test takes ceil(n * test_size) rows, validation ceil(rest * val/(1 - test)) of
    the rest; classes share them by largest remainder.
    """
    strata = df.groupBy(F.col(target).alias("stratum")).agg(F.count(F.lit(1)).alias("size"))
    strata = strata.withColumn("_one", F.lit(1))
    everything = Window.partitionBy("_one")
    n = F.sum("size").over(everything)
    test_total = F.ceil(F.round(n.cast("double") * F.lit(test_size), 9))
    strata = strata.withColumn("_test_total", test_total).withColumn("_all", n)
    strata = _quota(strata, "size", F.col("_test_total"), "test_n")
    strata = strata.withColumn("_rest", F.col("size") - F.col("test_n"))
    relative = val_size / (1.0 - test_size)
    val_total = F.ceil(
        F.round((F.col("_all") - F.col("_test_total")).cast("double") * F.lit(relative), 9)
    )
    strata = strata.withColumn("_val_total", val_total)
    strata = _quota(strata, "_rest", F.col("_val_total"), "val_n")
    return strata.select("stratum", "size", "test_n", "val_n")


def exact_split(
    df: DataFrame,
    ids: Sequence[str],
    target: str,
    test_size: float = 0.15,
    val_size: float = 0.15,
    seed: int = 42,
    max_classes: int | None = 2,
) -> DataFrame:
    """Add ``split`` with exact stratified sizes.

    Rows are dealt in hash order; only rows of the hash slices a boundary falls
    into are ranked, so no class is ever sorted on one task.
    """
    rows = df.withColumn("stratum", F.col(target))
    cuts = stratum_quotas(df, target, test_size, val_size).select(
        "stratum", F.array(F.col("test_n"), F.col("test_n") + F.col("val_n")).alias("cuts")
    )
    slots = slots_by_hash(rows, ["stratum"], split_hash(ids, seed), cuts, ids, max_classes)
    name = F.element_at(F.array(*[F.lit(s) for s in SPLITS]), F.col("slot") + 1)
    return slots.withColumn("split", name).drop("slot", "stratum")


def hash_split(
    df: DataFrame,
    ids: Sequence[str],
    test_size: float = 0.15,
    val_size: float = 0.15,
    seed: int = 42,
) -> DataFrame:
    """Add ``split`` by hash thresholds: no shuffle, sizes right in expectation in every class."""
    steps = 16**7
    position = F.conv(F.substring(split_hash(ids, seed), 1, 7), 16, 10).cast("bigint")
    test_to, val_to = round(test_size * steps), round((test_size + val_size) * steps)
    return df.withColumn(
        "split",
        F.when(position < test_to, "test").when(position < val_to, "val").otherwise("train"),
    )


def partition_of(df: DataFrame, name: str) -> DataFrame:
    """Rows of one evaluation partition: 'train', 'val', 'test', or 'full' for all."""
    if name == "full":
        return df
    if name not in SPLITS:
        raise ValueError(f"unknown partition '{name}'")
    return df.filter(F.col("split") == name)
