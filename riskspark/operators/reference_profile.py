"""A kept profile of a reference table, so that drift of a new batch reads only the batch.

A profile has a row ``kind``, ``feature``, ``number``, ``word``, ``n`` for each value of each feature. Counts of two
profiles add up, so a reference that grows is never read again. Values of a feature with very many of them can be brought
together with a stated error of rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.distribution import running_totals
from riskspark.operators.drift import CELL, DriftPolicy, drift_report, feature_cells, feature_drift
from riskspark.session import written
from riskspark.sources.commits import CommitLog

ENTRY = "profile"


def profile_table(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Counts of all values of the named features that the table has, from one pass."""
    numeric, categorical = ([c for c in columns if c in df.columns] for columns in (numeric, categorical))
    if not numeric and not categorical:
        raise ValueError("the table has none of the features")
    return feature_cells(df, numeric, categorical).groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"))


def merge_profiles(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The profile of all tables together; what has been brought together before adds its errors."""
    for other in others:
        first = first.unionByName(other)
    return first.groupBy(*CELL).agg(F.sum("n").alias("n"))


def compact_profile(profile: DataFrame, size: int) -> DataFrame:
    """At most about ``size`` values per numeric feature; features with fewer are left as they are.

    Values whose counts begin in the same ``1 / size`` of the rows become the greatest of them. So the share of rows up to any
    value changes by less than ``1 / size``; a value with a larger share keeps its place.
    """
    known = F.col("number").isNotNull()
    numbers = profile.where(known).select("kind", "feature", "number", "n")
    curve = running_totals(numbers, ["kind", "feature"], "number", ["n"])
    slot = F.floor((F.col("cum_n") - F.col("n")) * F.lit(float(size)) / F.col("all_n"))
    together = curve.groupBy("kind", "feature", slot.alias("_slot")).agg(
        F.max("number").alias("number"), F.sum("n").alias("n")
    )
    together = together.select("kind", "feature", "number", F.lit(None).cast("string").alias("word"), "n")
    values = numbers.groupBy("kind", "feature").agg(F.count(F.lit(1)).alias("_values"))
    many = F.broadcast(values.where(F.col("_values") > size).select("kind", "feature"))
    on = ["kind", "feature"]
    left = profile.where(~known).unionByName(profile.where(known).join(many, on, "left_anti").select(*CELL, "n"))
    return left.unionByName(together.join(many, on, "left_semi").select(*CELL, "n"))


def save_profile(profile: DataFrame, root: str, size: int | None = None) -> int:
    """Publish a profile as the next version, compacted if a ``size`` is given; returns the version."""
    log = CommitLog(profile.sparkSession, root)
    folder = log.draft()
    (profile if size is None else compact_profile(profile, size)).write.parquet(log.path(folder))
    return log.commit({ENTRY: folder}, note={"size": size})


def load_profile(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The profile of a version, the newest unless one is named."""
    log = CommitLog(spark, root)
    numbers = log.numbers()
    if not numbers or version is not None and version not in numbers:
        raise ValueError(f"no such profile under {root}")
    return spark.read.parquet(log.path(log.read(version or numbers[-1])["set"][ENTRY]))


def add_to_profile(
    spark: SparkSession, root: str, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], size: int | None = None
) -> int:
    """Add a table's rows to the newest profile, or begin one; only the table and the profile are read.

    Writers take turns: of two that add at the same time, the later version misses the other's rows.
    """
    new = profile_table(df, numeric, categorical)
    known = CommitLog(spark, root).numbers()
    return save_profile(merge_profiles(load_profile(spark, root), new) if known else new, root, size)


def drift_from_profile(
    current: DataFrame,
    profile: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    policy: DriftPolicy = DriftPolicy(),
) -> tuple[DataFrame, DataFrame]:
    """Per-feature rows and the report of a batch against a kept profile, as of the two tables.

    Features count if the batch and the profile have them.
    """
    # As many rows as features.
    held = {(r["kind"], r["feature"]) for r in profile.select("kind", "feature").distinct().collect()}
    numeric = [c for c in numeric if c in current.columns and ("numerical", c) in held]
    categorical = [c for c in categorical if c in current.columns and ("categorical", c) in held]
    if not numeric and not categorical:
        raise ValueError("the batch and the profile share none of the drift features")
    named = [("numerical", c) for c in numeric] + [("categorical", c) for c in categorical]
    wanted = F.concat_ws("|", "kind", "feature").isin([f"{kind}|{c}" for kind, c in named])
    none = F.lit(0).cast("long")
    ours = profile.where(wanted).select(*CELL, F.col("n").alias("ref_n"), none.alias("cur_n"))
    batch = profile_table(current, numeric, categorical).select(*CELL, none.alias("ref_n"), F.col("n").alias("cur_n"))
    sums = ours.unionByName(batch).groupBy(*CELL).agg(F.sum("ref_n").alias("ref_n"), F.sum("cur_n").alias("cur_n"))
    histogram = written(sums, "drift-histogram")
    # With a histogram the tables are asked for their columns only.
    features = written(feature_drift(current, current, numeric, categorical, policy, histogram), "drift-features")
    return features, drift_report(features, current, current, policy, histogram)
