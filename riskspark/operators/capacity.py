"""Capacity-limited targeting: who fits into the top fraction, and how good that is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.rounding import half_even_count, round4, share
from riskspark.operators.distribution import small
from riskspark.operators.scores import SCOPE, ScoreTable, score_table
from riskspark.operators.selection import slots_by_hash


def check_fraction(fraction: float) -> float:
    """A capacity fraction must lie in (0, 1]."""
    if not 0.0 < float(fraction) <= 1.0:
        raise ValueError(f"capacity fraction must lie in (0, 1], got {fraction}")
    return float(fraction)


def capacity_cut(table: ScoreTable, fraction: float) -> DataFrame:
    """Where the capacity line falls, one row per key, from the score curve alone.

    Columns: totals, ``num_targeted``, the ``cut`` score, rows and positives above
    it, rows and positives tied at it, and how many tied rows still fit (``room``).
    """
    targeted = half_even_count(F.col("all_n"), check_fraction(fraction))
    at_line = (
        table.curve()
        .withColumn("num_targeted", targeted)
        .filter(
            (F.col("cum_n") >= F.col("num_targeted"))
            & (F.col("cum_n") - F.col("n") < F.col("num_targeted"))
        )
    )
    return at_line.select(
        *table.keys,
        "all_n",
        "all_pos",
        "num_targeted",
        F.col("score").alias("cut"),
        (F.col("cum_n") - F.col("n")).alias("above_n"),
        (F.col("cum_pos") - F.col("pos")).alias("above_pos"),
        F.col("n").alias("tied_n"),
        F.col("pos").alias("tied_pos"),
        (F.col("num_targeted") - F.col("cum_n") + F.col("n")).alias("room"),
    )


def tie_order(ids: Sequence[str]) -> Column:
    """Deterministic, score-independent order among tied rows: md5 of the row id."""
    return F.md5(F.concat_ws("|", *[F.col(i).cast("string") for i in ids]))


def _scoped(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    if keys:
        return df, list(keys)
    return df.withColumn(SCOPE, F.lit("all")), [SCOPE]


def worklist(
    df: DataFrame,
    fraction: float,
    ids: Sequence[str],
    label: str = "y_true",
    score: str = "y_prob",
    keys: Sequence[str] = (),
    decimals: int | None = None,
    max_keys: int | None = None,
) -> DataFrame:
    """The rows inside the capacity: all above the cut, then tied rows in tie order.

    ``ids`` must identify a row. The result stays distributed and unsorted.
    ``max_keys`` is a bound on the number of keys, where one is known; without
    keys it is one.
    """
    rows, scope = _scoped(df, keys)
    max_keys = max_keys if keys else 1
    cut = capacity_cut(score_table(df, label, score, keys, decimals), fraction)
    value = F.col(score).cast("double")
    if decimals is not None:
        value = F.round(value, decimals)
    line = small(cut.select(*scope, "cut", "room", "tied_n"), max_keys)
    near = rows.join(line, scope)
    sure = near.filter((value > F.col("cut")) | ((value == F.col("cut")) & (F.col("room") == F.col("tied_n"))))
    tied = near.filter((value == F.col("cut")) & (F.col("room") < F.col("tied_n"))).drop(
        "cut", "room", "tied_n"
    )
    slots = slots_by_hash(
        tied,
        scope,
        tie_order(ids),
        cut.select(*scope, F.array(F.col("room")).alias("cuts")),
        ids,
        max_keys,
    )
    picked = slots.filter(F.col("slot") == 0)
    return sure.select(*df.columns).unionByName(picked.select(*df.columns))


def _captured_among_ties(
    df: DataFrame,
    cut: DataFrame,
    scope: list[str],
    ids: Sequence[str],
    label: str,
    value: Column,
    max_keys: int | None,
) -> DataFrame:
    """Positives among the tied rows that still fit, per key."""
    line = small(cut.select(*scope, "cut", "room", "tied_n"), max_keys)
    tied = (
        df.join(line, scope)
        .filter((value == F.col("cut")) & (F.col("room") < F.col("tied_n")))
        .select(*scope, *ids, F.col(label).alias("_pos"))
    )
    slots = slots_by_hash(
        tied,
        scope,
        tie_order(ids),
        cut.select(*scope, F.array(F.col("room")).alias("cuts")),
        ids,
        max_keys,
    )
    return (
        slots.filter(F.col("slot") == 0)
        .groupBy(*scope)
        .agg(F.sum("_pos").cast("bigint").alias("_tie_pos"))
    )


def capacity_metrics(
    df: DataFrame,
    fraction: float,
    ids: Sequence[str],
    label: str = "y_true",
    score: str = "y_prob",
    keys: Sequence[str] = (),
    decimals: int | None = None,
    max_keys: int | None = None,
    cut: DataFrame | None = None,
) -> DataFrame:
    """Precision, recall and cut score of the top fraction, per key.

    ``cut`` takes the result of ``capacity_cut`` where it is at hand already.
    """
    rows, scope = _scoped(df, keys)
    max_keys = max_keys if keys else 1
    table = score_table(df, label, score, keys, decimals)
    if cut is None:
        cut = capacity_cut(table, fraction)
    value = F.col(score).cast("double")
    if decimals is not None:
        value = F.round(value, decimals)
    ties = _captured_among_ties(rows, cut, scope, ids, label, value, max_keys)
    captured = F.col("above_pos") + F.when(
        F.col("room") == F.col("tied_n"), F.col("tied_pos")
    ).otherwise(F.coalesce(F.col("_tie_pos"), F.lit(0)))
    out = (
        table.beside(cut, ties)
        .withColumn("captured", captured)
        .select(
            *scope,
            F.lit(float(fraction)).alias("campaign_capacity_fraction"),
            F.col("num_targeted").alias("num_targeted_customers"),
            F.col("all_n").alias("total_customers"),
            round4(share(F.col("captured"), F.col("num_targeted"))).alias("precision_at_capacity"),
            round4(share(F.col("captured"), F.col("all_pos"))).alias("recall_at_capacity"),
            round4(F.col("cut")).alias("capacity_threshold"),
            F.col("captured").alias("retained_churners_captured"),
            F.col("all_pos").alias("total_actual_churners"),
        )
    )
    return table.strip(out)
