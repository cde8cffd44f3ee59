"""Ranking quality: exact average precision, exact ROC-AUC and their curve points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.rounding import round4
from riskspark.operators.scores import ScoreTable


def ranking_sums(table: ScoreTable, curve: DataFrame | None = None) -> DataFrame:
    """Unrounded ``pr_auc`` and ``roc_auc`` per key; null where only one class is present."""
    curve = table.curve() if curve is None else curve
    positives, total = F.sum("pos"), F.sum("n")
    negatives = total - positives
    both = (positives > 0) & (negatives > 0)
    precision_mass = F.sum(
        F.col("pos").cast("double") * F.col("cum_pos") / F.col("cum_n")
    )
    # Positives ranked above each negative, ties counting one half.
    wins = F.sum(
        (F.col("n") - F.col("pos")).cast("double")
        * (F.col("cum_pos") - F.col("pos") / F.lit(2.0))
    )
    return curve.groupBy(*table.keys).agg(
        F.when(both, precision_mass / positives).alias("pr_auc"),
        F.when(both, wins / (positives.cast("double") * negatives)).alias("roc_auc"),
    )


def ranking_metrics(table: ScoreTable) -> DataFrame:
    """``pr_auc`` and ``roc_auc`` per key, four decimals."""
    out = ranking_sums(table).select(
        *table.keys, round4(F.col("pr_auc")).alias("pr_auc"), round4(F.col("roc_auc")).alias("roc_auc")
    )
    return table.strip(out)


def roc_points(table: ScoreTable) -> DataFrame:
    """False and true positive rate at every distinct score."""
    points = table.curve()
    negatives = F.col("all_n") - F.col("all_pos")
    out = points.select(
        *table.keys,
        F.col("score").alias("threshold"),
        F.when(negatives > 0, round4((F.col("cum_n") - F.col("cum_pos")) / negatives)).alias("fpr"),
        F.when(F.col("all_pos") > 0, round4(F.col("cum_pos") / F.col("all_pos"))).alias("tpr"),
    )
    return table.strip(out)


def precision_recall_points(table: ScoreTable) -> DataFrame:
    """Precision and recall at every distinct score, with the no-skill prevalence line."""
    out = table.curve().select(
        *table.keys,
        F.col("score").alias("threshold"),
        round4(F.col("cum_pos") / F.col("cum_n")).alias("precision"),
        F.when(F.col("all_pos") > 0, round4(F.col("cum_pos") / F.col("all_pos"))).alias("recall"),
        round4(F.col("all_pos") / F.col("all_n")).alias("no_skill"),
    )
    return table.strip(out)


