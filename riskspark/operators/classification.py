"""Threshold metrics. Each is one aggregation: no sort, no join, tiny shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.decisions import check_threshold
from riskspark.functions.rounding import round4, share
from riskspark.operators.ranking import ranking_sums
from riskspark.operators.scores import ScoreTable

# The default sweep, .05 to .95 in steps of .05.
DEFAULT_THRESHOLDS = tuple(round(0.05 * i, 2) for i in range(1, 20))


def _selected(threshold: float) -> Column:
    return F.col("score") >= F.lit(check_threshold(threshold))


def confusion_sums(threshold: float, mark: str = "") -> list[Column]:
    """The four confusion counts as aggregate columns."""
    hit = _selected(threshold)
    misses = F.col("n") - F.col("pos")
    zero = F.lit(0)
    return [
        F.sum(F.when(hit, F.col("pos")).otherwise(zero)).alias(mark + "tp"),
        F.sum(F.when(hit, misses).otherwise(zero)).alias(mark + "fp"),
        F.sum(F.when(~hit, misses).otherwise(zero)).alias(mark + "tn"),
        F.sum(F.when(~hit, F.col("pos")).otherwise(zero)).alias(mark + "fn"),
    ]


def _rates(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    precision = share(tp, tp + fp)
    recall = share(tp, tp + fn)
    # 2PR/(P+R) in counts, so the zero case needs one guard only.
    f1 = share(2 * tp, 2 * tp + fp + fn)
    accuracy = share(tp + tn, tp + fp + tn + fn)
    return {"precision": precision, "recall": recall, "f1_score": f1, "accuracy": accuracy}


def squared_error() -> Column:
    """Sum of squared errors of a weighted score row set."""
    p = F.col("score")
    return F.sum(F.col("pos") * (1.0 - p) * (1.0 - p) + (F.col("n") - F.col("pos")) * p * p)


def brier_score(table: ScoreTable) -> DataFrame:
    """Mean squared error of the probabilities."""
    out = table.frame.groupBy(*table.keys).agg(
        round4(squared_error() / F.sum("n")).alias("brier_score"), F.sum("n").alias("n")
    )
    return table.strip(out)


def confusion_matrix(table: ScoreTable, threshold: float = 0.5) -> DataFrame:
    """Counts tn, fp, fn, tp at one threshold."""
    out = table.frame.groupBy(*table.keys).agg(*confusion_sums(threshold))
    return table.strip(out.select(*table.keys, "tn", "fp", "fn", "tp"))


def threshold_metrics(table: ScoreTable, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and accuracy at one threshold; 0 on an empty denominator."""
    counts = table.frame.groupBy(*table.keys).agg(*confusion_sums(threshold))
    rates = _rates(F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn"))
    out = counts.select(
        *table.keys,
        F.lit(float(threshold)).alias("threshold"),
        *[round4(v).alias(k) for k, v in rates.items()],
    )
    return table.strip(out)


def binary_metrics(table: ScoreTable, threshold: float = 0.5) -> DataFrame:
    """All binary metrics of one threshold in one row per key.

    The histogram is built once; counts and ranking sums both read it.
    """
    hist = table.histogram()
    curve = hist.curve()
    counts = hist.frame.groupBy(*table.keys).agg(
        *confusion_sums(threshold),
        (squared_error() / F.sum("n")).alias("brier"),
    )
    rates = _rates(F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn"))
    out = table.beside(counts, ranking_sums(hist, curve)).select(
        *table.keys,
        round4(F.col("pr_auc")).alias("pr_auc"),
        round4(F.col("roc_auc")).alias("roc_auc"),
        *[round4(v).alias(k) for k, v in rates.items()],
        round4(F.col("brier")).alias("brier_score"),
        F.lit(float(threshold)).alias("threshold"),
        "tn",
        "fp",
        "fn",
        "tp",
    )
    return table.strip(out)


def classification_report(
    table: ScoreTable,
    threshold: float = 0.5,
    class_names: tuple[str, str] = ("No Churn", "Churn"),
) -> DataFrame:
    """Per-class precision, recall, F1 and support, then accuracy, macro and weighted averages."""
    counts = table.frame.groupBy(*table.keys).agg(*confusion_sums(threshold))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    negative, positive = _rates(tn, fn, tp, fp), _rates(tp, fp, tn, fn)
    n_neg, n_pos = tn + fp, tp + fn
    total = n_neg + n_pos

    def line(name: str, values: list[Column], support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            *[round4(v).alias(m) for v, m in zip(values, ("precision", "recall", "f1_score"))],
            support.alias("support"),
        )

    measures = ("precision", "recall", "f1_score")
    accuracy = positive["accuracy"]
    lines = F.array(
        line(class_names[0], [negative[m] for m in measures], n_neg),
        line(class_names[1], [positive[m] for m in measures], n_pos),
        line("accuracy", [accuracy, accuracy, accuracy], total),
        line("macro avg", [(negative[m] + positive[m]) / 2.0 for m in measures], total),
        line(
            "weighted avg",
            [share(negative[m] * n_neg + positive[m] * n_pos, total) for m in measures],
            total,
        ),
    )
    out = counts.select(*table.keys, F.explode(lines).alias("_line")).select(
        *table.keys, "_line.label", "_line.precision", "_line.recall", "_line.f1_score", "_line.support"
    )
    return table.strip(out)


def threshold_sweep(
    table: ScoreTable, thresholds: Sequence[float] = DEFAULT_THRESHOLDS
) -> DataFrame:
    """Metrics and counts at every threshold, from one pass of conditional sums per key."""
    thresholds = [check_threshold(t) for t in thresholds]
    sums: list[Column] = [F.sum("n").alias("all_n"), F.sum("pos").alias("all_pos")]
    for i, t in enumerate(thresholds):
        hit = _selected(t)
        sums += [
            F.sum(F.when(hit, F.col("n")).otherwise(F.lit(0))).alias(f"_n{i}"),
            F.sum(F.when(hit, F.col("pos")).otherwise(F.lit(0))).alias(f"_p{i}"),
        ]
    counts = table.frame.groupBy(*table.keys).agg(*sums)
    cells = F.array(
        *[
            F.struct(
                F.lit(t).alias("threshold"),
                F.col(f"_n{i}").alias("sel"),
                F.col(f"_p{i}").alias("tp"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    long = counts.select(*table.keys, "all_n", "all_pos", F.explode(cells).alias("_c")).select(
        *table.keys,
        "_c.threshold",
        F.col("_c.tp").alias("tp"),
        (F.col("_c.sel") - F.col("_c.tp")).alias("fp"),
        (F.col("all_n") - F.col("all_pos") - F.col("_c.sel") + F.col("_c.tp")).alias("tn"),
        (F.col("all_pos") - F.col("_c.tp")).alias("fn"),
    )
    rates = _rates(F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn"))
    out = long.select(
        *table.keys,
        round4(F.col("threshold")).alias("threshold"),
        *[round4(v).alias(k) for k, v in rates.items()],
        "tp",
        "fp",
        "tn",
        "fn",
    )
    return table.strip(out)
