"""The score table: labelled scores, by row or as a histogram of distinct scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.operators.distribution import running_totals, side_by_side

SCOPE = "scope"


@dataclass(frozen=True)
class ScoreTable:
    """Rows of ``(keys…, score, n, pos)``: ``n`` observations, ``pos`` of them positive.

    ``decimals`` is set when scores are rounded to a fixed grid; each key then has
    at most ``10**decimals + 1`` distinct scores and ordering them needs one small
    window. Without it, ordering goes through the bucketed running totals.
    ``grouped`` tells whether the frame already has one row per distinct score.
    """

    frame: DataFrame
    keys: tuple[str, ...]
    decimals: int | None = None
    grouped: bool = False

    @property
    def bounded(self) -> bool:
        return self.decimals is not None and self.decimals <= 5

    def histogram(self) -> "ScoreTable":
        """One row per (keys, score); partial aggregation absorbs hot scores map-side."""
        if self.grouped:
            return self
        hist = self.frame.groupBy(*self.keys, "score").agg(
            F.sum("n").alias("n"), F.sum("pos").alias("pos")
        )
        return replace(self, frame=hist, grouped=True)

    def curve(self) -> DataFrame:
        """Histogram by falling score with inclusive running counts ``cum_n``, ``cum_pos``."""
        return running_totals(
            self.histogram().frame,
            self.keys,
            "score",
            ["n", "pos"],
            descending=True,
            bounded=self.bounded,
        )

    def beside(self, left: DataFrame, right: DataFrame) -> DataFrame:
        """Two per-key frames side by side; without real keys both have one row."""
        if self.keys == (SCOPE,):
            return side_by_side(left, right.drop(SCOPE))
        return left.join(right, list(self.keys), "left")

    def strip(self, frame: DataFrame) -> DataFrame:
        """Drop the constant key that stands for 'the whole table'."""
        return frame.drop(SCOPE) if self.keys == (SCOPE,) else frame


def usable(label: str, score: str) -> Column:
    """The rule for rows of a score table: both label and score are known.

    Rows without one of them are left out of every metric; ``skipped_rows`` counts them.
    """
    value = F.col(score).cast("double")
    return F.col(label).isNotNull() & value.isNotNull() & ~F.isnan(value)


def skipped_rows(df: DataFrame, label: str = "y_true", score: str = "y_prob") -> DataFrame:
    """One row: ``rows`` of the table and how many are ``skipped`` for a missing label or score."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(~usable(label, score), 1)).alias("skipped"),
    )


def score_table(
    df: DataFrame,
    label: str = "y_true",
    score: str = "y_prob",
    keys: Sequence[str] = (),
    decimals: int | None = None,
) -> ScoreTable:
    """Score rows of ``df``; rows that are not :func:`usable` or have a null key are left out."""
    keys = tuple(keys)
    value = F.col(score).cast("double")
    if decimals is not None:
        value = F.round(value, decimals)
    frame = df.where(usable(label, score)).select(
        *(keys or [F.lit("all").alias(SCOPE)]),
        value.alias("score"),
        F.lit(1).cast("bigint").alias("n"),
        F.col(label).cast("bigint").alias("pos"),
    )
    for key in keys:
        frame = frame.filter(F.col(key).isNotNull())
    return ScoreTable(frame, keys or (SCOPE,), decimals)


def score_cells(
    df: DataFrame,
    dimensions: Sequence[str],
    label: str = "y_true",
    score: str = "y_prob",
    keys: Sequence[str] = (),
    decimals: int | None = None,
) -> DataFrame:
    """Rows counted per combination of keys, dimensions and score.

    Both the score histogram and the per-dimension tables can be read from it. Rows that
    are not :func:`usable` are left out.
    """
    value = F.col(score).cast("double")
    if decimals is not None:
        value = F.round(value, decimals)
    return (
        df.where(usable(label, score))
        .select(
            *keys,
            *[F.col(d).cast("string").alias(d) for d in dimensions],
            value.alias("score"),
            F.col(label).cast("bigint").alias("pos"),
        )
        .groupBy(*keys, *dimensions, "score")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("pos"))
    )


def fan_out(
    rows: DataFrame,
    dimensions: Sequence[str],
    keys: Sequence[str] = (),
    decimals: int | None = None,
) -> ScoreTable:
    """Score rows or cells repeated once per dimension, keyed by (keys…, dimension, value)."""
    cells = F.array(
        *[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dimensions]
    )
    long = rows.select(*keys, "score", "n", "pos", F.explode(cells).alias("_cell")).select(
        *keys,
        F.col("_cell.dimension").alias("dimension"),
        F.col("_cell.value").alias("value"),
        "score",
        "n",
        "pos",
    )
    for key in (*keys, "value"):
        long = long.filter(F.col(key).isNotNull())
    return ScoreTable(long, (*keys, "dimension", "value"), decimals)


def by_dimension(
    df: DataFrame,
    dimensions: Sequence[str],
    label: str = "y_true",
    score: str = "y_prob",
    keys: Sequence[str] = (),
    decimals: int | None = None,
) -> ScoreTable:
    """Score rows keyed by ``(keys…, dimension, value)`` for several dimensions at once.

    Rows are first counted per combination of dimensions and score, so the fan-out
    repeats counted cells instead of rows.
    """
    return fan_out(
        score_cells(df, dimensions, label, score, keys, decimals), dimensions, keys, decimals
    )
