"""Value histograms, running totals and exact quantiles that stay distributed.

Most of the library works on a histogram (one row per distinct value) instead of
on rows: it is built with map-side partial aggregation, so a hot value costs no
more than a rare one, and everything ordered is computed from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.ordering import coarse_bucket, magnitude_bucket

# Frames below this many rows (a bound known from their construction, not a guess)
# may be broadcast; larger ones are left to the shuffle join.
SMALL_ROWS = 200_000


def small(frame: DataFrame, max_rows: int | None) -> DataFrame:
    """Broadcast hint for a frame whose row count has a known, small bound.

    Without a bound, or above the limit, the join strategy stays with the planner.
    """
    return F.broadcast(frame) if max_rows is not None and max_rows <= SMALL_ROWS else frame


def side_by_side(*frames: DataFrame) -> DataFrame:
    """One-row frames with different columns as one row, without a join."""
    names = [c for frame in frames for c in frame.columns]
    if len(names) != len(set(names)):
        raise ValueError(f"column names repeat: {sorted(names)}")
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in names])


def finite(value: Column) -> Column:
    """Double with NaN turned into null, so missing has one form."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def unpivot(
    df: DataFrame,
    columns: Sequence[str],
    keep: Sequence[str] = (),
    name: str = "feature",
    value: str = "value",
    as_type: str = "double",
) -> DataFrame:
    """Long form of several columns in one narrow step (no shuffle)."""
    def cell(column: str) -> Column:
        return finite(F.col(column)) if as_type == "double" else F.col(column).cast(as_type)

    cells = F.array(
        *[F.struct(F.lit(c).alias(name), cell(c).alias(value)) for c in columns]
    )
    return df.select(*keep, F.explode(cells).alias("_cell")).select(
        *keep, F.col(f"_cell.{name}").alias(name), F.col(f"_cell.{value}").alias(value)
    )


def running_totals(
    hist: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Sequence[str],
    descending: bool = False,
    bounded: bool = False,
) -> DataFrame:
    """Inclusive running totals ``cum_*`` and key totals ``all_*`` of ``sums`` along ``order``.

    ``hist`` has one row per (keys, order) and no null in either. With
    ``bounded=True`` the caller vouches for few distinct values per key (a score
    grid of four decimals has 10,001) and one window per key does it. Otherwise
    the values are cut into order-preserving buckets of two widths: one window
    inside each fine bucket, one over the fine totals of each coarse bucket, one
    over the coarse totals of each key. Every window has a bounded size, so no
    task ever sorts a whole key, and the totals are exact. The key totals ride
    along with the bucket offsets, so using them needs no join on the bare key.
    """
    keys = list(keys)
    by = F.col(order).desc() if descending else F.col(order).asc()
    upto_here = (Window.unboundedPreceding, Window.currentRow)
    before_here = (Window.unboundedPreceding, -1)
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)

    if bounded:
        scope = Window.partitionBy(*keys).orderBy(by)
        return hist.select(
            "*",
            *[F.sum(s).over(scope.rowsBetween(*upto_here)).alias("cum_" + s) for s in sums],
            *[F.sum(s).over(scope.rowsBetween(*whole)).alias("all_" + s) for s in sums],
        )

    # Never null, so the joins below add no null filters of their own and all
    # branches read one and the same histogram exchange.
    cut = hist.withColumn("_fine", F.coalesce(magnitude_bucket(F.col(order)), F.lit(0)))
    cut = cut.withColumn("_coarse", coarse_bucket(F.col("_fine")))

    def step(column: str) -> Column:
        return F.col(column).desc() if descending else F.col(column).asc()

    fine = cut.groupBy(*keys, "_coarse", "_fine").agg(*[F.sum(s).alias(s) for s in sums])
    coarse = fine.groupBy(*keys, "_coarse").agg(*[F.sum(s).alias(s) for s in sums])

    def before(window: Window, column: str) -> Column:
        return F.coalesce(F.sum(column).over(window.rowsBetween(*before_here)), F.lit(0))

    by_coarse = Window.partitionBy(*keys).orderBy(step("_coarse"))
    coarse_offsets = coarse.select(
        *keys,
        "_coarse",
        *[before(by_coarse, s).alias("_c_" + s) for s in sums],
        *[F.sum(s).over(by_coarse.rowsBetween(*whole)).alias("all_" + s) for s in sums],
    )
    by_fine = Window.partitionBy(*keys, "_coarse").orderBy(step("_fine"))
    fine_offsets = (
        fine.select(*keys, "_coarse", "_fine", *[before(by_fine, s).alias("_f_" + s) for s in sums])
        .join(coarse_offsets, [*keys, "_coarse"])
        .select(
            *keys,
            "_fine",
            *[(F.col("_f_" + s) + F.col("_c_" + s)).alias("_o_" + s) for s in sums],
            *["all_" + s for s in sums],
        )
    )
    inside = Window.partitionBy(*keys, "_fine").orderBy(by).rowsBetween(*upto_here)
    ranked = cut.drop("_coarse").select(
        "*", *[F.sum(s).over(inside).alias("_w_" + s) for s in sums]
    )
    return ranked.join(fine_offsets, [*keys, "_fine"]).select(
        *hist.columns,
        *[(F.col("_w_" + s) + F.col("_o_" + s)).alias("cum_" + s) for s in sums],
        *["all_" + s for s in sums],
    )


def value_curve(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    counts: dict[str, Column] | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Ascending value histogram with running counts: (keys, value, n…, cum_n…)."""
    counts = counts or {"n": F.count(F.lit(1))}
    hist = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(*[c.cast("bigint").alias(name) for name, c in counts.items()])
    )
    return running_totals(hist, keys, value, list(counts), bounded=bounded)


def quantiles_from_curve(
    curve: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    count: str = "n",
    out: str = "quantiles",
) -> DataFrame:
    """Exact linearly interpolated quantiles, one array per key.

    The order statistics are read off the running counts with conditional minima,
    so no task holds the values of a key.
    """
    keys = list(keys)
    parts, cells = [], []
    for i, q in enumerate(probabilities):
        position = f"((all_{count} - 1) * CAST({float(q)!r} AS double))"
        parts += [
            F.expr(f"min(CASE WHEN cum_{count} > floor({position}) THEN `{value}` END) AS _lo{i}"),
            F.expr(f"min(CASE WHEN cum_{count} > ceil({position}) THEN `{value}` END) AS _hi{i}"),
            F.expr(f"max({position} - floor({position})) AS _w{i}"),
        ]
        cells.append(f"_lo{i} + (_hi{i} - _lo{i}) * _w{i}")
    picked = curve.filter(f"`{count}` > 0").groupBy(*keys).agg(*parts)
    return picked.select(*keys, F.expr(f"array({', '.join(cells)})").alias(out))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: Sequence[float],
    out: str = "quantiles",
) -> DataFrame:
    """Exact quantiles of ``value`` per key straight from rows."""
    return quantiles_from_curve(value_curve(df, keys, value), keys, value, probabilities, out=out)


def edge_bin(value: Column, edges: Column) -> Column:
    """Index (from 0) of the histogram bin of ``value`` in ascending distinct ``edges``.

    Bins are closed on the left, the last one on both sides; values outside all
    bins give null.
    """
    below = F.size(F.filter(edges, lambda e: e <= value))
    last = F.element_at(edges, -1)
    return (
        F.when((value < F.element_at(edges, 1)) | (value > last), F.lit(None).cast("int"))
        .when(value == last, F.size(edges) - 2)
        .otherwise(below - 1)
    )
