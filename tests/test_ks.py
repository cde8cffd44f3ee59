"""P-values of the two-sample Kolmogorov-Smirnov statistic."""

from __future__ import annotations

from itertools import combinations

import pytest
from pyspark.sql import functions as F

from riskspark.operators import drift


def statistic(chosen, n, m):
    i, worst = 0, 0
    for k in range(n + m):
        i += k in chosen
        worst = max(worst, abs(i * m - (k + 1 - i) * n))
    return worst


def p_values(spark, rows, **options):
    df = spark.createDataFrame(rows, "ks double, n long, m long")
    p = drift.ks_p_value(F.col("ks"), F.col("n"), F.col("m"), **options)
    return {tuple(r)[:3]: r["p"] for r in df.select("ks", "n", "m", p.alias("p")).collect()}


def test_small_samples_equal_all_orders(spark):
    want = {}
    for n in range(1, 9):
        for m in range(1, 9):
            found = [statistic(set(c), n, m) for c in combinations(range(n + m), n)]
            for h in set(found):
                want[h / (n * m), n, m] = sum(f >= h for f in found) / len(found)
    got = p_values(spark, list(want))
    assert {k: pytest.approx(v, abs=1e-12) for k, v in want.items()} == got


def test_both_forms_are_near_at_the_border(spark):
    size = drift.KS_EXACT_ROWS
    rows = [(h / size, size, size - 7 * (h % 2)) for h in (40, 83, 120, 200, 275)]
    exact, series = p_values(spark, rows), p_values(spark, rows, exact_rows=0)
    gaps = [abs(exact[r] - series[r]) for r in rows]
    assert 0 < max(gaps) < 0.006
    beyond = (0.01, size + 1, size)
    assert p_values(spark, [beyond]) == p_values(spark, [beyond], exact_rows=0)


def test_edges(spark):
    got = p_values(spark, [(0.0, 5, 9), (1.0, 30, 40), (1.0, 1, 1), (0.5, 2, 9000), (None, 3, 0)])
    assert got[0.0, 5, 9] == 1.0 and got[1.0, 1, 1] == 1.0
    assert got[1.0, 30, 40] < 1e-12 and 0 < got[0.5, 2, 9000] < 1
    assert got[None, 3, 0] == 1.0
