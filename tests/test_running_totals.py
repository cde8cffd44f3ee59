"""The ordered core: buckets, running totals, quantiles, selection in hash order."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark.functions.ordering import magnitude_bucket
from riskspark.operators.distribution import edge_bin, exact_quantiles, running_totals
from riskspark.operators.selection import slots_by_hash

RNG = np.random.default_rng(7)
SHAPES = {
    "uniform": RNG.uniform(0, 1, 800),
    "signed": RNG.normal(0, 1e3, 800),
    "narrow": 1.7e9 + RNG.integers(0, 500, 800).astype(float),
    "extreme": np.array([0.0, -0.0, 5e-324, -5e-324, 1e-308, 1e308, -1e308, 1.7976931348623157e308, 1.0, 2.0, 4.0, 8.0, 1e15]),
    "one_value": np.full(50, 0.25),
}


def test_bucket_never_falls_as_values_rise(spark):
    powers = [2.0**k for k in range(-40, 41)]
    near = [np.nextafter(p, d) for p in powers for d in (0.0, math.inf)]
    values = sorted({float(v) for v in [*powers, *near, *[-p for p in powers], *np.concatenate(list(SHAPES.values()))]})
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    got = rows.select("v", magnitude_bucket(F.col("v")).alias("b")).toPandas().sort_values("v")
    assert got["b"].is_monotonic_increasing
    assert got["b"].nunique() > 1_000


@pytest.mark.parametrize("shape,descending", [(s, i % 2 == 1) for i, s in enumerate(SHAPES)])
def test_running_totals_equal_a_plain_sort(spark, shape, descending):
    frame = pd.DataFrame({"k": ["a", "b"] * (len(SHAPES[shape]) // 2) + ["a"] * (len(SHAPES[shape]) % 2), "v": SHAPES[shape] + 0.0})
    frame = frame.groupby(["k", "v"], as_index=False).size().rename(columns={"size": "n"})
    want = frame.sort_values("v", ascending=not descending)
    want = want.assign(cum_n=want.groupby("k")["n"].cumsum(), all_n=want.groupby("k")["n"].transform("sum"))
    want = sorted(map(tuple, want[["k", "v", "n", "cum_n", "all_n"]].to_numpy().tolist()))
    for parts, bounded in ((1, False), (7, False), (7, True)):
        rows = spark.createDataFrame(frame).repartition(parts)
        got = running_totals(rows, ["k"], "v", ["n"], descending, bounded)
        assert sorted(tuple(r) for r in got.select("k", "v", "n", "cum_n", "all_n").collect()) == want


@pytest.mark.parametrize("shape", ["uniform", "signed", "narrow", "one_value"])
def test_quantiles_equal_numpy(spark, shape):
    steps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    rows = spark.createDataFrame([("a", float(v)) for v in SHAPES[shape]], "k string, v double")
    got = exact_quantiles(rows, ["k"], "v", steps).first()["quantiles"]
    assert got == pytest.approx(np.quantile(SHAPES[shape], steps).tolist(), rel=1e-12)


def test_edge_bins_follow_the_histogram_rule(spark):
    edges = [0.0, 1.0, 2.0, 4.0]
    rows = spark.createDataFrame([(v,) for v in (-0.1, 0.0, 0.5, 1.0, 3.9, 4.0, 4.1)], "v double")
    got = [r[0] for r in rows.select(edge_bin(F.col("v"), F.array(*[F.lit(e) for e in edges]))).collect()]
    assert got == [None, 0, 0, 1, 2, 2, None]


def test_slots_follow_the_full_hash_order(spark):
    ids = [f"id{i}" for i in range(3_000)]
    cuts = {"x": [500, 900], "y": [0, 1]}
    rows = [("x" if i % 3 else "y", v) for i, v in enumerate(ids)]
    frame = spark.createDataFrame(rows, "k string, id string").repartition(5)
    cut_frame = spark.createDataFrame(list(cuts.items()), "k string, cuts array<bigint>")
    got = slots_by_hash(frame, ["k"], F.md5("id"), cut_frame, ["id"], 2).toPandas()
    want = {}
    for key in cuts:
        members = sorted((hashlib.md5(v.encode()).hexdigest(), v) for k, v in rows if k == key)
        want.update({v: sum(c < rank for c in cuts[key]) for rank, (_, v) in enumerate(members, 1)})
    assert dict(zip(got["id"], got["slot"])) == want
