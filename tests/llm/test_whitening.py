from __future__ import annotations

import math

import numpy as np
import pytest

from riskspark.llm import whitening
from riskspark.llm.common import table


def exact(vectors):
    """Whole numbers, exact covariance as doubles, and deviations, by Python's integers."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, width = len(x), len(x[0])
    sums = [sum(row[d] for row in x) for d in range(width)]
    centred = [[n * row[d] - sums[d] for d in range(width)] for row in x]
    covariance = np.array(
        [[sum(r[a] * r[b] for r in centred) / n**3 for b in range(width)] for a in range(width)]
    )
    return n, centred, covariance, [sum(v * v for v in r) for r in centred]


def test_planes_give_exact_products():
    rng = np.random.default_rng(1)
    for kind, top in ((np.int64, 1 << 10), (object, 1 << 45)):
        for rows in (1, 63, 64, 200):
            x = rng.integers(0, top, (rows, 5), dtype=np.int64)
            x[:, 2] = 0
            bits = np.array([int(v).bit_length() for v in x.max(axis=0)])
            total = np.zeros((5, 5), kind)
            whitening.cross_products(whitening.bit_planes(x.view(np.uint64), bits), bits, total)
            want = x.astype(object).T @ x.astype(object)
            assert all(int(total[a, b]) == want[a, b] for a in range(5) for b in range(a, 5))


def test_query_equals_numpy(spark, sf_dir):
    given = {r[0]: r[1] for r in table(spark, sf_dir, "embeddings", "vec_id", "embedding").collect()}
    n, centred, covariance, deviations = exact(list(given.values()))
    values, directions = np.linalg.eigh(covariance)
    values, directions = values[::-1], directions[:, ::-1]
    got = whitening.op12_bit_sliced_whitening(spark, sf_dir)
    assert [t for _, t in got.dtypes] == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    rows = got.collect()
    assert len(rows) == 32 * n and {r["n"] for r in rows} == {n}
    assert max(r["identity_error"] for r in rows) < 1e-9
    assert len({r["identity_error"] for r in rows}) == 1
    deviation = dict(zip(given, deviations))
    place = {vec_id: i for i, vec_id in enumerate(given)}
    z = np.zeros((n, 32))
    for r in rows:
        assert r["deviation"] == deviation[r["vec_id"]]
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(covariance), rel=1e-9)
        z[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
    want = np.array(centred, float) / n @ directions[:, :32] / np.sqrt(values[:32])
    for k in range(32):
        assert min(np.abs(z[:, k] - want[:, k]).max(), np.abs(z[:, k] + want[:, k]).max()) < 1e-6


def test_large_and_constant_entries(spark):
    rng = np.random.default_rng(2)
    vectors = [[float(a) * 1e12, 3.0, float(b)] for a, b in rng.normal(size=(70, 2))]
    docs = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, v array<double>")
    n, centred, covariance, deviations = exact(vectors)
    rows = sorted(whitening.whiten(docs, "v").collect(), key=lambda r: r["vec_id"])
    assert [int(r["deviation"]) for r in rows] == deviations
    assert rows[0]["eigenvalues"][0] == pytest.approx(np.linalg.eigvalsh(covariance)[-1])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [[1.0, 2.0], [3.0, 1.0], [0.5, -2.0], [0.5, -2.0]]
    rows = [(i, v, "x") for i, v in enumerate(good)]
    rows += [(None, [9.0, 9.0], "x"), (5, None, "x"), (6, [1.0, None], "x"), (7, [nan, 1.0], "x"), (8, [1.0, -inf], "x")]
    rows += [(9, [], "x"), (10, [1.0, 2.0, 3.0], "x"), (11, [1e30, 0.0], "x")]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<float>, n string")
    got = whitening.whiten(vectors, "v").collect()
    assert sorted((r["vec_id"] is None, r["vec_id"]) for r in got) == [(False, 0), (False, 1), (False, 2), (False, 3), (True, None)]
    assert {r["n"] for r in got} == {5} and all(len(r["whitened"]) == 2 for r in got)
    z = np.array([r["whitened"] for r in got])
    assert np.abs(z.T @ z / 5 - np.eye(2)).max() < 1e-12 and got[0]["identity_error"] < 1e-12
    for few in (vectors.limit(0), vectors.where("vec_id = 5")):
        assert whitening.whiten(few, "v").collect() == []
    one = whitening.whiten(vectors.where("vec_id = 1"), "v").collect()
    assert [(r["n"], r["deviation"], r["whitened"]) for r in one] == [(1, 0, [])]
    whole = vectors.select("vec_id", vectors.v.cast("array<decimal(10,2)>").alias("v")).where("vec_id < 4")
    assert len(whitening.whiten(whole, "v").collect()) == 4
