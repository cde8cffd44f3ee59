"""Histogram gradient boosting against a plain fit that looks at every row."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from riskspark.models import boosting
from riskspark.models.boosting import HistogramBoosting

GROWTH = boosting.Growth(max_leaf_nodes=6, min_samples_leaf=15, l2=0.5, learning_rate=0.2)


def data(n=500, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n).round(1), rng.integers(0, 4, n), rng.random(n).round(2), np.ones(n)])
    x[rng.random(n) < 0.15, 0] = np.nan
    x[rng.random(n) < 0.05, 1] = np.nan
    score = np.where(np.isnan(x[:, 0]), 1.2, x[:, 0]) + (np.nan_to_num(x[:, 1]) == 2) * 1.5 + x[:, 2]
    return x, (score + rng.normal(size=n) > 1).astype(float)


def brute_best(x, g, h, rows, growth):
    """Every split between two neighbouring values, with missing ones on either side."""

    def worth(r):
        return g[r].sum() ** 2 / (h[r].sum() + growth.l2)

    best = None
    for f in range(x.shape[1]):
        column = x[rows, f]
        gone = np.isnan(column)
        values = np.unique(x[~np.isnan(x[:, f]), f])
        cuts = [*((values[1:] + values[:-1]) / 2), *([np.inf] if gone.any() else [])]
        for missing_left in ([False, True] if gone.any() else [False]):
            for cut in cuts if not missing_left else cuts[:-1]:
                goes = np.where(gone, missing_left, column <= cut)
                left, right = rows[goes], rows[~goes]
                if min(len(left), len(right)) < growth.min_samples_leaf:
                    continue
                gain = worth(left) + worth(right) - worth(rows)
                if gain > 1e-12 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, cut, left, right)
    return best


def brute_fit(x, y, rounds, growth):
    """Leaf values of each row, tree by tree."""
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    steps = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        leaves = [np.arange(len(y))]
        while len(leaves) < growth.max_leaf_nodes:
            found = [(brute_best(x, g, h, rows, growth), i) for i, rows in enumerate(leaves)]
            found = [(b, i) for b, i in found if b]
            if not found:
                break
            (_, _, _, left, right), i = max(found, key=lambda t: t[0][0])
            leaves[i : i + 1] = [left, right]
        step = np.zeros(len(y))
        for rows in leaves:
            step[rows] = -growth.learning_rate * g[rows].sum() / (h[rows].sum() + growth.l2)
        steps.append(step)
        margin = margin + step
    return steps, margin


@pytest.fixture(scope="module")
def rows(spark):
    x, y = data()
    df = spark.createDataFrame([(i, [float(v) for v in a], float(b)) for i, (a, b) in enumerate(zip(x, y))], "id int, x array<double>, y double")
    return df.select("id", array_to_vector("x").alias("features"), F.col("y").alias("label")).cache()


def fitted(rows, rounds, **changes):
    options = dict(maxLeafNodes=6, minSamplesLeaf=15, l2=0.5, learningRate=0.2) | changes
    return HistogramBoosting(maxIter=rounds, **options).fit(rows)


def test_leaf_values_equal_a_plain_fit(rows):
    x, y = data()
    steps, margin = brute_fit(x, y, 6, GROWTH)
    model = fitted(rows, 6)
    assert [len(set(s)) for s in steps] == [t.feature.count(-1) for t in model.trees]
    for step, tree in zip(steps, model.trees):
        leaves = sorted(v for v, f in zip(tree.value, tree.feature) if f < 0)
        assert leaves == pytest.approx(sorted(set(step)), abs=1e-7)
    got = {r["id"]: r["p"] for r in model.transform(rows).select("id", vector_to_array("probability")[1].alias("p")).collect()}
    assert [got[i] for i in range(len(y))] == pytest.approx(list(1 / (1 + np.exp(-margin))), abs=1e-7)
    again = fitted(rows.repartition(7), 6)
    assert again.getOrDefault("forest") == model.getOrDefault("forest")


def test_missing_values_learn_a_side(spark):
    rows = [(i, float("nan") if i % 3 == 0 else float(i % 5), float(i % 3 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, v double, label double").withColumn("features", array_to_vector(F.array("v")))
    tree = fitted(df, 1).trees[0]
    assert tree.threshold[0] == float("inf") and not tree.missing_left[0] and tree.rows[:3] == [300, 200, 100]
    seen = fitted(df.where("NOT isnan(v)").withColumn("label", (F.col("v") > 2).cast("double")), 1).trees[0]
    # Without missing values in the fit they go with most rows.
    assert seen.missing_left[0] == (seen.rows[seen.left[0]] >= seen.rows[seen.right[0]])


def test_limits_and_edges(spark, rows):
    deep = fitted(rows, 1, maxLeafNodes=31, minSamplesLeaf=1)
    assert deep.trees[0].feature.count(-1) == 31
    flat = fitted(rows, 1, maxDepth=1, maxLeafNodes=31)
    assert flat.trees[0].feature.count(-1) == 2
    one = fitted(rows.withColumn("label", F.lit(1.0)), 3)
    assert one.transform(rows).where("prediction = 0").count() == 0
    with pytest.raises(ValueError):
        fitted(rows.limit(0), 1)
    with pytest.raises(ValueError):
        fitted(rows, 1, maxBins=256)
    few = fitted(rows, 3, maxBins=4)
    assert all(len({t for t, f in zip(tree.threshold, tree.feature) if f == 2}) <= 3 for tree in few.trees)


def test_stored_model_scores_alike(spark, rows, tmp_path):
    model = Pipeline(stages=[HistogramBoosting(maxIter=3, minSamplesLeaf=15)]).fit(rows)
    model.write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    columns = ["id", vector_to_array("probability")[1].alias("p")]
    assert sorted(model.transform(rows).select(*columns).collect()) == sorted(loaded.transform(rows).select(*columns).collect())
    shares = loaded.stages[-1].featureImportances.toArray()
    assert shares.sum() == pytest.approx(1) and shares[3] == 0
    nodes = loaded.stages[-1].node_table(spark)
    assert nodes.where("feature < 0").groupBy("tree").agg(F.sum("rows").alias("n")).where("n <> 500").count() == 0


def test_shared_codes_give_the_sums_of_every_feature(spark, monkeypatch):
    """Features that share a code keep their own sums, rows are dealt to several tasks, and trees stay the same."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 3, (500, 12)).astype(float)
    x[:, 4] = rng.random(500)
    x[rng.random(x.shape) < 0.1] = np.nan
    layout = boosting.Layout(tuple(np.unique(c[~np.isnan(c)])[:-1] + 1e-9 for c in x.T[:, :200]))
    assert 1 < len(layout.groups) < len(layout.edges)
    codes = layout.codes(x)
    counts = [np.bincount(c, minlength=n) for c, n in zip(codes.T, layout.codes_of)]
    cells = layout.cells([c[None] for c in counts])[0]
    for f, edges in enumerate(layout.edges):
        bins = np.where(np.isnan(x[:, f]), len(edges) + 1, np.searchsorted(edges, x[:, f]))
        own = cells[layout.offsets[f] : layout.offsets[f] + layout.sizes[f]]
        assert own.tolist() == np.bincount(bins, minlength=layout.sizes[f]).tolist()

    rows = spark.createDataFrame([(r.tolist(), float(r[0] == 1)) for r in x], "x array<double>, y double")
    forests = []
    for most in (boosting.ROWS_PER_TASK, 100):
        monkeypatch.setattr(boosting, "ROWS_PER_TASK", most)
        binned, made, _, scale = boosting.prepared(rows, "x", "y", 255)
        forests.append([vars(t) for t in boosting.boost(binned, made, 2, scale, GROWTH)])
    assert len(binned.inputFiles()) > 1
    assert forests[0] == forests[1]
