"""Kept reference profiles."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from riskspark.operators import reference_profile as kept
from riskspark.operators.drift import DriftPolicy, detect_drift

RNG = np.random.default_rng(5)
NUMERIC, WORDS = ["a", "b", "absent"], ["w"]


def table(spark, n, shift=0.0):
    frame = pd.DataFrame({
        "a": RNG.normal(shift, 1, n).round(3), "b": RNG.integers(0, 4, n).astype(float), "w": RNG.choice(["x", "y", "z"], n),
    })
    frame.loc[frame.index % 9 == 0, "a"] = np.nan
    return spark.createDataFrame(frame)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_drift_equals_that_of_the_two_tables(spark, tmp_path):
    first, second, batch = table(spark, 400), table(spark, 300), table(spark, 500, 0.4)
    policy = DriftPolicy(ks_alpha=0.05, missing_rate_delta=0.05)
    root = str(tmp_path / "p")
    assert [kept.add_to_profile(spark, root, t, NUMERIC, WORDS) for t in (first, second)] == [1, 2]
    union = first.union(second)
    assert rows_of(kept.load_profile(spark, root)) == rows_of(kept.profile_table(union, NUMERIC, WORDS))
    for version, reference in ((None, union), (1, first)):
        want = detect_drift(batch, reference, NUMERIC, WORDS, policy)
        got = kept.drift_from_profile(batch, kept.load_profile(spark, root, version), NUMERIC, WORDS, policy)
        assert [rows_of(df) for df in got] == [rows_of(df) for df in want]
    with pytest.raises(ValueError):
        kept.load_profile(spark, root, 9)
    with pytest.raises(ValueError):
        kept.drift_from_profile(batch, kept.load_profile(spark, root), ["other"], [])


def test_compacted_profiles_keep_ranks(spark, tmp_path):
    df, size = table(spark, 5000), 50
    profile = kept.profile_table(df, NUMERIC, WORDS)
    version = kept.save_profile(profile, str(tmp_path / "p"), size)
    small = kept.load_profile(spark, str(tmp_path / "p"), version).toPandas()
    whole = profile.toPandas()
    for feature in ("b", "w"):
        assert sorted(map(str, small[small.feature == feature].values)) == sorted(map(str, whole[whole.feature == feature].values))
    a, b = (t[(t.feature == "a")] for t in (whole, small))
    assert len(b) <= size + 2 < len(a) and a.n.sum() == b.n.sum()
    assert b[b.number.isna()].n.sum() == a[a.number.isna()].n.sum()
    a, b = a.dropna(subset="number"), b.dropna(subset="number")
    for v in a.number:
        assert abs(a[a.number <= v].n.sum() - b[b.number <= v].n.sum()) < a.n.sum() / size
