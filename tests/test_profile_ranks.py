"""Spearman correlations of many columns with missing values against pandas."""

import numpy as np
import pandas as pd
import pytest

from quarrymill.operators import profile


def check(spark, frame):
    cols = list(frame.columns)
    rows = [tuple(None if pd.isna(v) else float(v) for v in r) for r in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5)
    want = frame.corr(method="spearman", min_periods=2)
    got = profile.corr_matrix(df, cols, "spearman").collect()
    assert len(got) == len(cols) * (len(cols) - 1) // 2
    for r in got:
        expected = want.loc[r["a"], r["b"]]
        assert r["corr"] is None if np.isnan(expected) else r["corr"] == pytest.approx(expected, abs=1e-9)


def test_a_hundred_columns_with_nulls(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(rng.normal(size=(300, 100)).round(1), columns=[f"c{i}" for i in range(100)])
    for i in range(0, 100, 3):
        frame.loc[rng.random(300) < 0.2, f"c{i}"] = None
    frame["c1"] = 7.0  # does not vary
    frame["c3"] = None  # no value at all
    frame.loc[5:, "c6"] = None
    check(spark, frame)


def test_hot_values_are_salted(spark, big):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"a": rng.integers(0, 3, 200).astype(float), "b": rng.normal(size=200), "c": [0.0] * 190 + list(range(10))})
    frame.loc[::7, "b"] = None
    check(spark, frame)
