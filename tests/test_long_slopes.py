"""Median of pairwise slopes of long series against all pairs."""

import numpy as np
import pandas as pd
import pytest

from tidemark.functions.slopes import inversions, median_pairwise_slope
from tidemark.operators import resample as rs


def all_pairs(x, y):
    i, j = np.triu_indices(len(x), 1)
    ok = x[i] != x[j]
    return None if not ok.any() else float(np.median((y[j] - y[i])[ok] / (x[j] - x[i])[ok]))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 100])
def test_inversions(n):
    p = np.random.default_rng(n).permutation(n)
    assert inversions(p) == sum(int(p[i] > p[j]) for i in range(n) for j in range(i + 1, n))


@pytest.mark.parametrize("seed", range(12))
def test_equals_all_pairs(seed):
    r = np.random.default_rng(seed)
    n = [300, 299, 2, 3, 4, 17][seed % 6]
    x = r.integers(0, 200, n).astype(float) if seed % 2 else np.sort(r.normal(2000, 50, n))
    # few values: most slopes are tied, many at zero
    y = r.integers(0, 4, n).astype(float) if seed % 3 == 0 else 0.3 * x + r.normal(0, 5, n)
    want, got = all_pairs(x, y), median_pairwise_slope(x, y)
    assert (want is None) == (got is None) and (want is None or got == pytest.approx(want, rel=1e-10, abs=1e-13))


def test_flat_and_degenerate():
    x = np.arange(50.0)
    assert median_pairwise_slope(x, np.zeros(50)) == 0
    assert median_pairwise_slope(x, 3 * x) == pytest.approx(3, rel=1e-12)
    assert median_pairwise_slope(np.ones(5), np.arange(5.0)) is None
    assert median_pairwise_slope(np.array([1.0]), np.array([2.0])) is None


def test_long_series_beside_short_ones(spark):
    r = np.random.default_rng(4)
    n = 20_000
    long = pd.DataFrame({"k": "long", "x": np.arange(n, dtype=float), "y": -0.25 * np.arange(n) + r.standard_t(2, n)})
    short = pd.DataFrame({"k": "short", "x": np.arange(300, dtype=float), "y": r.normal(0, 3, 300).round(1)})
    odd = pd.DataFrame({"k": ["two", "two", None, None, None, "hole", "hole"], "x": [1.0, 2, 1, 2, 4, 1, 2], "y": [1.0, 2, 1, 3, 5, None, 1]})
    df = spark.createDataFrame(pd.concat([long, short, odd])).replace(float("nan"), None)
    got = {row["k"]: row for row in rs.theil_sen_long(df, ["k"], "x", "y").collect()}
    assert got["long"]["n"] == n and got["long"]["slope"] == pytest.approx(-0.25, abs=1e-4)
    assert got["short"]["slope"] == pytest.approx(all_pairs(short["x"].to_numpy(), short["y"].to_numpy()), rel=1e-10, abs=1e-13)
    assert got["two"]["slope"] is None and got["two"]["n"] == 2 and got["hole"]["n"] == 1
    assert got[None]["slope"] == pytest.approx(rs.theil_sen(df.where("k is null"), ["k"], "x", "y").first()["slope"])
    whole = rs.theil_sen_long(df.where("k = 'short'"), [], "x", "y").first()
    assert whole["n"] == 300 and whole["slope"] == pytest.approx(got["short"]["slope"])
    assert rs.theil_sen_long(df.where("false"), ["k"], "x", "y").count() == 0
