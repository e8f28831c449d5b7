"""Partial autocorrelation by a fold == the recursion written out, and == regressions."""

import numpy as np
import pytest

from candela.operators import aggregates as AG


def recursion(r):
    k = len(r)
    r, phi, out = [1.0, *r], {}, []
    for m in range(1, k + 1):
        den = 1.0 - sum(phi[m - 1, j] * r[j] for j in range(1, m))
        new = (r[m] - sum(phi[m - 1, j] * r[m - j] for j in range(1, m))) / den
        for j in range(1, m):
            phi[m, j] = phi[m - 1, j] - new * phi[m - 1, m - j]
        phi[m, m] = new
        out.append(new)
    return out


def test_pacf(spark):
    x = np.convolve(np.random.default_rng(1).normal(size=400), [1.0, -0.7, 0.4])
    x -= x.mean()
    tables = {"ar": [0.8**k for k in range(1, 31)], "mixed": [float(x[k:] @ x[: len(x) - k] / (x @ x)) for k in range(1, 31)], "one": [0.4]}
    rows = [(s, k + 1, v) for s, r in tables.items() for k, v in enumerate(r)] + [("flat", k, None) for k in range(1, 6)]
    out = AG.pacf(spark.createDataFrame(rows, "symbol string, lag int, acf double").repartition(3))
    got = {}
    for r in sorted(out.collect()):
        got.setdefault(r.symbol, []).append(r.pacf)
    for s, r in tables.items():
        assert got[s] == pytest.approx(recursion(r), abs=1e-12)
    assert got["ar"][1:] == pytest.approx([0.0] * 29, abs=1e-12) and got["flat"] == [None] * 5
    # order m of the partial autocorrelation is the last coefficient of the Yule-Walker regression of that order
    r = [1.0, *tables["mixed"]]
    for m in (1, 2, 7):
        a = np.array([[r[abs(i - j)] for j in range(m)] for i in range(m)])
        assert got["mixed"][m - 1] == pytest.approx(np.linalg.solve(a, np.array(r[1 : m + 1]))[-1])
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_perfect_prediction_is_undefined_after(spark):
    out = AG.pacf(spark.createDataFrame([("x", 1, 1.0), ("x", 2, 1.0), ("x", 3, 1.0)], "symbol string, lag int, acf double"))
    assert [r.pacf for r in sorted(out.collect())] == [1.0, None, None]
