"""Rolling aggregates by doubling == the window aggregates over the same frames."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from candela.operators import features as FE
from candela.operators import series as S

AGGS = {"avg": F.avg, "max": F.max, "min": F.min, "stddev_samp": F.stddev_samp}


@pytest.fixture(scope="module")
def frame(spark):
    r = random.Random(4)
    rows = [(s, i, 1e6 + i + r.gauss(0, 1e-2) if s == "trend" else None if s == "gaps" and r.random() < 0.1 else r.choice([1.0, 2.0, 5.0]), r.gauss(0, 1))
            for s, n in (("trend", 300), ("gaps", 300), ("short", 9)) for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, rn long, x double, y double").repartition(3)


@pytest.mark.parametrize("sizes", [(1, 2, 3, 7), (8, 14, 100), (255, 256)])
def test_equals_window_aggregates(frame, sizes):
    w = Window.partitionBy("symbol").orderBy("rn")
    wants = [(a, c, n, f"{a}_{c}_{n}") for a in AGGS for c in ("x", "y") for n in sizes]
    got = FE.doubling(frame, w, wants)
    assert set(got.columns) == {"symbol", "rn", "x", "y", *[v[3] for v in wants]}
    for a, c, n, out in wants:
        f = w.rowsBetween(-(n - 1), 0)
        got = got.withColumn("want_" + out, F.when(F.count(c).over(f) >= n, AGGS[a](c).over(f)))
    p = got.toPandas()
    for a, _, n, out in wants:
        if a == "stddev_samp" and n == 1:
            assert p[out].isna().all()
            continue
        x, y = p[out].astype(float), p["want_" + out].astype(float)
        assert (x.isna() == y.isna()).all(), out
        np.testing.assert_allclose(x, y, rtol=1e-9, atol=1e-12, equal_nan=True)


def test_one_window_operator_a_level(frame):
    w = Window.partitionBy("symbol").orderBy("rn")
    plan = FE.doubling(frame, w, [("avg", "x", 200, "a"), ("max", "x", 200, "b"), ("avg", "y", 14, "c")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 8 and plan.count("Exchange hashpartitioning") == 1


def test_bank_over_small_blocks(small_blocks):
    from candela.sources.fixtures import bars_hourly
    from tests.conftest import SF0001
    b = S.index_series(bars_hourly(small_blocks, SF0001))
    got = FE.feature_bank(b, (3, 14, 50)).toPandas().sort_values(["symbol", "bar_ts"]).reset_index(drop=True)
    for s, g in got.groupby("symbol"):
        np.testing.assert_allclose(g.ma14.astype(float), g.close.rolling(14).mean() / g.close, rtol=1e-10, equal_nan=True)
        np.testing.assert_allclose(g.std50.astype(float), g.close.rolling(50).std() / g.close, rtol=1e-8, equal_nan=True)
        np.testing.assert_allclose(g.hh50.astype(float), g.high / g.high.rolling(50).max(), rtol=1e-12, equal_nan=True)
