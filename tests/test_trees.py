"""Trees on shared bins == trees built node by node on the same bins."""

import random

import numpy as np
import pytest

from candela.operators import risk as RK
from candela.operators import trees as TR

COLS = ["a", "b", "c"]
SCHEMA = "key long, a double, b double, c double, y double, is_train boolean"


@pytest.fixture(scope="module")
def data():
    r = random.Random(9)
    rows = []
    for i in range(400):
        a, b, c = r.gauss(0, 1), r.choice([0.0, 1.0, 5.0]), r.random()
        rows.append((i * 3600, a, b, c, 3.0 * (a > 0.3) - 2.0 * (b == 5.0) + 0.1 * r.gauss(0, 1), i < 300))
    return rows + [(9, None, 1.0, 1.0, 1.0, True), (10, 1.0, 1.0, 1.0, None, True)]


def plain(x, y, w, depth, tried, node=1):
    """Nested splits by trying every cut of every feature tried."""
    n, s = w.sum(), (w * y).sum()
    best = None
    for f in range(x.shape[1]):
        for cut in range(TR.BINS):
            left = x[:, f] <= cut
            ln, ls = w[left].sum(), (w * y)[left].sum()
            if 0 < ln < n and tried(node, f):
                gain = ls * ls / ln + (s - ls) * (s - ls) / (n - ln) - s * s / n
                if gain > 0 and (best is None or gain > best[0]):
                    best = (gain, f, cut)
    out = {node: (s / n, best)}
    if best and depth:
        left = x[:, best[1]] <= best[2]
        out |= plain(x[left], y[left], w[left], depth - 1, tried, 2 * node) | plain(x[~left], y[~left], w[~left], depth - 1, tried, 2 * node + 1)
    return out


@pytest.mark.parametrize("boot", [False, True])
def test_equals_plain_trees(spark, data, boot):
    rows = TR.binned(spark.createDataFrame(data, SCHEMA).repartition(3), COLS, "y", "key")
    fam = TR.grow(rows, TR.Family([(t, 2 if boot else 3, boot) for t in range(4)], 4, 3))
    got = rows.filter("train").toPandas()
    x, y, key = np.array(got["x"].tolist()), got["y"].to_numpy().astype(float), got["key"].to_numpy()
    w = fam.weights(key)
    assert not boot or (set(np.unique(w)) >= {0, 1, 2} and 0.8 < w.mean() < 1.2)
    for t in range(4):
        def tried(node, f, t=t):
            return bool(fam.tried(np.array([t]), np.array([node]))[0, f])
        use = w[:, t] > 0
        want = plain(x[use], y[use], w[use, t].astype(float), 4, tried)
        for node, (value, best) in want.items():
            assert fam.sum[t, node] / fam.count[t, node] == pytest.approx(value)
            if node < 16:
                assert (None if fam.feature[t, node] < 0 else (fam.feature[t, node], fam.cut[t, node])) == (best and best[1:]), (t, node)
        assert (fam.feature[t] >= 0).sum() == sum(1 for n, (_, b) in want.items() if b and n < 16)


def test_grid_boosting_and_importances(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    grid = {r.model: r for r in TR.tree_and_forest_grid(df, COLS, "y", "key", depths=(1, 4), trees=(5, 10), forest_depths=(2, 3), max_features=(2, 8)).collect()}
    assert len(grid) == 2 + 8 and sum(r.best_forest for r in grid.values()) == 1
    assert grid["DT_d4"].r2_train > 0.95 and grid["DT_d4"].r2_test > 0.9 > grid["DT_d1"].r2_train
    imp = [(r.feature, r.importance) for r in TR.importances(df, COLS, "y", "key", trees=10).collect()]
    assert [f for f, _ in imp[:2]] == ["a", "b"] and sum(v for _, v in imp) == pytest.approx(1.0)
    steps = sorted((r["round"], r.r2_train) for r in TR.boosted(df, COLS, "y", "key", rounds=5, depth=2, rate=0.5).collect())
    assert [i for i, _ in steps] == list(range(6)) and abs(steps[0][1]) < 1e-6
    assert all(b[1] > a[1] for a, b in zip(steps, steps[1:])) and steps[-1][1] > 0.9


def test_odd_tables(spark, data):
    flat = spark.createDataFrame([(i, 1.0, 2.0, 3.0, 5.0, i % 2 == 0) for i in range(10)], SCHEMA)
    for r in TR.tree_and_forest_grid(flat, COLS, "y", "key", depths=(2,), trees=(2,), forest_depths=(2,), max_features=(2,)).collect():
        assert r.r2_train is None and r.r2_test is None and not r.best_forest
    assert {r.importance for r in TR.importances(flat, COLS, "y", "key", trees=2).collect()} == {None}
    empty = spark.createDataFrame([], SCHEMA)
    assert all(r.r2_train is None for r in TR.tree_and_forest_grid(empty, COLS, "y", "key", depths=(2,), trees=(2,), forest_depths=(2,), max_features=(2,)).collect())


def test_many_ranks_of_one_value_table(spark):
    r = random.Random(5)
    values = {"a": [r.choice([0.0, r.gauss(0, 1)]) for _ in range(3000)], "b": [2.0] * 50, "c": [1.0]}
    df = spark.createDataFrame([(s, v) for s, vs in values.items() for v in vs], "symbol string, v double").repartition(4)
    ranks = [(s, i, k) for s, vs in values.items() for i, k in enumerate(sorted({1, len(vs), len(vs) // 2 + 1, len(vs) // 3 + 1}))]
    want = {(s, i): sorted(values[s])[k - 1] for s, i, k in ranks}
    for bound in (1 << 16, 20):
        out = RK.order_statistics(df, "v", spark.createDataFrame(ranks, "symbol string, rank int, k long"), max_ordered=bound)
        assert {(x.symbol, x["rank"]): x.kth for x in out.collect()} == want
