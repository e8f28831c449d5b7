"""Flat series, zero prices, odd names and gaps through the operators that divide, join or name columns."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from candela.config import StrategyConfig
from candela.operators import aggregates as AG
from candela.operators import features as FE
from candela.operators import joins as JN
from candela.operators import ml as ML
from candela.operators import pnl as PN
from candela.operators import portfolio as PF
from candela.operators import risk as RK
from candela.operators import trees as TR
from candela.operators import signals as SG

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def bars(spark):
    """A flat symbol beside one that moves."""
    rows = []
    for h in range(60):
        for s, p in (("flat", 50.0), ("move", 50.0 + (h * 7919 % 23))):
            rows.append((s, START + dt.timedelta(hours=h), p, p + 1, p - 1, p, 10.0))
    return spark.createDataFrame(rows, "symbol string, bar_ts timestamp_ntz, open double, high double, low double, close double, volume double")


def by_symbol(df, c):
    out = {}
    for r in df.collect():
        out.setdefault(r.symbol, []).append(r[c])
    return out


def test_flat_series_give_null_and_leave_others(bars):
    acf = AG.acf(bars, "close", 4)
    got = by_symbol(acf, "acf")
    assert got["flat"] == [None] * 4 and all(x is not None for x in got["move"])
    pacf = by_symbol(AG.pacf(acf), "pacf")
    assert pacf["flat"] == [None] * 4 and all(x is not None for x in pacf["move"])
    scores = by_symbol(AG.regression_scores(bars, "close", "open"), "r2")
    assert scores == {"flat": [None], "move": [1.0]}
    both = bars.withColumn("k", (F.col("close") > 60).cast("int")).withColumn("is_train", F.lit(True))
    for quadratic in (False, True):
        pred = by_symbol(ML.discriminant_2d(both, "close", "volume", "k", quadratic=quadratic), "pred")
        assert set(pred["flat"]) == {None}


def test_loss_of_everything_and_zero_price(spark):
    r = spark.createDataFrame([("a", START + dt.timedelta(hours=h), x) for h, x in enumerate([0.1, -1.0, 0.2, 0.0])],
                              "symbol string, bar_ts timestamp_ntz, r double")
    vals = RK.price_path(r, "r")
    assert {x.tau: x.dd for x in RK.drawdown_at(vals, [0, 1]).collect()}[1] == pytest.approx(1.0)
    assert RK.max_drawdown(vals).first().max_dd == pytest.approx(1.0)
    one = spark.createDataFrame([(100.0, 0.0), (100.0, 4.0)], "b double, p double")
    assert [x[0] for x in one.select(PN.order_size(F.col("b"), F.col("p"), StrategyConfig())).collect()] == [None, 25.0]


def test_average_drawdown_by_episodes(spark):
    values = [0.1, 0.0, 0.05, 0.2, 0.1, 0.3, 0.29, 0.0]
    r = spark.createDataFrame([("a", START + dt.timedelta(hours=h), x) for h, x in enumerate(values)], "symbol string, bar_ts timestamp_ntz, r double")
    got = RK.average_drawdown(RK.price_path(r, "r"), 2).first()
    deepest = sorted([1 - 100 / 110, 1 - 110 / 120, 1 - 100 / 130])[-2:]
    assert got.avg_dd == pytest.approx(sum(deepest) / 2) and got.avg_dd_sq == pytest.approx(sum(x * x for x in deepest) / 2)


def test_odd_names(spark):
    rows = [(START + dt.timedelta(days=d), float(d), float(d * d % 7), float(-d)) for d in range(20)]
    wide = spark.createDataFrame(rows, ["bar_ts", "BRK.B", "it's", "a`b"])
    names = ["BRK.B", "it's", "a`b"]
    cov = AG.monthly_covariance(wide, names)
    assert cov.count() == 9 and cov.where("asset_i = 'BRK.B' and asset_j = 'a`b'").first()["cov"] == pytest.approx(-35.0)
    long = wide.select("bar_ts", F.explode(F.array(*[F.struct(F.lit(n).alias("symbol"), F.col("`" + n.replace("`", "``") + "`").alias("close")) for n in names])).alias("x")).select("bar_ts", "x.*")
    assert JN.align_assets(long, names).count() == 20
    corr = AG.correlation_matrix(wide.withColumn("symbol", F.lit("s")), names)
    assert corr.where("feature_a = feature_b").select(F.min("corr")).first()[0] == pytest.approx(1.0)


def test_many_assets(spark):
    """200 assets, every output column read: figures against NumPy."""
    import numpy as np
    n, days = 200, 40
    r = np.random.default_rng(3).normal(0, 0.02, (days, n))
    bars_ = [(START + dt.timedelta(days=d), [float(x) for x in r[d]]) for d in range(days)]
    daily = spark.createDataFrame(bars_, "bar_ts timestamp_ntz, r array<double>")
    cov = AG.packed_covariance(daily, n)
    months = sorted({b[0].strftime("%Y-%m") for b in bars_})
    monthly = spark.createDataFrame([(m, [0.001 * i for i in range(n)]) for m in months], "month string, r array<double>")
    rows = PF.random_portfolios(monthly, cov, n, 300).collect()
    assert len(rows) == 300 * len(months)
    roots = np.sqrt(PF.weight_roots(n))
    for x in rows[:40] + rows[-40:]:
        f = (x.portfolio + 1) * roots
        w = (f - np.floor(f)) / (f - np.floor(f)).sum()
        c = np.cov(np.array([v for t, v in bars_ if t.strftime("%Y-%m") == x.month]).T)
        np.testing.assert_allclose(x.weights, w, rtol=1e-9)
        assert x.vol == pytest.approx(float(np.sqrt(w @ c @ w)), rel=1e-8) and x.ret == pytest.approx(float(w @ (0.001 * np.arange(n))))
    best = {b.month: b for b in PF.best_sharpe(spark.createDataFrame(rows)).collect()}
    for m in months:
        assert best[m].sharpe == pytest.approx(max(x.ret / x.vol for x in rows if x.month == m))
    assert PF.weight_roots(10) == [2, 3, 5, 7, 11, 13, 17, 19, 23, 29]


def test_covariance_of_gappy_series(spark):
    """Pairs use the bars both have; fewer than two give NULL; asset blocks of any size agree."""
    rows = [(START + dt.timedelta(days=d), [float(d * d % 5), None if d % 3 == 0 else float(d % 4), 1.0 if d == 0 else None, float(d)]) for d in range(12)]
    df = spark.createDataFrame(rows, "bar_ts timestamp_ntz, r array<double>")
    got = [AG.packed_covariance(df, 4, block=b).first().tri for b in (32, 3, 1)]
    assert got[0] == got[1] == got[2]
    wide = df.select("bar_ts", *[F.get("r", F.lit(i)).alias(f"c{i}") for i in range(4)])
    want = wide.agg(*[F.covar_samp(f"c{i}", f"c{j}") for i in range(4) for j in range(i + 1)]).first()
    assert [x for row in got[0] for x in row] == [None if w is None else pytest.approx(w) for w in want]


def test_calendar_joins_every_intraday_bar_once(bars):
    j = JN.join_calendar(bars, FE.calendar_days(bars))
    assert j.count() == bars.count() and j.select("bar_ts", "deg").distinct().count() == 60


def test_bracket_exit_follows_bar_times_over_a_gap(spark, bars):
    """A zero close inside the series drops signal rows, but exits still look up the bars themselves."""
    gap = bars.filter("symbol = 'move'").withColumn("close", F.when(F.hour("bar_ts") == 5, 0.0).otherwise(F.col("close")))
    indexed = FE.ensure_indexed(gap)
    entry = START + dt.timedelta(hours=30)
    entries = spark.createDataFrame([("move", entry, 1e9, -1e9)], "symbol string, entry_ts timestamp_ntz, upper double, lower double")
    got = JN.bracket_exit(entries, indexed, 4).first()
    want = gap.filter(F.col("bar_ts") == F.lit(START + dt.timedelta(hours=34)).cast("timestamp_ntz")).first().close
    assert (got.entry_rn, got.bars_held, got.exit_price) == (30, 4, want)


def test_missing_feature_has_no_state(bars):
    d = bars.withColumn("x", F.when(F.hour("bar_ts") > 0, F.col("close"))).filter("symbol = 'move'")
    got = SG.state_id(d, ["x", "close"], 3)
    assert got.where("x is null and state is not null").count() == 0 and got.where("x is not null and state is null").count() == 0


def test_open_bracket_searches_the_whole_series(spark, monkeypatch):
    """Exits far away, none at all, open sides, the last bar and a missing price, in a tree of several levels."""
    monkeypatch.setattr(JN, "FAN_BITS", 2)
    r = random.Random(5)
    price = {s: [None if r.random() < 0.05 else 100.0 + r.randrange(-40, 41) for _ in range(n)] for s, n in (("a", 300), ("b", 1), ("c", 65))}
    rows = [(s, START + dt.timedelta(hours=i), p) for s, ps in price.items() for i, p in enumerate(ps)]
    bars = spark.createDataFrame(rows, "symbol string, bar_ts timestamp_ntz, close double")
    entries = [(s, START + dt.timedelta(hours=i), r.choice([None, 120.0, 139.0, 140.0, 200.0]), r.choice([None, 80.0, 61.0, 60.0, 0.0]))
               for s, ps in price.items() for i in range(len(ps))]
    got = JN.bracket_exit(spark.createDataFrame(entries + entries[:3], "symbol string, entry_ts timestamp_ntz, upper double, lower double"), bars).collect()
    assert len(got) == len(entries)
    want = {}
    for s, ts, up, low in entries:
        at, ps = int((ts - START).total_seconds()) // 3600, price[s]
        hit = [i for i in range(at + 1, len(ps)) if ps[i] is not None and ((up is not None and ps[i] > up) or (low is not None and ps[i] < low))]
        out = hit[0] if hit else len(ps) - 1
        want[s, at] = (out - at, ps[out])
    assert {(x.symbol, x.entry_rn): (x.bars_held, x.exit_price) for x in got} == want


def test_open_bracket_equals_a_long_timeout(bars):
    entries = bars.filter(F.hour("bar_ts") % 7 == 1).select("symbol", F.col("bar_ts").alias("entry_ts"), (F.col("close") + 9).alias("upper"), (F.col("close") - 9).alias("lower"))
    rows = [sorted(map(tuple, JN.bracket_exit(entries, bars, t).collect())) for t in (None, 100)]
    assert rows[0] == rows[1] and len(rows[0]) > 10


def test_regression_terms_and_forest_grid(spark):
    r = random.Random(3)
    rows = []
    for i in range(400):
        x, z = r.gauss(0, 1), r.gauss(0, 1)
        rows.append((x, z, 2.0 + 3.0 * x + r.gauss(0, 0.5), i < 300))
    d = spark.createDataFrame(rows, "x double, z double, y double, is_train boolean")
    terms = {t.term: t for t in ML.linear_terms(d, ["x", "z"], "y").collect()}
    assert terms["x"].value == pytest.approx(3.0, abs=0.1) and terms["x"].p_value < 1e-9
    assert terms["z"].p_value > 0.001 and terms["z"].t_value == pytest.approx(terms["z"].value / terms["z"].std_error)
    fit = {f.is_train: f for f in ML.regression_fit(ML.linear_predict(d, ["x", "z"], "y"), "y").collect()}
    assert fit[True].n == 300 and fit[False].rmse == pytest.approx(0.5, abs=0.1) and fit[False].r2 > 0.9
    keyed = d.withColumn("key", F.monotonically_increasing_id())
    grid = TR.tree_and_forest_grid(keyed, ["x", "z"], "y", "key", depths=(3,), trees=(3, 5), forest_depths=(2,), max_features=(1, 8)).collect()
    forests = [g for g in grid if g.model.startswith("RF_")]
    assert len(grid) == 5 and [g.model for g in grid if g.best_forest] == [max(forests, key=lambda g: g.r2_test).model]


def test_logistic_facts(spark):
    r = random.Random(4)
    rows = [(x, z, 1 if r.random() < 1 / (1 + 2.718281828 ** (-(0.5 + 2 * x))) else 0, i < 500) for i in range(700) for x, z in [(r.gauss(0, 1), r.gauss(0, 5))]]
    f = ML.logistic_facts(spark.createDataFrame(rows, "x double, z double, up int, is_train boolean"), ["x", "z"], "up").first()
    assert f.n == 500 and f.n_up == sum(u for _, _, u, t in rows if t)
    assert f.expected_up == pytest.approx(f.n_up, abs=0.01) and f.steepest < 1e-3


def test_state_counts(spark):
    t = spark.createDataFrame([("a", 1, 12, True), ("a", 2, 3, False), ("a", 3, 0, False), ("a", None, 4, True)], "symbol string, state int, visits long, confident boolean")
    assert tuple(AG.state_counts(t).first()) == ("a", 3, 2, 1)
