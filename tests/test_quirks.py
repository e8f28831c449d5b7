"""Hand-made frames for the quirk register and edge cases (NULLs, zero division, single rows)."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from candela.config import StrategyConfig
from candela.operators import features as FE
from candela.operators import joins as JN
from candela.operators import pnl as PN
from candela.operators import risk as RK
from candela.operators.aggregates import gen_trades, strategy_summary

T0 = dt.datetime(2024, 1, 1)


def bars(spark, rows, symbol="X"):
    """rows: (open, high, low, close[, signal])."""
    data = []
    for i, r in enumerate(rows):
        o, h, lo, c = r[:4]
        sig = r[4] if len(r) > 4 else "Buy"
        data.append((symbol, T0 + dt.timedelta(days=i), float(o), float(h), float(lo), float(c), 1.0, sig))
    return spark.createDataFrame(data, "symbol string, bar_ts timestamp_ntz, open double, high double, low double, "
                                       "close double, volume double, signal string")


def test_first_bar_is_new_trade_and_stop_wins(spark):
    cfg = StrategyConfig(adx_period=2, adjust_signal=False, buy_sl=True, buy_tp=True, take_profit=0.05, stop_sma_period=2)
    rows = [(9, 9, 9, 9)] * 6 + [(10, 10.6, 8.5, 10.2), (10, 10.6, 9.9, 10.1), (10, 11, 9.5, 10.8, "Sell"), (10, 11, 9, 10, "Sell")]
    out = PN.run_pnl(bars(spark, rows), cfg, checkpoint=False).orderBy("bar_ts").toPandas()
    assert bool(out.new_trade.iloc[0])                       # Q8: first bar opens a trade
    both = out[(out.sl) & (out.tp)]
    assert len(both) >= 1
    r = both.iloc[0]
    assert r.close_price == pytest.approx(r.sl_price)        # Q22: stop wins over take-profit
    nxt = out[out.bar_ts > r.bar_ts].iloc[0]
    assert bool(nxt.new_trade)                               # a stop closes the trade; next bar re-opens


def test_stop_price_forward_filled_after_flags(spark):
    cfg = StrategyConfig(adx_period=2, adjust_signal=False, buy_sl=True, stop_sma_period=3)
    rows = [(10, 11, 9, 10, "Sell")] * 5 + [(10, 11, 9, 10, "Buy")] * 3
    out = PN.run_pnl(bars(spark, rows), cfg, checkpoint=False).orderBy("bar_ts").toPandas()
    assert np.isnan(out.sl_price.iloc[0])                    # no previous R2 on the first bar
    buy = out[out.signal == "Buy"].iloc[0]
    prev = out[out.bar_ts < buy.bar_ts].iloc[-1]
    assert buy.sl_price == pytest.approx(prev.sl_price)      # Q7: the SMA warm-up gap takes the previous value
    assert out.sl_price.iloc[1:].notna().all()


def test_cvar_null_when_alpha_n_is_zero(spark):
    r = [0.01, -0.02, 0.03, -0.05, 0.02, 0.0, -0.01, 0.04, -0.03, 0.05]
    df = spark.createDataFrame([("X", float(x)) for x in r], "symbol string, r double")
    small = RK.var_cvar(df, "r", 0.05).collect()[0]          # int(0.05*10) = 0
    assert small.var == pytest.approx(abs(sorted(r)[0]))
    assert small.cvar is None                                # Q12
    big = RK.var_cvar(df, "r", 0.3).collect()[0]            # int(3) -> sorted[3], mean of 3 worst
    s = sorted(r)
    assert big.var == pytest.approx(abs(s[3]))
    assert big.cvar == pytest.approx(abs(sum(s[:3]) / 3))


def test_var_exact_with_heavy_ties(spark):
    spark.conf.set("spark.candela.rankSplits", "4")
    vals = [0.0] * 500 + [float(i) / 100 for i in range(-50, 50)]
    df = spark.createDataFrame([("X", v) for v in vals], "symbol string, r double")
    got = RK.var_cvar(df, "r", 0.1).collect()[0]
    s = np.sort(np.array(vals))
    k = int(0.1 * len(s))
    assert got.var == pytest.approx(abs(s[k]))
    assert got.cvar == pytest.approx(abs(s[:k].mean()))
    spark.conf.unset("spark.candela.rankSplits")


def test_price_path_not_compounded(spark):
    df = spark.createDataFrame([("X", T0 + dt.timedelta(days=i), r) for i, r in enumerate([0.1, 0.1])],
                               "symbol string, bar_ts timestamp_ntz, r double")
    v = [x.value for x in RK.price_path(df, "r").orderBy("bar_ts").collect()]
    assert v == pytest.approx([110.0, 110.0])                 # Q9
    vc = [x.value for x in RK.price_path(df, "r", compound=True).orderBy("bar_ts").collect()]
    assert vc == pytest.approx([110.0, 121.0])


def test_weekend_filter_and_compat(spark):
    days = [T0 + dt.timedelta(days=i) for i in range(7)]    # 2024-01-01 is a Monday
    df = spark.createDataFrame([("X", d, 1.0) for d in days], "symbol string, bar_ts timestamp_ntz, close double")
    assert FE.remove_weekends(df).count() == 5
    assert FE.remove_weekends(df, compat=True).count() == 6  # Q13: only Saturday dropped


def test_ledger_ignores_first_bar_signal(spark):
    df = spark.createDataFrame([("X", T0 + dt.timedelta(days=i), 10.0, s) for i, s in enumerate([100.0, 100.0, 0.0])],
                               "symbol string, bar_ts timestamp_ntz, close double, target double")
    out = PN.position_ledger(df, "target", "close").orderBy("bar_ts").toPandas()
    assert list(out.shares) == [0.0, 0.0, 0.0]              # Q15: no trade on the first bar, then no change


def test_bracket_exit_strict_and_timeout(spark):
    px = [10, 11, 12, 12.5, 9, 10]
    b = spark.createDataFrame([("X", T0 + dt.timedelta(days=i), float(p)) for i, p in enumerate(px)],
                              "symbol string, bar_ts timestamp_ntz, close double")
    e = spark.createDataFrame([("X", 0, 12.0, 9.5), ("X", 0, 20.0, 5.0)], "symbol string, entry_rn long, upper double, lower double")
    got = {(r.bars_held, r.exit_price) for r in JN.bracket_exit(e, b, 4).collect()}
    assert (3, 12.5) in got                                  # Q16: 12 is not above 12 (strict); bar price
    assert (4, 9.0) in got                                   # time-out after 4 bars


def test_win_when_cash_and_market_fell_and_r2r_null(spark):
    cfg = StrategyConfig(adx_period=2, adjust_signal=False)
    rows = [(10, 10, 10, 10, "Sell")] * 4 + [(10, 10, 9, 9, "Sell"), (9, 9, 8, 8, "Sell")]
    pnl = PN.run_pnl(bars(spark, rows), cfg, checkpoint=False)
    tr = gen_trades(pnl).toPandas()
    assert tr.win.all()                                      # Q29: SR == 1 and market fell
    summ = strategy_summary(pnl, gen_trades(pnl)).collect()[0]
    assert summ.risk_to_reward is None                       # Q30: no losing trade


def test_single_bar_symbol_and_zero_price(spark):
    df = bars(spark, [(0, 0, 0, 0), (1, 1, 1, 1)], "Z").unionByName(bars(spark, [(5, 5, 5, 5)], "ONE"))
    out = FE.gross_return(df).orderBy("symbol", "bar_ts").toPandas()
    assert out.DR.isna().sum() == 3                         # first bars and the zero divisor give NULL


def test_kth_smallest_over_many_levels(spark):
    """One key holds most rows; at most four distinct values of a key are ordered in the end."""
    rng = np.random.default_rng(6)
    vals = np.concatenate([np.round(rng.normal(size=4000), 3), np.full(500, 0.125)])
    ks = [1, 2, 57, 1500, 2249, 2300, len(vals)]
    rows = [(k, float(v)) for k in ks for v in vals] + [(-1, 1.0), (-2, 5.0), (-2, 5.0)]
    df = spark.createDataFrame(rows, "symbol long, r double")
    kt = spark.createDataFrame([(k, k) for k in ks] + [(-1, 1), (-2, 2), (-3, 1)], "symbol long, k long")
    spark.conf.set("spark.candela.rankSplits", "8")
    got = {r.symbol: (r.kth, r.sum_k) for r in RK.kth_smallest(df, "r", kt, max_ordered=4).collect()}
    spark.conf.unset("spark.candela.rankSplits")
    v = np.sort(vals)
    assert set(got) == {*ks, -1, -2} and got[-1] == (1.0, 1.0) and got[-2] == (5.0, 10.0)
    for k in ks:
        assert got[k][0] == v[k - 1] and got[k][1] == pytest.approx(v[:k].sum())


def test_kth_smallest_matches_sort(spark):
    rng = np.random.default_rng(5)
    spark.conf.set("spark.candela.rankSplits", "4")
    rows, ks = [], []
    for key, n in (("A", 3000), ("B", 57), ("C", 1)):
        vals = np.round(rng.normal(size=n), 1)               # many ties
        rows += [(key, float(v)) for v in vals]
        for k in sorted({1, n, max(1, n // 3), max(1, n // 2)}):
            ks.append((key, k, float(np.sort(vals)[k - 1]), float(np.sort(vals)[:k].sum())))
    df = spark.createDataFrame(rows, "symbol string, r double")
    for key, k, exp_v, exp_s in ks:
        kt = spark.createDataFrame([(key, k)], "symbol string, k long")
        got = RK.kth_smallest(df.filter(F.col("symbol") == key), "r", kt).collect()[0]
        assert got.kth == pytest.approx(exp_v) and got.sum_k == pytest.approx(exp_s)
    spark.conf.unset("spark.candela.rankSplits")


def test_signal_frame_renumbers_after_a_gap(spark):
    from candela.operators.signals import gen_signal
    rows = [("X", T0 + dt.timedelta(days=i), 10.0 + i, None if i == 7 else 0.8) for i in range(12)]
    df = FE.ensure_indexed(spark.createDataFrame(rows, "symbol string, bar_ts timestamp_ntz, close double, score double"))
    out = gen_signal(df, StrategyConfig(), score="score").orderBy("bar_ts").toPandas()
    assert list(out.rn) == list(range(11))                   # the mid-series drop left no gap in rn


def test_leading_ignored_signals_leave_the_pnl_frame(spark):
    from candela.operators.signals import gen_signal
    cfg = StrategyConfig(adx_period=2, adjust_signal=False, signal_scale=10, ignore_signals=(3,))
    scores = [0.35] * 6 + [0.8, 0.2, 0.35, 0.9, 0.1, 0.7]     # bucket 3 is ignored: no signal before bar 6
    rows = [("X", T0 + dt.timedelta(days=i), 10.0 + i % 3, 11.0 + i % 3, 9.0 + i % 3, 10.5 + i % 3, 1.0, s)
            for i, s in enumerate(scores)]
    df = spark.createDataFrame(rows, "symbol string, bar_ts timestamp_ntz, open double, high double, low double, "
                                     "close double, volume double, y_pred_val double")
    td = gen_signal(df, cfg)
    out = PN.run_pnl(td, cfg, checkpoint=False).orderBy("bar_ts").toPandas()
    assert out.signal.notna().all()
    assert out.bar_ts.min() == T0 + dt.timedelta(days=6)    # ADX is ready at bar 3; the first signal is at bar 6
    assert out[out.bar_ts == T0 + dt.timedelta(days=8)].signal.iloc[0] == "Sell"  # ignored bucket keeps bar 7's signal
