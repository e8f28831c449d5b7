"""Sweeps by block summaries == the bar-level P&L of every parameter set."""

import random

import pytest
from pyspark.sql import functions as F

from candela.config import PRESETS
from candela.operators import portfolio as PF
from candela.operators import sweeps as SW
from candela.operators.pnl import run_pnl

ROC = PRESETS["eth_usd_roc"]
GRID = PF.param_grid(period=[2, 5, 17], threshold=[-20.0, 0.0, 3.0], delay=[0, 1, 4])


def bars(spark, zeros=True):
    r = random.Random(6)
    rows = []
    for s, n in (("a", 230), ("b", 160), ("short", 14), ("flat", 90), ("one", 1)):
        price = 100.0
        for i in range(n):
            open_ = price
            price = 50.0 if s == "flat" else max(0.5, price * (1 + r.gauss(0, 0.04)))
            close = 0.0 if zeros and s == "a" and i in (0, 3, 4, 60, 61, 120) else price
            rows.append((s, i, 0.0 if zeros and s == "b" and i in (30, 31, 100) else open_, max(open_, price) + 1, min(open_, price) - 0.4, close, 5.0))
    df = spark.createDataFrame(rows, "symbol string, i long, open double, high double, low double, close double, volume double")
    return df.select("symbol", F.timestamp_seconds(F.col("i") * 86400).cast("timestamp_ntz").alias("bar_ts"), "open", "high", "low", "close", "volume").repartition(3)


def general(df, cfg):
    td = PF.roc_sweep_signals(df, GRID, cfg)
    return PF.sweep_results(run_pnl(td, cfg, keep_adx=False, lean=True))


def table(df):
    return {(r.symbol, r.param_id): r.CSR for r in df.collect()}


@pytest.mark.parametrize("change", [{}, {"short": True}, {"breakout": True}, {"signal_threshold": 0.0, "adx_period": 2}])
def test_equals_bar_level_pnl(small_blocks, change, monkeypatch):
    monkeypatch.setattr(SW, "FOLD_BLOCKS", 3)
    cfg = ROC.with_(**change)
    df = bars(small_blocks).persist()
    got, want = table(PF.roc_sweep(df, GRID, cfg)), table(general(df, cfg))
    assert got.keys() == want.keys() and len(got) > 60
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-9), k


def test_blocks_do_not_matter(spark):
    df = bars(spark).persist()
    whole = table(PF.roc_sweep(df, GRID, ROC))
    spark.conf.set("spark.candela.blockRows", "16")
    try:
        assert table(PF.roc_sweep(df, GRID, ROC)) == pytest.approx(whole)
    finally:
        spark.conf.unset("spark.candela.blockRows")


def test_other_configurations_take_the_general_path(spark):
    stops = ROC.with_(buy_sl=True)
    assert not SW.summarisable(stops)
    with pytest.raises(ValueError):
        SW.roc_sweep_by_blocks(bars(spark), GRID, stops)
    grid = GRID[:2]
    df = bars(spark, zeros=False).persist()
    got = table(PF.roc_sweep(df, grid, stops))
    want = table(PF.sweep_results(run_pnl(PF.roc_sweep_signals(df, grid, stops), stops, lean=True)))
    assert got == want and got


def test_basket_over_blocks(small_blocks):
    df = bars(small_blocks, zeros=False).filter("symbol in ('a', 'b')").persist()
    got = {r.param_id: r for r in PF.basket_sweep(df, GRID, ROC, 2).collect()}
    s = PF.roc_sweep_signals(df, GRID, ROC, more=["DR"]).filter(F.col("DR").isNotNull())
    g = s.groupBy("param_id", "bar_ts").agg(F.count(F.lit(1)).alias("n"), F.sum("y_pred_val").alias("b"), F.avg("DR").alias("DR"),
                                            F.sum(F.when(F.col("y_pred_val") == 1, F.col("DR"))).alias("sel")).filter("n = 2")
    want = g.groupBy("param_id").agg(F.product(F.when(F.col("b") > 0, F.col("sel") / F.col("b")).otherwise(1.0)).alias("CSR"), F.product("DR").alias("CMR"), F.count(F.lit(1)).alias("n"))
    rows = want.collect()
    assert len(rows) == len(got) == len(GRID)
    for r in rows:
        assert (got[r.param_id].CSR, got[r.param_id].CMR, got[r.param_id].n_bars) == (pytest.approx(r.CSR), pytest.approx(r.CMR), r.n)


def test_no_stored_grid(spark, monkeypatch):
    """Only the block summaries are stored on the way: rows per (symbol, block, set), not per bar and set."""
    stored = []
    real = SW.materialize
    monkeypatch.setattr(SW, "materialize", lambda df: stored.append(real(df)) or stored[-1])
    n = SW.roc_sweep_by_blocks(bars(spark), GRID, ROC).count()
    assert len(stored) == 1 and stored[0].count() == n


def test_adx_sweep_equals_each_period(small_blocks):
    cfg = ROC.with_(adjust_signal=True, adx_lo_threshold=20.0, adx_hi_threshold=60.0, asr_threshold=0.99)
    df = bars(small_blocks, zeros=False).persist()
    got = table(PF.adx_sweep(df, [2, 6], cfg))
    from candela.operators.signals import roc_signal
    for i, n in enumerate([2, 6]):
        pnl = run_pnl(roc_signal(df, cfg), cfg.with_(adx_period=n))
        for r in pnl.groupBy("symbol").agg(F.max_by("CSR", "rn").alias("CSR")).collect():
            assert got.pop((r.symbol, i)) == pytest.approx(r.CSR, rel=1e-9)
    assert not got
    with pytest.raises(ValueError):
        PF.adx_sweep(df, [2], ROC)
