"""Blocked series layout == sequential definitions, on data split into many 16-row blocks."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from candela.operators import features as FE
from candela.operators import indicators as IN
from candela.operators import series as S
from candela.sources.fixtures import bars_hourly
from tests.conftest import SF001


def _hourly(spark):
    return bars_hourly(spark, SF001)


def test_index_is_dense_and_ordered(small_blocks):
    df = S.index_series(_hourly(small_blocks)).toPandas()
    for _, g in df.groupby("symbol"):
        g = g.sort_values("bar_ts")
        assert list(g.rn) == list(range(len(g)))
        assert (g._blk == g.rn // 16).all()


def test_halo_windows_match_unblocked(small_blocks):
    b = _hourly(small_blocks)
    got = FE.base_features(b).select("symbol", "bar_ts", "MA", "WR", "DMA", "STD").toPandas()
    small_blocks.conf.set("spark.candela.blockRows", str(1 << 20))
    ref = FE.base_features(b).select("symbol", "bar_ts", "MA", "WR", "DMA", "STD").toPandas()
    m = got.merge(ref, on=["symbol", "bar_ts"], suffixes=("", "_r"))
    assert len(m) == len(got) == len(ref)
    for c in ("MA", "WR", "DMA", "STD"):
        np.testing.assert_allclose(m[c].astype(float), m[c + "_r"].astype(float), rtol=1e-12, equal_nan=True)


def _sequential(g):
    c = g.close.to_numpy()
    out = {"cum": np.cumsum(c), "prod": np.cumprod(1.0 + c / 1e4), "max": np.maximum.accumulate(c)}
    return pd.DataFrame(out, index=g.index)


def test_running_ops_match_sequential(small_blocks):
    b = S.index_series(_hourly(small_blocks)).withColumn("_m", F.lit(1.0) + F.col("close") / 1e4)
    got = S.running(b, [("close", "sum", "cum"), ("_m", "product", "prod"), ("close", "max", "max")]).toPandas()
    got = got.sort_values(["symbol", "bar_ts"]).reset_index(drop=True)
    ref = got.groupby("symbol", group_keys=False).apply(_sequential)
    for c in ("cum", "prod", "max"):
        np.testing.assert_allclose(got[c], ref[c], rtol=1e-9)


def test_forward_fill_across_blocks(small_blocks):
    b = _hourly(small_blocks).withColumn("g", F.when(F.hour("bar_ts") % 7 == 0, F.col("close")))
    got = IN.ffill(b, ["g"]).toPandas().sort_values(["symbol", "bar_ts"])
    raw = b.toPandas().sort_values(["symbol", "bar_ts"])
    exp = raw.groupby("symbol")["g"].ffill()
    np.testing.assert_allclose(got["g"].to_numpy(dtype=float), exp.to_numpy(dtype=float), equal_nan=True)


def test_affine_scan_matches_loop(small_blocks):
    b = S.index_series(_hourly(small_blocks))
    got = S.affine_scan(b, [("close", 0.9, "y")]).toPandas().sort_values(["symbol", "bar_ts"])
    for _, g in got.groupby("symbol"):
        y, ref = 0.0, []
        for v in g.close:
            y = 0.9 * y + v
            ref.append(y)
        np.testing.assert_allclose(g.y.to_numpy(), np.array(ref), rtol=1e-12)


def _map_loop(g, a):
    y, out = 0.0, []
    for v, go in zip(g.c, g.go):
        y = (a if go else 1.0) * y + v
        out.append(y)
    return out


def test_affine_maps_match_loop_over_flat_stretches(small_blocks, monkeypatch):
    rows = [(s, i, float(i % 5) if go else 0.0, go) for s, flat in (("a", 0), ("b", 400), ("c", 900))
            for i in range(900) for go in [i % 3 > 0 and not 100 <= i < 100 + flat]]
    df = small_blocks.createDataFrame(rows, "symbol string, rn long, c double, go boolean").withColumn(S.BLK, F.floor(F.col("rn") / 16).cast("long"))
    for fold in (4096, 7):  # one level of folds, and several
        monkeypatch.setattr(S, "FOLD", fold)
        got = S.affine_map_scan(df, [("c", 0.9, "go", "y9"), ("c", 0.5, "go", "y5")]).toPandas().sort_values(["symbol", "rn"])
        for _, g in got.groupby("symbol"):
            np.testing.assert_allclose(g.y9, _map_loop(g, 0.9), rtol=1e-12)
            np.testing.assert_allclose(g.y5, _map_loop(g, 0.5), rtol=1e-12)


def test_flat_symbol_is_split_by_block(spark):
    """ADX of a halted symbol: no window or fold gets more than a block of its rows."""
    n = 300_000
    b = spark.range(n).select(F.lit("flat").alias("symbol"), F.col("id").alias("rn"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("bar_ts"),
                              *[F.when(F.col("id") < 100, F.col("id") % 7 + d).otherwise(F.lit(5.0)).cast("double").alias(c) for c, d in (("high", 2), ("low", 0), ("close", 1))])
    b = b.withColumn(S.BLK, F.floor(F.col("rn") / S.block_rows(b)).cast("long"))
    out = IN.adx(b, 6)
    last = out.filter("rn >= 100").agg(F.min("ADX"), F.max("ADX"), F.count("ADX")).first()
    assert last[2] == n - 100 and last[0] is not None
    tail = out.filter("rn > 50000").agg(F.min("ADX"), F.max("ADX")).first()
    assert tail[0] == tail[1]  # kept from the last bar with a defined DX


def test_adx_of_several_periods_equals_each(small_blocks):
    b = S.index_series(_hourly(small_blocks))
    many = IN.adx_many(b, {2: "a2", 6: "a6", 9: "a9"}).toPandas().sort_values(["symbol", "bar_ts"])
    for n in (2, 6, 9):
        one = IN.adx(b, n).toPandas().sort_values(["symbol", "bar_ts"])
        np.testing.assert_allclose(many[f"a{n}"].astype(float), one.ADX.astype(float), rtol=1e-11, equal_nan=True)
    assert set(many.columns) == {"symbol", "bar_ts", "open", "high", "low", "close", "volume", "rn", "_blk", "a2", "a6", "a9"}


def test_compaction_is_dense_in_order_and_lazy(small_blocks):
    b = S.index_series(_hourly(small_blocks)).withColumn("x", F.when((F.col("rn") >= 5) & ~F.col("rn").between(40, 90) & (F.col("rn") % 7 != 0), F.col("close")))
    tracker, sc = small_blocks.sparkContext.statusTracker(), small_blocks.sparkContext
    sc.setJobGroup("compact", "none may run")
    out = S.dropna_dense(b, ["x"])
    assert tracker.getJobIdsForGroup("compact") == []
    sc.setJobGroup("other", "")
    got = out.toPandas().sort_values(["symbol", "bar_ts"])
    raw = b.toPandas().sort_values(["symbol", "bar_ts"]).dropna(subset=["x"])
    assert list(got.bar_ts) == list(raw.bar_ts)
    for _, g in got.groupby("symbol"):
        assert list(g.rn) == list(range(len(g))) and (g._blk == g.rn // 16).all()


def test_no_job_while_a_signal_is_composed(small_blocks):
    from candela.config import PRESETS
    from candela.operators.signals import roc_signal
    b = S.index_series(_hourly(small_blocks))
    sc = small_blocks.sparkContext
    sc.setJobGroup("signal", "none may run")
    td = roc_signal(b, PRESETS["eth_usd_roc"])
    assert sc.statusTracker().getJobIdsForGroup("signal") == []
    sc.setJobGroup("other", "")
    assert td.agg(F.min("rn")).first()[0] == 0


def test_wilder_rsi_matches_loop(small_blocks):
    got = IN.rsi(_hourly(small_blocks), 14).toPandas().sort_values(["symbol", "bar_ts"])
    for _, g in got.groupby("symbol"):
        c = g.close.to_numpy()
        d = np.diff(c)
        gain, loss = np.maximum(d, 0), np.maximum(-d, 0)
        G, L = gain[:14].mean(), loss[:14].mean()
        ref = [np.nan] * 14 + [100 * G / (G + L)]
        for t in range(15, len(c)):
            G = (G * 13 + gain[t - 1]) / 14
            L = (L * 13 + loss[t - 1]) / 14
            ref.append(100 * G / (G + L) if G + L else 0.0)
        np.testing.assert_allclose(g.RSI.to_numpy(dtype=float), np.array(ref), rtol=1e-10, equal_nan=True)


def test_results_invariant_to_shuffle_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    a = sorted(map(tuple, IN.atr(_hourly(spark), 14).select("symbol", "bar_ts", F.round("ATR", 9)).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    b = sorted(map(tuple, IN.atr(_hourly(spark), 14).select("symbol", "bar_ts", F.round("ATR", 9)).collect()))
    assert a == b


def test_pnl_pipeline_same_with_tiny_blocks(spark):
    from candela.config import PRESETS
    from candela.plans.strategies import roc_backtest
    from candela.sources.fixtures import bars_daily
    cfg = PRESETS["eth_usd_roc"].with_(adjust_signal=True, adx_lo_threshold=15.0, asr_threshold=0.999, buy_sl=True)
    cols = ["symbol", "bar_ts", "signal", "new_trade", "trade_id", "ADX", "SR", "CSR", "CMR", "sl_price"]

    def run():
        df = roc_backtest(bars_daily(spark, SF001), cfg).select(*cols).toPandas()
        return df.sort_values(["symbol", "bar_ts"]).reset_index(drop=True)

    ref = run()
    spark.conf.set("spark.candela.blockRows", "64")
    try:
        got = run()
    finally:
        spark.conf.unset("spark.candela.blockRows")
    assert len(got) == len(ref) and (got.signal == ref.signal).all() and (got.trade_id == ref.trade_id).all()
    for c in ("ADX", "SR", "CSR", "CMR", "sl_price"):
        np.testing.assert_allclose(got[c].astype(float), ref[c].astype(float), rtol=1e-9, equal_nan=True)
