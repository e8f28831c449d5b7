"""Baskets, random portfolios and parameter sweeps (PRT-1..5, SWP-1..3).

Sweeps of the ROC rule summarise blocks of bars per parameter set (``sweeps``). Sweeps that need the
bar-level P&L (averaging and ADX periods, stops, risk-off) explode the parameter grid, a small,
fixed-size table, onto the bars: each (symbol, parameter set) becomes its own series key, and all
windows are the ordinary blocked windows over that composite key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.config import StrategyConfig
from candela.functions.scalar import div, full
from candela.operators.features import ensure_indexed, rolling
from candela.operators.indicators import adx_many
from candela.operators.pnl import run_pnl
from candela.operators.series import BLK, RN, running
from candela.operators.signals import gen_signal, roc_signal
from candela.operators.sweeps import basket_sweep, roc_sweep_by_blocks, summarisable  # noqa: F401  (basket_sweep is public here)

SEP = "|"


# --- PRT ----------------------------------------------------------------------------------------

def signal_basket(signals: DataFrame, n_assets: int) -> DataFrame:
    """PRT-1: per bar where all assets have a return: equal share among assets with a Buy score
    (1 when none), equal-weight benchmark DR; running products CSR/CMR over the basket."""
    s = signals.filter(F.col("DR").isNotNull())
    g = s.groupBy("bar_ts").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("y_pred_val").alias("buy_signals"),
        F.avg("DR").alias("DR"), F.sum(F.when(F.col("y_pred_val") == 1, F.col("DR"))).alias("_sel"))
    g = g.filter(F.col("_n") == n_assets)
    g = g.withColumn("SR", F.when(F.col("buy_signals") > 0, F.col("_sel") / F.col("buy_signals")).otherwise(F.lit(1.0)))
    g = ensure_indexed(g.withColumn("basket", F.lit("basket")), ["basket"])
    return running(g, [("SR", "product", "CSR"), ("DR", "product", "CMR")], ["basket"]).drop("_n", "_sel")


def weight_roots(n: int) -> list[int]:
    """The first ``n`` primes: their square roots are the multipliers of the low-discrepancy weight sequence."""
    out: list[int] = []
    k = 2
    while len(out) < n:
        if all(k % p for p in out if p * p <= k):
            out.append(k)
        k += 1
    return out


PORTFOLIO_CHUNK = 1024


def random_portfolios(monthly: DataFrame, cov: DataFrame, assets: int, n: int = 5000) -> DataFrame:
    """PRT-2: ``n`` long-only portfolios per month with weights frac((k+1)*sqrt(p_i)) normalised to 1;
    return = w . r_month, volatility = sqrt(w' C w) with C the month's covariance of bar returns.

    ``monthly``: (month, r: one return per asset); ``cov``: (month, tri) of ``aggregates.packed_covariance``. A row carries the
    packed triangle and makes ``PORTFOLIO_CHUNK`` portfolios as one quadratic form over arrays, so neither plan nor row
    count grows with the square of the assets; rows are spread over the tasks."""
    m = monthly.join(cov, "month").select("month", "r", "tri", F.explode(F.sequence(F.lit(0), F.lit((n - 1) // PORTFOLIO_CHUNK))).alias("chunk"))
    roots = np.sqrt(np.array(weight_roots(assets), float))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                k = np.arange(row["chunk"] * PORTFOLIO_CHUNK, min((row["chunk"] + 1) * PORTFOLIO_CHUNK, n))
                raw = (k[:, None] + 1.0) * roots
                raw -= np.floor(raw)
                w = raw / raw.sum(1, keepdims=True)
                c = np.full((assets, assets), np.nan)
                low = np.tril_indices(assets)
                c[low] = [np.nan if x is None else x for part in row["tri"] for x in part]
                c.T[low] = c[low]
                vol = np.sqrt(np.maximum(((w @ c) * w).sum(1), 0.0))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(k) + 1) * assets, pa.int32()), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array([row["month"]] * len(k)), pa.array(k, pa.int32()), flat, pa.array(w @ np.array(row["r"], float)),
                                                  pa.array(vol, mask=np.isnan(vol))], names=["month", "portfolio", "weights", "ret", "vol"])

    return m.repartition("month", "chunk").mapInArrow(build, "month string, portfolio int, weights array<double>, ret double, vol double")


def _total(values) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def best_sharpe(portfolios: DataFrame) -> DataFrame:
    """PRT-3: per month the portfolio with the highest return / volatility (ties: lowest id)."""
    key = F.struct(div(F.col("ret"), F.col("vol")).alias("s"), (-F.col("portfolio")).alias("p"))
    best = portfolios.groupBy("month").agg(F.max_by(F.struct("portfolio", "weights", "ret", "vol"), key).alias("b"))
    return best.select("month", "b.*").withColumn("sharpe", div(F.col("ret"), F.col("vol")))


def features_targets(ewma_monthly: DataFrame, best: DataFrame) -> DataFrame:
    """PRT-4: last month's EWMA features (already shifted) joined to this month's best weights."""
    return ewma_monthly.join(best, "month")


def realised_vs_benchmark(monthly: DataFrame, weights: DataFrame, cash: float = 1000.0) -> DataFrame:
    """PRT-5: return of the predicted weights (w . r) and of equal weights, compounded from ``cash``.
    ``monthly``: (month, r), ``weights``: (month, weights)."""
    m = monthly.join(weights.select("month", "weights"), "month")
    m = m.withColumns({"realised": _total(F.zip_with("weights", "r", lambda w, r: w * r)), "bench_r": _total("r") / F.size("r"), "book": F.lit("book")})
    m = ensure_indexed(m.withColumn("_ts", F.to_timestamp("month", "yyyy-MM").cast("timestamp_ntz")), ["book"], "_ts")
    m = running(m, [(F.lit(1.0) + F.col("realised"), "product", "_g"), (F.lit(1.0) + F.col("bench_r"), "product", "_b")],
                ["book"])
    return m.select("month", "realised", F.col("bench_r"), (F.lit(cash) * F.col("_g")).alias("account"),
                    (F.lit(cash) * F.col("_b")).alias("benchmark"))


# --- SWP ----------------------------------------------------------------------------------------

def explode_params(bars: DataFrame, grid: Sequence[dict]) -> DataFrame:
    """Bars x parameter sets as composite series keys ``symbol|param_id`` (rn and blocks kept)."""
    bars = ensure_indexed(bars)
    names = sorted(grid[0])
    rows = [F.struct(F.lit(i).alias("param_id"), *[F.lit(p[k]).alias(k) for k in names]) for i, p in enumerate(grid)]
    x = bars.withColumn("_p", F.explode(F.array(*rows))).select("*", "_p.*").drop("_p")
    return x.withColumn("base_symbol", F.col("symbol")).withColumn(
        "symbol", F.concat_ws(SEP, F.col("symbol"), F.col("param_id").cast("string")))


def lag_by(df: DataFrame, src: DataFrame, value: str, offset_col: str, out: str, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """``value`` from ``offset`` rows back, where the offset differs per row: an equi-join on
    (keys, rn - offset) against ``src`` (keys, rn, value)."""
    s = src.select(*keys, F.col(RN).alias("_rn_src"), F.col(value).alias(out))
    j = df.withColumn("_rn_src", F.col(RN) - F.col(offset_col))
    return j.join(s, [*keys, "_rn_src"], "left").drop("_rn_src")


SWEEP_COLS = ["symbol", "base_symbol", "param_id", "bar_ts", RN, BLK, "open", "high", "low", "close", "signal",
              "y_pred", "y_pred_val", "y_pred_id"]


def _indexed_once(bars: DataFrame, checkpoint: bool) -> DataFrame:
    """Index the bars and, for a sweep, materialise them once: every parameter set reads them twice
    (explode and the look-back join), so recomputing the tick aggregation per branch is avoided."""
    from candela.session import cut_lineage
    b = ensure_indexed(bars).select("symbol", "bar_ts", RN, BLK, "open", "high", "low", "close")
    return cut_lineage(b) if checkpoint else b


def _pick(col_for: dict, key: str):
    """The column named for this row's value of ``key`` (the grid's values are a fixed list)."""
    out = None
    for v, c in col_for.items():
        out = F.when(F.col(key) == v, F.col(c)) if out is None else out.when(F.col(key) == v, F.col(c))
    return out


def roc_sweep_signals(bars: DataFrame, grid: Sequence[dict], cfg: StrategyConfig, checkpoint: bool = True,
                      more: Sequence[str] = ()) -> DataFrame:
    """SWP-1 signal stage: for every (symbol, period, threshold, delay): ROC(period), score
    1{ROC > threshold} delayed by delay + 1 bars, then the signal frame with the usual warm-up drop.

    Work that does not depend on the parameters runs on the bars before the grid is exploded: DR,
    and the close ``p`` bars back for each distinct period ``p`` of the grid (one column each)."""
    bars = _indexed_once(bars, checkpoint)
    periods = sorted({int(p["period"]) for p in grid})
    lags = {p: f"_c{p}" for p in periods}
    cols = {"DR": lambda w: div(F.col("close"), F.lag("close").over(w))}
    cols.update({c: (lambda p: lambda w: F.lag("close", p).over(w))(p) for p, c in lags.items()})
    bars = rolling(bars, cols, back=max(periods))
    x = explode_params(bars, grid).withColumn("_prev", _pick(lags, "period")).drop(*lags.values())
    x = x.withColumn("ROC", F.when(F.col("_prev").isNull(), F.lit(None).cast("double")).when(F.col("_prev") == 0, F.lit(0.0))
                     .otherwise(F.lit(100.0) * (F.col("close") / F.col("_prev") - 1)))
    x = x.withColumn("_raw", F.when(F.col("ROC") > F.col("threshold"), F.lit(1.0)).otherwise(F.lit(0.0)))
    # the score delay + 1 bars back: one lag column per distinct delay of the grid, one halo stage
    delays = sorted({int(p["delay"]) for p in grid})
    dl = {d: f"_s{d}" for d in delays}
    x = rolling(x, {c: (lambda d: lambda w: F.lag("_raw", d + 1).over(w))(d) for d, c in dl.items()}, back=max(delays) + 1)
    x = x.withColumn("y_pred_val", _pick(dl, "delay")).drop(*dl.values())
    return gen_signal(x.drop("_prev", "_raw"), cfg, required=["DR", "ROC"]).select(*SWEEP_COLS, *more)


def sweep_results(pnl: DataFrame) -> DataFrame:
    """Objective per (symbol, parameter set): final CSR (and its negative as the loss to minimise)."""
    r = pnl.groupBy("symbol").agg(F.max_by("CSR", RN).alias("CSR"), F.first("base_symbol").alias("base_symbol"),
                                  F.first("param_id").alias("param_id"))
    return r.select(F.col("base_symbol").alias("symbol"), "param_id", "CSR", (-F.col("CSR")).alias("loss"))


def roc_sweep(bars: DataFrame, grid: Sequence[dict], cfg: StrategyConfig, checkpoint: bool = True) -> DataFrame:
    """SWP-1/SWP-3: the ROC rule over a parameter grid; one row per (symbol, parameter set). Block summaries where the
    configuration allows them (``sweeps.summarisable``), else the bar-level P&L of every set."""
    if summarisable(cfg):
        return roc_sweep_by_blocks(bars, grid, cfg)
    td = roc_sweep_signals(bars, grid, cfg, checkpoint)
    return sweep_results(run_pnl(td, cfg, keep_adx=False, lean=True))


def adx_sweep(bars: DataFrame, periods: Sequence[int], cfg: StrategyConfig) -> DataFrame:
    """SWP-2 over ``adx_period``: the ROC rule's signals with the risk-off band applied to ADX of each period (``cfg`` must
    adjust signals). All periods' ADX come from one pass that carries a state per period."""
    if not cfg.adjust_signal:
        raise ValueError("adx_period acts through the risk-off adjustment")
    outs = {int(n): f"_adx{int(n)}" for n in periods}
    td = roc_signal(_indexed_once(bars, False), cfg).select("symbol", "bar_ts", RN, BLK, "open", "high", "low", "close", "signal", "y_pred", "y_pred_val", "y_pred_id")
    td = adx_many(td, outs)
    x = explode_params(td, [{"adx_period": n} for n in outs]).withColumn("ADX", _pick(outs, "adx_period")).drop(*outs.values())
    return sweep_results(run_pnl(x, cfg, lean=True))


def adr_sweep(bars: DataFrame, periods: Sequence[int], cfg: StrategyConfig) -> DataFrame:
    """SWP-2: averaging-period sweep. ADR(n) = mean of DR over the last n bars, one windowed mean per
    period on the bars (a difference of running sums would lose digits as the history grows); signal =
    1{ADR > 1} acting on the next bar."""
    bars = rolling(_indexed_once(bars, True), {"DR": lambda w: div(F.col("close"), F.lag("close").over(w))}, back=1)
    means = {int(p): f"_adr{int(p)}" for p in periods}
    bars = rolling(bars, {c: (lambda p: lambda w: full(F.avg, "DR", w, p))(p) for p, c in means.items()}, back=max(means))
    x = explode_params(bars, [{"period": int(p)} for p in periods])
    x = x.withColumn("ADR", _pick(means, "period")).drop(*means.values())
    x = rolling(x, {"y_pred_val": lambda w: F.lag(F.when(F.col("ADR") > 1, F.lit(1.0)).otherwise(F.lit(0.0)), 1).over(w)},
                back=1)
    td = gen_signal(x, cfg, required=["DR", "ADR"]).select(*SWEEP_COLS)
    return sweep_results(run_pnl(td, cfg, keep_adx=False, lean=True))


def adr_roc_sweep(bars: DataFrame, grid: Sequence[dict], cfg: StrategyConfig, threshold: float = 0.0) -> DataFrame:
    """SWP-2 over two axes (``adr_period``, ``roc_period``): signal = 1{ADR(n) > 1 and ROC(m) > ``threshold``}
    acting on the next bar. Means and look-backs are made once per distinct period on the bars, before the grid."""
    bars = rolling(_indexed_once(bars, True), {"DR": lambda w: div(F.col("close"), F.lag("close").over(w))}, back=1)
    means = {n: f"_adr{n}" for n in sorted({int(p["adr_period"]) for p in grid})}
    lags = {n: f"_c{n}" for n in sorted({int(p["roc_period"]) for p in grid})}
    cols = {c: (lambda n: lambda w: full(F.avg, "DR", w, n))(n) for n, c in means.items()}
    cols.update({c: (lambda n: lambda w: F.lag("close", n).over(w))(n) for n, c in lags.items()})
    bars = rolling(bars, cols, back=max(*means, *lags))
    x = explode_params(bars, [{k: int(p[k]) for k in ("adr_period", "roc_period")} for p in grid])
    x = x.withColumn("ADR", _pick(means, "adr_period")).withColumn("_prev", _pick(lags, "roc_period")).drop(*means.values(), *lags.values())
    x = x.withColumn("ROC", F.when(F.col("_prev").isNull(), F.lit(None).cast("double")).when(F.col("_prev") == 0, F.lit(0.0))
                     .otherwise(F.lit(100.0) * (F.col("close") / F.col("_prev") - 1)))
    raw = F.when((F.col("ADR") > 1) & (F.col("ROC") > threshold), F.lit(1.0)).otherwise(F.lit(0.0))
    x = rolling(x, {"y_pred_val": lambda w: F.lag(raw, 1).over(w)}, back=1)
    td = gen_signal(x, cfg, required=["DR", "ADR", "ROC"]).select(*SWEEP_COLS)
    return sweep_results(run_pnl(td, cfg, keep_adx=False, lean=True))


def param_grid(**axes: Sequence) -> list[dict]:
    """Cartesian grid of parameter values (the grid size is fixed by the caller)."""
    keys = list(axes)
    out: list[dict] = [{}]
    for k in keys:
        out = [{**o, k: v} for o in out for v in axes[k]]
    return out


def aligned_monthly(bars: DataFrame, assets: Sequence[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Inputs of the MPT study: (bar returns: bar_ts, r; monthly returns: month, r; covariance: month, tri), the returns
    being arrays in the order of ``assets``.

    Bar times where every asset has a bar are kept; returns are changes between consecutive kept
    bars; monthly prices are the first kept close of each business-month bin; monthly returns are
    their changes (first month dropped); covariance is per calendar month of the bar returns."""
    from candela.operators.aggregates import packed_covariance
    from candela.operators.joins import aligned_vectors
    from candela.operators.timeseries import month_bins_first

    def change(w):
        return F.zip_with("c", F.lag("c").over(w), lambda now, then: div(now, then) - 1)

    whole = F.col("r").isNotNull() & ~F.exists("r", lambda x: x.isNull())
    book = ensure_indexed(aligned_vectors(bars, assets).withColumn("book", F.lit("book")), ["book"])
    daily = rolling(book, {"r": change}, back=1, keys=["book"]).filter(whole).select("bar_ts", "r")
    prices = month_bins_first(book.select("book", "bar_ts", "c"), "c", ["book"])
    prices = ensure_indexed(prices.withColumn("_ts", F.col("month_start").cast("timestamp")), ["book"], "_ts")
    monthly = rolling(prices, {"r": change}, back=1, keys=["book"]).filter(whole).select(F.date_format("month_start", "yyyy-MM").alias("month"), "r")
    return daily, monthly, packed_covariance(daily, len(assets))


def asset_names(bars: DataFrame) -> list[str]:
    """The symbols of the bars, sorted: the assets of a portfolio are a list the caller holds."""
    return sorted(r.symbol for r in bars.select("symbol").distinct().collect())
