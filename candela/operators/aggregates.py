"""Aggregations over P&L frames, trades, returns and predictions (AGG-1..25).

All are hash aggregates (partial aggregation before the exchange, so a hot symbol or trade costs one
partial row per task); running totals over their (small) outputs use the block scans.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.functions.scalar import col, div, lag, named
from candela.operators.features import ensure_indexed, rolling, whole_series
from candela.operators.series import RN, index_series, running

def _prod1(c):
    """pandas ``prod``: NULLs skipped, empty product = 1."""
    return F.coalesce(F.product(col(c)), F.lit(1.0))


def bucket_stats(pnl: DataFrame) -> DataFrame:
    """AGG-1: per score bucket: mean and product of SR and DR, count."""
    return pnl.groupBy("symbol", "y_pred_id").agg(
        F.avg("SR").alias("SRAvg"), _prod1("SR").alias("SRTotal"), F.avg("DR").alias("DRAvg"),
        _prod1("DR").alias("DRTotal"), F.count("y_pred_id").alias("Count"))


def monthly_stats(pnl: DataFrame) -> DataFrame:
    """AGG-2: per year-month products of DR (MR) and SR, with cumulative products CMR/CSR over months."""
    m = pnl.groupBy("symbol", F.date_format("bar_ts", "yyyy-MM").alias("month")).agg(
        _prod1("DR").alias("MR"), _prod1("SR").alias("SR"))
    m = index_series(m.withColumn("_ts", F.to_timestamp("month", "yyyy-MM").cast("timestamp_ntz")), order="_ts")
    return running(m, [("MR", "product", "CMR"), ("SR", "product", "CSR")]).drop("_ts", RN, "_blk")


def seasonal_month_stats(pnl: DataFrame) -> DataFrame:
    """AGG-3: per calendar month (all years together)."""
    return pnl.groupBy("symbol", F.date_format("bar_ts", "MM").alias("month")).agg(
        _prod1("DR").alias("MR"), _prod1("SR").alias("SR"))


def return_by_month(bars_dr: DataFrame) -> DataFrame:
    """AGG-4a: total return % by month number and name."""
    return bars_dr.groupBy("symbol", F.month("bar_ts").alias("mon"), F.date_format("bar_ts", "MMM").alias("month")).agg(
        (F.lit(100.0) * (_prod1("DR") - 1)).alias("DR"))


def return_by_weekday(bars_dr: DataFrame) -> DataFrame:
    """AGG-4b: total return % by weekday (0 = Monday) and name."""
    return bars_dr.groupBy("symbol", F.weekday("bar_ts").alias("weekday"),
                           F.date_format("bar_ts", "EEEE").alias("weekday_name")).agg(
        (F.lit(100.0) * (_prod1("DR") - 1)).alias("DR"))


def gen_trades(pnl: DataFrame) -> DataFrame:
    """AGG-5: bars -> trades (first/last/count/max/min/products), win flag (Q29) and cumulative
    products over trades (block scan over the trade table indexed by open time)."""
    tr = pnl.groupBy("symbol", "trade_id").agg(
        F.min_by("signal", RN).alias("action"), F.min("bar_ts").alias("open_ts"),
        F.max_by("date_to", RN).alias("close_ts"), F.min_by("open", RN).alias("open"),
        F.max_by("close", RN).alias("close"), F.count("bar_ts").alias("duration"),
        F.max("sl").alias("sl"), F.max("tp").alias("tp"), F.max("high").alias("high"), F.min("low").alias("low"),
        _prod1("DR").alias("mr"), _prod1("SR").alias("sr"))
    tr = tr.withColumn("win", (F.col("sr") > 1) | ((F.col("sr") == 1) & (F.col("mr") < 1)))
    tr = index_series(tr, order="open_ts")
    tr = running(tr, [("mr", "product", "CMR"), ("sr", "product", "CSR")])
    return tr.dropna(subset=["action", "open", "close", "mr", "sr", "CMR", "CSR"]).drop(RN, "_blk")


def strategy_summary(pnl: DataFrame, trades: DataFrame, periods: float = 365.0) -> DataFrame:
    """AGG-6: the 15 summary figures per symbol from bars and trades."""
    r = F.col("SR") - 1
    acc = (F.avg((F.col("y_pred").cast("int") == F.col("Price_Rise")).cast("double")) if "y_pred" in pnl.columns
           else F.lit(None).cast("double"))
    bars = pnl.groupBy("symbol").agg(
        F.max_by("CSR", RN).alias("strategy_return"), F.max_by("CMR", RN).alias("market_return"),
        F.count(F.lit(1)).alias("n_bars"), F.avg(r).alias("_mean"), F.stddev_pop(r).alias("_std"),
        (F.sum(F.pow(F.greatest(-r, F.lit(0.0)), 2)) / F.count(F.lit(1))).alias("_lpm2"),
        F.avg((F.col("signal") == "Buy").cast("double")).alias("buy_pct"),
        acc.alias("accuracy"),
        F.avg(F.col("sl").cast("double")).alias("sl_freq"), F.avg(F.col("tp").cast("double")).alias("tp_freq"))
    trs = trades.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_trades"), F.avg("duration").alias("bars_in_trade"),
        F.avg(F.col("win").cast("double")).alias("win_ratio"),
        (F.avg(F.when(F.col("win"), F.col("sr"))) - 1).alias("avg_win"),
        (1 - F.avg(F.when(~F.col("win"), F.col("sr")))).alias("avg_loss"))
    s = bars.join(trs, "symbol")
    sq = math.sqrt(periods)
    s = (s.withColumn("sortino", F.lit(sq) * F.col("_mean") / (F.sqrt("_lpm2") + F.lit(1e-15)))
         .withColumn("sharpe", F.lit(sq) * F.col("_mean") / (F.col("_std") + F.lit(1e-15)))
         .withColumn("risk_to_reward", F.when(F.col("avg_loss") == 0, F.lit(0.0)).otherwise(div("avg_win", "avg_loss")))
         .withColumn("adr", div(F.col("n_trades"), F.col("n_bars")) * (F.col("win_ratio") * F.col("avg_win")
                                                                       - (1 - F.col("win_ratio")) * F.col("avg_loss")))
         .withColumn("expectancy", F.lit(periods) * F.col("adr")))
    return s.drop("_mean", "_std", "_lpm2")


def avg_duration(pnl: DataFrame) -> DataFrame:
    """AGG-7: average length of runs of the same signal, per signal value."""
    df = rolling(ensure_indexed(pnl), {"_new": lambda w: ~F.col("signal").eqNullSafe(lag("signal", 1, w))}, back=1)
    df = df.withColumn("_run", F.when(F.col("_new"), F.col(RN)))
    df = running(df, [("_run", "last", "_run")])
    runs = df.groupBy("symbol", "signal", "_run").agg(F.count(F.lit(1)).alias("_len"))
    return runs.groupBy("symbol", "signal").agg(F.avg("_len").alias("avg_bars"))


def extremes(df: DataFrame, stat: str) -> DataFrame:
    """AGG-8: min, max, mean and current value of ``stat`` with the first date of each extreme."""
    t = F.unix_seconds(F.col("bar_ts").cast("timestamp"))
    return df.groupBy("symbol").agg(
        F.min(stat).alias("min_value"), F.min_by("bar_ts", F.struct(F.col(stat), t)).alias("min_date"),
        F.max(stat).alias("max_value"), F.max_by("bar_ts", F.struct(F.col(stat), -t)).alias("max_date"),
        F.avg(stat).alias("mean_value"), F.max_by(stat, "bar_ts").alias("current_value"))


def correlation_matrix(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """AGG-9: Pearson correlation of every column pair in one aggregate, melted to long form."""
    return _melted(df.groupBy(*keys), cols, F.corr, keys, ("feature_a", "feature_b", "corr"))


ASSET_BLOCK = 32


def monthly_covariance(returns_wide: DataFrame, assets: Sequence[str]) -> DataFrame:
    """AGG-10: per month, sample covariance of daily returns for every asset pair (long form)."""
    rows = returns_wide.select("bar_ts", F.array(*[named(a) for a in assets]).alias("r"))
    names = F.array(*[F.lit(a) for a in assets])
    pairs = packed_covariance(rows, len(assets)).select("month", F.posexplode("tri").alias("_i", "_row")).select("month", "_i", F.posexplode("_row").alias("_j", "cov"))
    both = pairs.unionByName(pairs.filter("_i <> _j").select("month", F.col("_j").alias("_i"), F.col("_i").alias("_j"), "cov"))
    return both.select("month", F.get(names, F.col("_i")).alias("asset_i"), F.get(names, F.col("_j")).alias("asset_j"), "cov")


def packed_covariance(returns: DataFrame, n: int, block: int = ASSET_BLOCK) -> DataFrame:
    """returns (bar_ts, r: the returns of ``n`` assets) -> (month, tri): the lower triangle of the month's sample covariance,
    row i with its i + 1 entries. A pair uses the bars where both have a return; NULL for fewer than two.

    Assets are taken in blocks: one row per (month, block) holds the block's series in the month, one row per pair of blocks
    computes their part, so the work of a month is spread and no aggregate has a term per pair of assets."""
    last = (n - 1) // block
    d = returns.select(F.date_format("bar_ts", "yyyy-MM").alias("month"), "bar_ts", F.posexplode(
        F.transform(F.sequence(F.lit(0), F.lit(last)), lambda b: F.slice("r", b * block + 1, F.lit(block)))).alias("b", "r"))
    held = d.groupBy("month", "b").agg(F.sort_array(F.collect_list(F.struct("bar_ts", "r"))).alias("t"))
    held = held.select("month", "b", F.transform("t", lambda t: t["r"]).alias("t"))
    pairs = held.join(held.select("month", F.col("b").alias("c"), F.col("t").alias("u")), "month").filter("c <= b")
    part = pairs.mapInArrow(_block_covariance(block), "month string, i int, c int, row array<double>")
    rows = part.groupBy("month", "i").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("c", "row"))), lambda p: p["row"])).alias("row"))
    rows = rows.withColumn("row", F.slice("row", F.lit(1), F.col("i") + 1))
    return rows.groupBy("month").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "row"))), lambda p: p["row"]).alias("tri"))


def _block_covariance(block: int):
    """For mapInArrow over (month, b, t, c, u), t and u being the bars of two blocks of assets: the rows of their part of
    the covariance matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for month, b, t, c, u in zip(*(batch.column(n).to_pylist() for n in ("month", "b", "t", "c", "u"))):
                x, y = np.array(t, float), np.array(u, float)  # bars x assets, missing: not a number
                hx, hy = ~np.isnan(x), ~np.isnan(y)
                x, y = (np.where(h, v - np.where(h, v, 0.0).sum(0) / np.maximum(h.sum(0), 1), 0.0) for v, h in ((x, hx), (y, hy)))
                both = hx.T.astype(float) @ hy
                with np.errstate(divide="ignore", invalid="ignore"):
                    cov = (x.T @ y - (x.T @ hy) * (hx.T.astype(float) @ y) / both) / (both - 1)
                rows = [[v if m > 1 else None for v, m in zip(line, many)] for line, many in zip(cov.tolist(), both.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([month] * len(rows)), pa.array(range(b * block, b * block + len(rows)), pa.int32()),
                                                  pa.array([c] * len(rows), pa.int32()), pa.array(rows, pa.list_(pa.float64()))], names=["month", "i", "c", "row"])
    return run


def _melted(groups, cols: Sequence[str], measure, keys: Sequence[str], names: tuple[str, str, str]) -> DataFrame:
    """``measure`` of every column pair in one aggregate, one row per pair; column names may hold dots and quotes."""
    pairs = [(a, b) for a in cols for b in cols]
    agg = groups.agg(*[measure(named(a), named(b)).alias(f"_p{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias(names[0]), F.lit(b).alias(names[1]), F.col(f"_p{i}").alias(names[2]))
                     for i, (a, b) in enumerate(pairs)])
    return agg.select(*keys, F.explode(rows).alias("_r")).select(*keys, "_r.*")


def return_histogram(df: DataFrame, c: str, bins: int = 50) -> DataFrame:
    """AGG-11: equal-width histogram between the symbol's min and max (max falls in the last bin)."""
    d = whole_series(df.filter(F.col(c).isNotNull()), {"_lo": F.min(c), "_hi": F.max(c)})
    b = F.least(F.floor((F.col(c) - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1))
    d = d.withColumn("bin", F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(b).cast("int"))
    return d.groupBy("symbol", "bin").agg(
        F.count(F.lit(1)).alias("count"),
        F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi")).withColumn(
        "bin_lo", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / bins).drop("_lo", "_hi")


def acf(df: DataFrame, c: str, nlags: int = 10) -> DataFrame:
    """AGG-12: autocorrelation r_k = sum (x_t - m)(x_{t+k} - m) / sum (x_t - m)^2, k = 1..nlags; NULL for a flat series."""
    d = df.filter(F.col(c).isNotNull())
    d = whole_series(d, {"_m": F.avg(c)})
    d = d.withColumn("_x", F.col(c) - F.col("_m"))
    d = reindex_if_needed(d)
    d = rolling(d, {f"_l{k}": (lambda k: lambda w: lag("_x", k, w))(k) for k in range(1, nlags + 1)}, back=nlags)
    agg = d.groupBy("symbol").agg(F.sum(F.col("_x") * F.col("_x")).alias("_den"),
                                  *[F.sum(F.col("_x") * F.col(f"_l{k}")).alias(f"_n{k}") for k in range(1, nlags + 1)])
    stack = ", ".join(f"{k}, try_divide(`_n{k}`, _den)" for k in range(1, nlags + 1))
    return agg.selectExpr("symbol", f"stack({nlags}, {stack}) AS (lag, acf)")


def reindex_if_needed(d: DataFrame) -> DataFrame:
    from candela.operators.series import reindex
    return reindex(d) if RN in d.columns else index_series(d)


def pacf(acf_df: DataFrame) -> DataFrame:
    """AGG-13: partial autocorrelation from the ACF table (lags 1..k) by the Levinson-Durbin recursion, as a fold over the
    symbol's array of ACF values whose state is (coefficients of the current order, partial autocorrelations so far).
    NULL from the first order that is undefined (a flat series, or a prediction without error)."""
    listed = acf_df.groupBy("symbol").agg(F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda e: e["acf"]).alias("_r"))

    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)

    def step(s, m):
        known = F.slice("_r", F.lit(1), m - 1)
        new = div(F.get("_r", m - 1) - dot(s["phi"], F.reverse(known)), F.lit(1.0) - dot(s["phi"], known))
        grown = F.transform(F.array(new), lambda p: F.struct(
            F.concat(F.zip_with(s["phi"], F.reverse(s["phi"]), lambda a, b: a - p * b), F.array(p)).alias("phi"), F.concat(s["out"], F.array(p)).alias("out")))
        return F.get(grown, F.lit(0))

    none = F.array().cast("array<double>")
    orders = F.sequence(F.lit(1), F.size("_r"))
    folded = F.aggregate(orders, F.struct(none.alias("phi"), none.alias("out")), step, lambda s: s["out"])
    return listed.select("symbol", F.posexplode(folded).alias("_i", "pacf")).select("symbol", (F.col("_i") + 1).alias("lag"), "pacf")


def perf_diff(pnl: DataFrame, model_start: str) -> DataFrame:
    """AGG-14: in-sample (before) vs out-of-sample (after) accuracy and mean |DR - score|; the
    boundary day is in neither (Q27)."""
    cut = F.to_timestamp(F.lit(model_start)).cast("timestamp_ntz")
    correct = (F.col("y_pred").cast("int") == F.col("Price_Rise")).cast("double")
    err = F.abs(F.col("DR") - F.col("y_pred_val"))
    return pnl.groupBy("symbol").agg(
        F.avg(F.when(F.col("bar_ts") < cut, correct)).alias("in_accuracy"),
        F.avg(F.when(F.col("bar_ts") > cut, correct)).alias("out_accuracy"),
        F.avg(F.when(F.col("bar_ts") < cut, err)).alias("in_error"),
        F.avg(F.when(F.col("bar_ts") > cut, err)).alias("out_error"))


def confusion_matrix(df: DataFrame, pred: str, actual: str) -> DataFrame:
    """AGG-15: counts per (predicted, actual) and the hit rate per symbol."""
    cm = df.groupBy("symbol", F.col(pred).alias("predicted"), F.col(actual).alias("actual")).agg(
        F.count(F.lit(1)).alias("n"))
    return whole_series(cm, {"_tot": F.sum("n"), "_hit": F.sum(F.when(F.col("predicted") == F.col("actual"), F.col("n")))}) \
        .withColumn("hit_rate", div(F.col("_hit"), F.col("_tot"))).drop("_tot", "_hit")


def regression_scores(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """AGG-20: R^2 (NULL for a constant target), MAE, directional accuracy and the share of |residual| < 0.5."""
    e = F.col(y) - F.col(yhat)
    d = whole_series(df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull()), {"_ym": F.avg(y)})
    return d.groupBy("symbol").agg(
        (1 - div(F.sum(e * e), F.sum(F.pow(F.col(y) - F.col("_ym"), 2)))).alias("r2"),
        F.avg(F.abs(e)).alias("mae"),
        F.avg((F.signum(y) == F.signum(yhat)).cast("double")).alias("direction_accuracy"),
        F.avg((F.abs(e) < 0.5).cast("double")).alias("share_resid_lt_half"))


def sign_penalty(df: DataFrame, y: str, yhat: str, penalty: float = 100.0) -> DataFrame:
    """AGG-21: mean squared error with squared errors x penalty where the signs differ."""
    sq = F.pow(F.col(y) - F.col(yhat), 2)
    return df.groupBy("symbol").agg(
        F.avg(F.when(F.col(y) * F.col(yhat) < 0, F.lit(penalty) * sq).otherwise(sq)).alias("sign_penalty_loss"))


def signal_counts(df: DataFrame, c: str = "signal") -> DataFrame:
    """AGG-23."""
    return df.groupBy("symbol", c).agg(F.count(F.lit(1)).alias("n"))


def log_trend(df: DataFrame) -> DataFrame:
    """AGG-24: least-squares line of ln(close) on the bar number (1-based)."""
    d = ensure_indexed(df)
    t = (F.col(RN) + 1).cast("double")
    fit = d.groupBy("symbol").agg(F.regr_slope(F.ln("close"), t).alias("slope"),
                                  F.regr_intercept(F.ln("close"), t).alias("intercept"),
                                  F.max(t).alias("_tn"))
    return fit.withColumn("fitted_last", F.exp(F.col("intercept") + F.col("slope") * F.col("_tn"))).drop("_tn")


def conditional_product(df: DataFrame, value: str, flag: str | object) -> DataFrame:
    """AGG-25: product of ``value`` over bars where ``flag`` holds (empty -> 1)."""
    f = col(flag) if isinstance(flag, str) else flag
    return df.groupBy("symbol").agg(_prod1(F.when(f, F.col(value))).alias("cond_return"))


def run_vs_hold(df: DataFrame, total: str = "ntotal", pnl: str = "pnl", close: str = "close", dr: str = "dr",
                conf: str = "conf") -> DataFrame:
    """AGG-22: strategy vs buy-and-hold: return ratio (last/first), Sharpe ratio (mean/std) ratio,
    mean confidence."""
    d = ensure_indexed(df)
    g = d.groupBy("symbol").agg(
        div(F.max_by(total, RN), F.min_by(total, RN)).alias("run_return"),
        div(F.avg(pnl), F.stddev_samp(pnl)).alias("run_sharpe"),
        div(F.max_by(close, RN), F.min_by(close, RN)).alias("hold_return"),
        div(F.avg(dr), F.stddev_samp(dr)).alias("hold_sharpe"),
        F.avg(conf).alias("avg_confidence"))
    return g.withColumn("return_ratio", div("run_return", "hold_return")).withColumn(
        "sharpe_ratio_ratio", div("run_sharpe", "hold_sharpe"))


def state_counts(table: DataFrame) -> DataFrame:
    """AGG-22: of a state table (SIG-13): states, states with visits, confident states per symbol."""
    return table.groupBy("symbol").agg(
        F.count("state").alias("n_states"), F.count_if(F.col("state").isNotNull() & (F.col("visits") > 0)).alias("n_valid"),
        F.count_if(F.col("state").isNotNull() & F.col("confident")).alias("n_confident"))
