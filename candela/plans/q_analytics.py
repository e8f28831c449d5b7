"""Registered queries for §2.3 (JON), §2.8 (AGG) and §2.9 (RSK)."""

from __future__ import annotations

from pyspark.sql import functions as F

from candela.config import PRESETS
from candela.functions.scalar import named
from candela.operators import aggregates as AG
from candela.operators import features as FE
from candela.operators import forecast as FC
from candela.operators import joins as JN
from candela.operators import portfolio as PF
from candela.operators import risk as RK
from candela.operators import signals as SG
from candela.plans import sqlparts as S
from candela.plans.catalog import DAILY, HOURLY, WEEKLY, register, rounded, rsql
from candela.plans.strategies import roc_backtest
from candela.sources.fixtures import bars_daily, bars_hourly, bars_weekly

W = "WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts)"
K = ["symbol", "bar_ts"]
ROC = PRESETS["eth_usd_roc"]
PNL_D = DAILY + "," + S.roc_signal_ctes("bars", ROC) + "," + S.pnl_ctes("td", ROC)
PNL_H = HOURLY + "," + S.roc_signal_ctes("bars", ROC) + "," + S.pnl_ctes("td", ROC)


def out(df, cols):
    return rounded(df.select(*cols))


def _pnl_d(spark, sf):
    return roc_backtest(bars_daily(spark, sf), ROC, keep_adx=False)


def one(x):
    return f"coalesce(product({x}), 1.0)"


# --- AGG ----------------------------------------------------------------------------------------

_B = ["symbol", "y_pred_id", "SRAvg", "SRTotal", "DRAvg", "DRTotal", "Count"]


@register("agg01_bucket_stats", PNL_D + f""",
a AS (SELECT symbol, y_pred_id, avg(SR) AS SRAvg, {one('SR')} AS SRTotal, avg(DR) AS DRAvg, {one('DR')} AS DRTotal,
             count(y_pred_id) AS Count FROM pnl GROUP BY 1, 2)
{rsql(_B, ['SRAvg', 'SRTotal', 'DRAvg', 'DRTotal'], 'a')}""")
def q_agg01(spark, sf):
    return out(AG.bucket_stats(_pnl_d(spark, sf)), _B)


_M = ["symbol", "month", "MR", "SR", "CMR", "CSR"]


@register("agg02_monthly_stats", PNL_D + f""",
m0 AS (SELECT symbol, strftime(bar_ts, '%Y-%m') AS month, {one('DR')} AS MR, {one('SR')} AS SR FROM pnl GROUP BY 1, 2),
m1 AS (SELECT *, product(MR) OVER (PARTITION BY symbol ORDER BY month ROWS UNBOUNDED PRECEDING) AS CMR,
              product(SR) OVER (PARTITION BY symbol ORDER BY month ROWS UNBOUNDED PRECEDING) AS CSR FROM m0)
{rsql(_M, ['MR', 'SR', 'CMR', 'CSR'], 'm1')}""")
def q_agg02(spark, sf):
    return out(AG.monthly_stats(_pnl_d(spark, sf)), _M)


@register("agg03_seasonal_month_stats", PNL_D + f""",
a AS (SELECT symbol, strftime(bar_ts, '%m') AS month, {one('DR')} AS MR, {one('SR')} AS SR FROM pnl GROUP BY 1, 2)
{rsql(['symbol', 'month', 'MR', 'SR'], ['MR', 'SR'], 'a')}""")
def q_agg03(spark, sf):
    return out(AG.seasonal_month_stats(_pnl_d(spark, sf)), ["symbol", "month", "MR", "SR"])


_DRB = DAILY + f""",
d AS (SELECT symbol, bar_ts, close / nullif(lag(close) OVER w, 0) AS DR FROM bars {W})"""


@register("agg04_return_by_month", _DRB + f""",
a AS (SELECT symbol, CAST(month(bar_ts) AS INT) AS mon, strftime(bar_ts, '%b') AS month,
             100.0 * ({one('DR')} - 1) AS total_return_pct FROM d GROUP BY 1, 2, 3)
{rsql(['symbol', 'mon', 'month', 'total_return_pct'], ['total_return_pct'], 'a')}""")
def q_agg04(spark, sf):
    d = AG.return_by_month(FE.gross_return(bars_daily(spark, sf))).withColumnRenamed("DR", "total_return_pct")
    return out(d, ["symbol", "mon", "month", "total_return_pct"])


@register("agg04_return_by_weekday", _DRB + f""",
a AS (SELECT symbol, CAST(isodow(bar_ts) - 1 AS INT) AS weekday, strftime(bar_ts, '%A') AS weekday_name,
             100.0 * ({one('DR')} - 1) AS total_return_pct FROM d GROUP BY 1, 2, 3)
{rsql(['symbol', 'weekday', 'weekday_name', 'total_return_pct'], ['total_return_pct'], 'a')}""")
def q_agg04b(spark, sf):
    d = AG.return_by_weekday(FE.gross_return(bars_daily(spark, sf))).withColumnRenamed("DR", "total_return_pct")
    return out(d, ["symbol", "weekday", "weekday_name", "total_return_pct"])


_TR = ["symbol", "trade_id", "action", "open_ts", "close_ts", "open", "close", "duration", "sl", "tp", "high", "low",
       "mr", "sr", "win", "CMR", "CSR"]
TRADES_SQL = f""",
tr0 AS (SELECT symbol, trade_id, arg_min(signal, pos) AS action, min(bar_ts) AS open_ts, arg_max(date_to, pos) AS close_ts,
               arg_min(open, pos) AS open, arg_max(close, pos) AS close, count(bar_ts) AS duration, bool_or(sl) AS sl,
               bool_or(tp) AS tp, max(high) AS high, min(low) AS low, {one('DR')} AS mr, {one('SR')} AS sr
        FROM pnl GROUP BY 1, 2),
trades AS (SELECT *, sr > 1 OR (sr = 1 AND mr < 1) AS win,
                  product(mr) OVER (PARTITION BY symbol ORDER BY open_ts ROWS UNBOUNDED PRECEDING) AS CMR,
                  product(sr) OVER (PARTITION BY symbol ORDER BY open_ts ROWS UNBOUNDED PRECEDING) AS CSR FROM tr0)"""


@register("agg05_gen_trades", PNL_D + TRADES_SQL + "\n" + rsql(_TR, ["open", "close", "high", "low", "mr", "sr", "CMR", "CSR"], "trades"))
def q_agg05(spark, sf):
    return out(AG.gen_trades(_pnl_d(spark, sf)), _TR)


_SUM = ["symbol", "strategy_return", "market_return", "n_bars", "buy_pct", "accuracy", "sl_freq", "tp_freq", "n_trades",
        "bars_in_trade", "win_ratio", "avg_win", "avg_loss", "sortino", "sharpe", "risk_to_reward", "adr", "expectancy"]


@register("agg06_strategy_summary", PNL_D + TRADES_SQL + f""",
b AS (SELECT symbol, arg_max(CSR, pos) AS strategy_return, arg_max(CMR, pos) AS market_return, count(*) AS n_bars,
             avg(SR - 1) AS mean_, stddev_pop(SR - 1) AS std_, sum(pow(greatest(-(SR - 1), 0.0), 2)) / count(*) AS lpm2,
             avg(CASE WHEN signal = 'Buy' THEN 1.0 ELSE 0.0 END) AS buy_pct,
             avg(CASE WHEN CAST(y_pred AS INT) = Price_Rise THEN 1.0 ELSE 0.0 END) AS accuracy,
             avg(CAST(sl AS DOUBLE)) AS sl_freq, avg(CAST(tp AS DOUBLE)) AS tp_freq FROM pnl GROUP BY symbol),
t AS (SELECT symbol, count(*) AS n_trades, avg(duration) AS bars_in_trade, avg(CAST(win AS DOUBLE)) AS win_ratio,
             avg(CASE WHEN win THEN sr END) - 1 AS avg_win, 1 - avg(CASE WHEN NOT win THEN sr END) AS avg_loss
      FROM trades GROUP BY symbol),
s AS (SELECT b.*, t.* EXCLUDE (symbol), {S.f(365 ** 0.5)} * mean_ / (sqrt(lpm2) + 1e-15) AS sortino,
             {S.f(365 ** 0.5)} * mean_ / (std_ + 1e-15) AS sharpe,
             CASE WHEN avg_loss = 0 THEN 0.0 ELSE avg_win / avg_loss END AS risk_to_reward,
             n_trades / n_bars * (win_ratio * avg_win - (1 - win_ratio) * avg_loss) AS adr FROM b JOIN t USING (symbol)),
s2 AS (SELECT *, 365.0 * adr AS expectancy FROM s)
{rsql(_SUM, ['strategy_return', 'market_return', 'buy_pct', 'accuracy', 'sl_freq', 'tp_freq', 'bars_in_trade', 'win_ratio',
             'avg_win', 'avg_loss', 'sortino', 'sharpe', 'risk_to_reward', 'adr', 'expectancy'], 's2')}""")
def q_agg06(spark, sf):
    pnl = _pnl_d(spark, sf)
    return out(AG.strategy_summary(pnl, AG.gen_trades(pnl)), _SUM)


@register("agg07_avg_duration", PNL_D + f""",
r0 AS (SELECT symbol, signal, pos, CASE WHEN signal IS DISTINCT FROM lag(signal) OVER (PARTITION BY symbol ORDER BY pos)
                                       THEN 1 ELSE 0 END AS nw FROM pnl),
r1 AS (SELECT *, sum(nw) OVER (PARTITION BY symbol ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM r0),
r2 AS (SELECT symbol, signal, run, count(*) AS len FROM r1 GROUP BY 1, 2, 3)
SELECT symbol, signal, round(avg(len), 6) AS avg_bars FROM r2 GROUP BY 1, 2""")
def q_agg07(spark, sf):
    return rounded(AG.avg_duration(_pnl_d(spark, sf)))


@register("agg08_extremes", DAILY + """
SELECT symbol, round(min(close), 6) AS min_value, first(bar_ts ORDER BY close, bar_ts) AS min_date,
       round(max(close), 6) AS max_value, first(bar_ts ORDER BY close DESC, bar_ts) AS max_date,
       round(avg(close), 6) AS mean_value, round(arg_max(close, bar_ts), 6) AS current_value FROM bars GROUP BY symbol""")
def q_agg08(spark, sf):
    return rounded(AG.extremes(bars_daily(spark, sf), "close"))


_CF = ["DR", "MA", "VOL", "STD"]


@register("agg09_correlation_matrix", HOURLY + f""",
t AS (SELECT symbol, bar_ts, close / nullif(lag(close) OVER w, 0) AS DR,
             close / nullif({S.full_avg('close', 50)}, 0) AS MA, volume / nullif({S.full_avg('volume', 30)}, 0) AS VOL,
             {S.full_agg('stddev_samp', 'close', 7)} / nullif(close, 0) AS STD FROM bars {W})
""" + "\nUNION ALL\n".join(f"SELECT symbol, '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS corr FROM t GROUP BY symbol"
                           for a in _CF for b in _CF))
def q_agg09(spark, sf):
    d = FE.base_features(bars_hourly(spark, sf))
    return rounded(AG.correlation_matrix(d, _CF))


@register("agg10_monthly_covariance", WEEKLY + """,
d AS (SELECT symbol, bar_ts, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY bar_ts), 0) AS DR FROM bars),
w AS (SELECT bar_ts FROM d WHERE DR IS NOT NULL GROUP BY bar_ts HAVING count(*) = (SELECT count(DISTINCT symbol) FROM bars)),
k AS (SELECT d.*, strftime(bar_ts, '%Y-%m') AS month FROM d JOIN w USING (bar_ts)),
c AS (SELECT a.month, a.symbol AS asset_i, b.symbol AS asset_j, covar_samp(a.DR, b.DR) AS cov FROM k a JOIN k b USING (bar_ts) GROUP BY 1, 2, 3)
SELECT month, asset_i, asset_j, round(cov, 6) AS cov FROM c""")
def q_agg10(spark, sf):
    """AGG-10 over all brands, weekly bars (at the small scale no day has a bar of every brand)."""
    d = FE.gross_return(bars_weekly(spark, sf))
    names = PF.asset_names(d)
    return rounded(AG.monthly_covariance(JN.align_assets(d, names, "DR"), names))


@register("agg11_return_histogram", HOURLY + f""",
t AS (SELECT symbol, close / nullif(lag(close) OVER w, 0) - 1 AS r FROM bars {W}),
u AS (SELECT symbol, r, min(r) OVER (PARTITION BY symbol) AS lo, max(r) OVER (PARTITION BY symbol) AS hi FROM t WHERE r IS NOT NULL),
v AS (SELECT symbol, lo, hi, CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((r - lo) / (hi - lo) * 50), 49) END AS INT) AS bin FROM u)
SELECT symbol, bin, count(*) AS count, round(first(lo) + (first(hi) - first(lo)) * bin / 50, 6) AS bin_lo FROM v GROUP BY symbol, bin""")
def q_agg11(spark, sf):
    d = FE.rolling(bars_hourly(spark, sf), {"r": lambda w: F.try_divide(F.col("close"), F.lag("close").over(w)) - 1}, back=1)
    return rounded(AG.return_histogram(d, "r", 50))


def _acf_sql():
    lags = ", ".join(f"lag(x, {k}) OVER w AS l{k}" for k in range(1, 11))
    return HOURLY + f""",
t AS (SELECT symbol, bar_ts, ln(close / nullif(lag(close) OVER w, 0)) AS lr FROM bars {W}),
u AS (SELECT symbol, bar_ts, lr - avg(lr) OVER (PARTITION BY symbol) AS x FROM t WHERE lr IS NOT NULL),
v AS (SELECT *, {lags} FROM u {W})
""" + "\nUNION ALL\n".join(f"SELECT symbol, {k} AS lag, round(sum(x * l{k}) / sum(x * x), 6) AS acf FROM v GROUP BY symbol"
                           for k in range(1, 11))


@register("agg12_acf", _acf_sql())
def q_agg12(spark, sf):
    d = FE.log_return(bars_hourly(spark, sf), out="lr")
    return rounded(AG.acf(d, "lr", 10))


def _pacf_ctes() -> str:
    """Durbin-Levinson as a recursive CTE over m = 1..10 carrying the coefficient list phi."""
    lags = ", ".join(f"lag(x, {k}) OVER w AS l{k}" for k in range(1, 11))
    acfs = " UNION ALL ".join(f"SELECT symbol, {k} AS lag, sum(x * l{k}) / sum(x * x) AS acf FROM v GROUP BY symbol"
                              for k in range(1, 11))
    return HOURLY + f""",
t AS (SELECT symbol, bar_ts, ln(close / nullif(lag(close) OVER w, 0)) AS lr FROM bars {W}),
u AS (SELECT symbol, bar_ts, lr - avg(lr) OVER (PARTITION BY symbol) AS x FROM t WHERE lr IS NOT NULL),
v AS (SELECT *, {lags} FROM u {W}),
ac AS ({acfs}),
rl AS (SELECT symbol, list(acf ORDER BY lag) AS r FROM ac GROUP BY symbol),
dl AS (
  SELECT symbol, 1 AS m, r, [r[1]] AS phi, r[1] AS pacf FROM rl
  UNION ALL
  SELECT symbol, m + 1, r, list_concat(list_transform(phi, lambda p, j: p - q.k * phi[m + 1 - j]), [q.k]), q.k
  FROM dl, LATERAL (SELECT (r[m + 1] - coalesce(list_sum(list_transform(phi, lambda p, j: p * r[m + 1 - j])), 0.0))
                           / (1.0 - coalesce(list_sum(list_transform(phi, lambda p, j: p * r[j])), 0.0)) AS k) q
  WHERE m < 10),
pacf AS (SELECT symbol, CAST(m AS INT) AS lag, pacf FROM dl)"""


@register("agg13_pacf", _pacf_ctes() + "\nSELECT symbol, lag, round(pacf, 6) AS pacf FROM pacf")
def q_agg13(spark, sf):
    """AGG-13: partial autocorrelation by Durbin-Levinson over the ACF table (per-symbol groups of 10 rows)."""
    d = FE.log_return(bars_hourly(spark, sf), out="lr")
    return rounded(AG.pacf(AG.acf(d, "lr", 10)))


@register("agg14_perf_diff", PNL_D + """
SELECT symbol,
  round(avg(CASE WHEN bar_ts < TIMESTAMP '1999-01-01' THEN CASE WHEN CAST(y_pred AS INT) = Price_Rise THEN 1.0 ELSE 0.0 END END), 6) AS in_accuracy,
  round(avg(CASE WHEN bar_ts > TIMESTAMP '1999-01-01' THEN CASE WHEN CAST(y_pred AS INT) = Price_Rise THEN 1.0 ELSE 0.0 END END), 6) AS out_accuracy,
  round(avg(CASE WHEN bar_ts < TIMESTAMP '1999-01-01' THEN abs(DR - y_pred_val) END), 6) AS in_error,
  round(avg(CASE WHEN bar_ts > TIMESTAMP '1999-01-01' THEN abs(DR - y_pred_val) END), 6) AS out_error
FROM pnl GROUP BY symbol""")
def q_agg14(spark, sf):
    return rounded(AG.perf_diff(_pnl_d(spark, sf), "1999-01-01"))


@register("agg15_confusion_matrix", PNL_D + """,
c AS (SELECT symbol, CAST(y_pred AS INT) AS predicted, Price_Rise AS actual, count(*) AS n FROM pnl GROUP BY 1, 2, 3)
SELECT *, round(sum(CASE WHEN predicted = actual THEN n END) OVER (PARTITION BY symbol) / sum(n) OVER (PARTITION BY symbol), 6)
       AS hit_rate FROM c""")
def q_agg15(spark, sf):
    d = _pnl_d(spark, sf).withColumn("_p", F.col("y_pred").cast("int"))
    return rounded(AG.confusion_matrix(d, "_p", "Price_Rise"))


FC_SQL = DAILY + f""",
f00 AS (SELECT symbol, bar_ts, close, {S.full_avg('close', 10)} AS sma, {S.full_agg('stddev_samp', 'close', 10)} AS sd0 FROM bars {W}),
f0 AS (SELECT symbol, bar_ts, close AS y, lag(sma) OVER w AS yhat, lag(sd0) OVER w AS sd FROM f00 {W}),
fc AS (SELECT symbol, bar_ts, y, p.prior, yhat, yhat - p.prior * sd AS yhat_lower, yhat + p.prior * sd AS yhat_upper
       FROM f0, (VALUES (1.0), (2.0), (3.0)) p(prior) WHERE yhat IS NOT NULL)"""


def _fc(spark, sf, ks=(2.0,)):
    bars = bars_daily(spark, sf)
    f = FC.moving_average_forecast(bars, 10, ks)
    return FC.join_forecast(bars.select("symbol", "bar_ts", F.col("close").alias("y")), f)


@register("agg16_forecast_eval", FC_SQL + f""",
te AS (SELECT *, yhat - lag(yhat) OVER w AS pred_diff, y - lag(y) OVER w AS real_diff FROM fc
       WHERE prior = 2.0 AND bar_ts >= TIMESTAMP '2000-01-01' AND bar_ts <= TIMESTAMP '2000-12-31' {W}),
a AS (SELECT symbol,
        100.0 * avg(CASE WHEN pred_diff > 0 THEN coalesce(CAST(sign(pred_diff) = sign(real_diff) AS DOUBLE), 0.0) END) AS increase_accuracy,
        100.0 * avg(CASE WHEN pred_diff < 0 THEN coalesce(CAST(sign(pred_diff) = sign(real_diff) AS DOUBLE), 0.0) END) AS decrease_accuracy,
        avg(abs(y - yhat)) AS test_mae, 100.0 * avg(CASE WHEN y < yhat_upper AND y > yhat_lower THEN 1.0 ELSE 0.0 END) AS in_range_pct
      FROM te GROUP BY symbol),
b AS (SELECT symbol, avg(abs(y - yhat)) AS train_mae FROM fc
      WHERE prior = 2.0 AND bar_ts < TIMESTAMP '2000-01-01' AND bar_ts > TIMESTAMP '1997-01-01' GROUP BY symbol),
c AS (SELECT a.*, b.train_mae FROM a LEFT JOIN b USING (symbol))
{rsql(['symbol', 'increase_accuracy', 'decrease_accuracy', 'test_mae', 'in_range_pct', 'train_mae'],
      ['increase_accuracy', 'decrease_accuracy', 'test_mae', 'in_range_pct', 'train_mae'], 'c')}""")
def q_agg16(spark, sf):
    j = _fc(spark, sf)
    return rounded(FC.forecast_eval(j, "2000-01-01", "2000-12-31", 3))


@register("agg17_forecast_profit", FC_SQL + f""",
te AS (SELECT *, yhat - lag(yhat) OVER w AS pred_diff, y - lag(y) OVER w AS real_diff FROM fc
       WHERE prior = 2.0 AND bar_ts >= TIMESTAMP '2000-01-01' AND bar_ts <= TIMESTAMP '2000-12-31' {W}),
u AS (SELECT symbol, bar_ts, sum(CASE WHEN pred_diff > 0 THEN 10.0 * real_diff ELSE 0.0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS pred_profit,
             10.0 * (y - first_value(y) OVER w) AS hold_profit FROM te {W})
{rsql(['symbol', 'bar_ts', 'pred_profit', 'hold_profit'], ['pred_profit', 'hold_profit'], 'u')}""")
def q_agg17(spark, sf):
    j = _fc(spark, sf)
    return out(FC.forecast_profit(j, "2000-01-01", "2000-12-31", 10.0), K + ["pred_profit", "hold_profit"])


@register("agg18_interval_validation", FC_SQL + """,
a AS (SELECT symbol, prior,
  avg(CASE WHEN bar_ts < TIMESTAMP '2000-01-01' AND bar_ts > TIMESTAMP '1997-01-01' THEN abs(y - yhat) END) AS train_err,
  avg(CASE WHEN bar_ts < TIMESTAMP '2000-01-01' AND bar_ts > TIMESTAMP '1997-01-01' THEN abs(yhat_upper - yhat_lower) END) AS train_range,
  avg(CASE WHEN bar_ts >= TIMESTAMP '2000-01-01' AND bar_ts <= TIMESTAMP '2000-12-31' THEN abs(y - yhat) END) AS test_err,
  avg(CASE WHEN bar_ts >= TIMESTAMP '2000-01-01' AND bar_ts <= TIMESTAMP '2000-12-31' THEN abs(yhat_upper - yhat_lower) END) AS test_range
  FROM fc GROUP BY 1, 2)
SELECT symbol, prior, round(train_err, 6) AS train_err, round(train_range, 6) AS train_range, round(test_err, 6) AS test_err,
       round(test_range, 6) AS test_range FROM a""")
def q_agg18(spark, sf):
    return rounded(FC.interval_validation(_fc(spark, sf, (1.0, 2.0, 3.0)), "2000-01-01", "2000-12-31", 3))


@register("agg19_forecast_direction", FC_SQL + f""",
t AS (SELECT symbol, bar_ts, yhat AS estimate, yhat_lower, yhat_upper FROM fc
      WHERE prior = 2.0 AND bar_ts >= TIMESTAMP '2001-01-01' AND isodow(bar_ts) <= 5),
u AS (SELECT *, estimate - lag(estimate) OVER w AS change FROM t {W})
SELECT symbol, bar_ts, round(estimate, 6) AS estimate, round(change, 6) AS change, CAST(change > 0 AS INT) AS direction
FROM u WHERE change IS NOT NULL""")
def q_agg19(spark, sf):
    f = _fc(spark, sf)
    return out(FC.forecast_direction(f, "2001-01-01"), K + ["estimate", "change", "direction"])


@register("agg20_regression_scores", FC_SQL + """,
t AS (SELECT symbol, y, yhat, avg(y) OVER (PARTITION BY symbol) AS ym FROM fc WHERE prior = 2.0)
SELECT symbol, round(1 - sum((y - yhat) * (y - yhat)) / sum(pow(y - ym, 2)), 6) AS r2, round(avg(abs(y - yhat)), 6) AS mae,
       round(avg(CASE WHEN sign(y) = sign(yhat) THEN 1.0 ELSE 0.0 END), 6) AS direction_accuracy,
       round(avg(CASE WHEN abs(y - yhat) < 0.5 THEN 1.0 ELSE 0.0 END), 6) AS share_resid_lt_half FROM t GROUP BY symbol""")
def q_agg20(spark, sf):
    return rounded(AG.regression_scores(_fc(spark, sf), "y", "yhat"))


@register("agg21_sign_penalty", FC_SQL + """,
t AS (SELECT symbol, y - lag(y) OVER (PARTITION BY symbol ORDER BY bar_ts) AS dy,
             yhat - lag(y) OVER (PARTITION BY symbol ORDER BY bar_ts) AS dhat FROM fc WHERE prior = 2.0)
SELECT symbol, """ + S.sig_sql("avg(CASE WHEN dy * dhat < 0 THEN 100.0 * pow(dy - dhat, 2) ELSE pow(dy - dhat, 2) END)") + """ AS sign_penalty_loss
FROM t WHERE dy IS NOT NULL AND dhat IS NOT NULL GROUP BY symbol""")
def q_agg21(spark, sf):
    j = FE.rolling(_fc(spark, sf), {
        "dy": lambda w: F.col("y") - F.lag("y").over(w), "dhat": lambda w: F.col("yhat") - F.lag("y").over(w)}, back=1)
    return rounded(AG.sign_penalty(j.dropna(subset=["dy", "dhat"]), "dy", "dhat", 100.0))


def _agg22_sql() -> str:
    from candela.plans.q_strategy import LEDGER_SQL
    cols = ["run_return", "run_sharpe", "hold_return", "hold_sharpe", "avg_confidence", "return_ratio", "sharpe_ratio_ratio"]
    return LEDGER_SQL + """,
lv AS (SELECT l.symbol, l.bar_ts, l.pnl, l.pos, g.close, td.y_pred_val,
              g.close / nullif(lag(g.close) OVER (PARTITION BY l.symbol ORDER BY l.bar_ts), 0) - 1 AS dr
       FROM ledger l JOIN g0 g USING (symbol, bar_ts) JOIN td USING (symbol, bar_ts)),
a AS (SELECT symbol, arg_max(1000.0 + pnl, pos) / nullif(arg_min(1000.0 + pnl, pos), 0) AS run_return,
             avg(pnl) / nullif(stddev_samp(pnl), 0) AS run_sharpe,
             arg_max(close, pos) / nullif(arg_min(close, pos), 0) AS hold_return,
             avg(dr) / nullif(stddev_samp(dr), 0) AS hold_sharpe, avg(abs(y_pred_val - 0.5) * 2) AS avg_confidence
      FROM lv GROUP BY symbol),
b AS (SELECT *, run_return / nullif(hold_return, 0) AS return_ratio, run_sharpe / nullif(hold_sharpe, 0) AS sharpe_ratio_ratio FROM a)
""" + rsql(["symbol"] + cols, cols, "b")


@register("agg22_run_vs_hold", _agg22_sql())
def q_agg22(spark, sf):
    """AGG-22: ledger strategy vs holding: return and Sharpe ratios, mean confidence."""
    from candela.plans.q_strategy import _ledger
    led = _ledger(spark, sf)
    led = FE.rolling(led, {"dr": lambda w: F.try_divide(F.col("close"), F.lag("close").over(w)) - 1}, back=1)
    led = led.withColumn("ntotal", F.lit(1000.0) + F.col("pnl")).withColumn("conf", F.abs(F.col("y_pred_val") - 0.5) * 2)
    return rounded(AG.run_vs_hold(led, "ntotal", "pnl", "close", "dr", "conf"))


@register("agg23_signal_counts", PNL_D + "\nSELECT symbol, signal, count(*) AS n FROM pnl GROUP BY 1, 2")
def q_agg23(spark, sf):
    return AG.signal_counts(_pnl_d(spark, sf))


@register("agg24_log_trend", DAILY + """,
t AS (SELECT symbol, ln(close) AS y, CAST(row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) AS DOUBLE) AS x FROM bars)
SELECT symbol, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept,
       round(exp(regr_intercept(y, x) + regr_slope(y, x) * max(x)), 6) AS fitted_last FROM t GROUP BY symbol""")
def q_agg24(spark, sf):
    return rounded(AG.log_trend(bars_daily(spark, sf)))


@register("agg25_conditional_product", PNL_D + f"""
SELECT symbol, {S.sig_sql("coalesce(product(CASE WHEN signal = 'Buy' THEN DR END), 1.0)")} AS cond_return FROM pnl GROUP BY symbol""")
def q_agg25(spark, sf):
    return rounded(AG.conditional_product(_pnl_d(spark, sf), "DR", F.col("signal") == "Buy"))


# --- RSK ----------------------------------------------------------------------------------------

RET_SQL = HOURLY + f""",
r0 AS (SELECT symbol, bar_ts, close / nullif(lag(close) OVER w, 0) - 1 AS r FROM bars {W}),
r1 AS (SELECT * FROM r0 WHERE r IS NOT NULL),
mk AS (SELECT bar_ts, avg(r) AS m FROM r1 GROUP BY bar_ts),
rm AS (SELECT r1.*, mk.m FROM r1 LEFT JOIN mk USING (bar_ts))"""


def _returns(spark, sf):
    return RK.with_market(RK.bar_returns(bars_hourly(spark, sf)), "r")


_MO = ["symbol", "n", "mean", "vol", "lpm1", "lpm2", "lpm3", "hpm1", "hpm2", "hpm3", "beta", "beta_standard"]


@register("rsk01_04_moments", RET_SQL + """,
a AS (SELECT symbol, count(r) AS n, avg(r) AS mean, stddev_pop(r) AS vol,
             sum(greatest(-r, 0.0)) / count(r) AS lpm1, sum(pow(greatest(-r, 0.0), 2)) / count(r) AS lpm2,
             sum(pow(greatest(-r, 0.0), 3)) / count(r) AS lpm3, sum(greatest(r, 0.0)) / count(r) AS hpm1,
             sum(pow(greatest(r, 0.0), 2)) / count(r) AS hpm2, sum(pow(greatest(r, 0.0), 3)) / count(r) AS hpm3,
             covar_samp(r, m) / nullif(stddev_pop(m), 0) AS beta, covar_samp(r, m) / nullif(var_samp(m), 0) AS beta_standard
      FROM rm GROUP BY symbol)
""" + rsql(_MO, _MO[2:], "a"))
def q_rsk01(spark, sf):
    return out(RK.moments(_returns(spark, sf), "r", "m"), _MO)


@register("rsk05_06_var_cvar", RET_SQL + """,
o AS (SELECT symbol, r, row_number() OVER (PARTITION BY symbol ORDER BY r) AS rk, count(*) OVER (PARTITION BY symbol) AS n FROM r1),
k AS (SELECT symbol, max(CAST(floor(n * 0.05) AS BIGINT)) AS kk FROM o GROUP BY symbol),
a AS (SELECT o.symbol, abs(max(CASE WHEN rk = kk + 1 THEN r END)) AS var,
             CASE WHEN max(kk) > 0 THEN abs(sum(CASE WHEN rk <= kk THEN r END) / max(kk)) END AS cvar
      FROM o JOIN k USING (symbol) GROUP BY o.symbol)
SELECT symbol, round(var, 6) AS var, round(cvar, 6) AS cvar FROM a""")
def q_rsk05(spark, sf):
    return rounded(RK.var_cvar(RK.bar_returns(bars_hourly(spark, sf)), "r", 0.05))


@register("rsk07_price_path", RET_SQL + """,
p AS (SELECT symbol, bar_ts, 100.0 * (1 + r) AS value, 100.0 * product(1 + r) OVER (PARTITION BY symbol ORDER BY bar_ts
             ROWS UNBOUNDED PRECEDING) AS value_path FROM r1)
""" + rsql(["symbol", "bar_ts", "value", "value_path"], ["value", "value_path"], "p"))
def q_rsk07(spark, sf):
    """RSK-7: values base*(1+r) as coded (not compounded, Q9) and the compounded path."""
    r = RK.bar_returns(bars_hourly(spark, sf))
    a = RK.price_path(r, "r").select("symbol", "bar_ts", "value")
    b = RK.price_path(r, "r", compound=True).select("symbol", "bar_ts", F.col("value").alias("value_path"))
    return rounded(a.join(b, ["symbol", "bar_ts"]))


_TAUS = list(range(0, 21))
DD_SQL = RET_SQL + f""",
v0 AS (SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) AS p, 100.0 * (1 + r) AS value FROM r1
       UNION ALL SELECT DISTINCT symbol, 0 AS p, 100.0 AS value FROM r1),
dd AS (SELECT a.symbol, t.tau, abs(min(a.value / b.value - 1)) AS dd
       FROM v0 a, (SELECT unnest(range(0, {max(_TAUS) + 1})) AS tau) t, v0 b
       WHERE b.symbol = a.symbol AND b.p = a.p - t.tau GROUP BY 1, 2),
pk AS (SELECT symbol, value, greatest(max(value) OVER (PARTITION BY symbol ORDER BY p ROWS UNBOUNDED PRECEDING), 100.0) AS peak
       FROM v0 WHERE p > 0),
ep AS (SELECT symbol, peak, 1 - min(value) / peak AS depth FROM pk GROUP BY 1, 2 HAVING min(value) < peak),
ad AS (SELECT symbol, sum(depth) / 5.0 AS avg_dd, sum(depth * depth) / 5.0 AS avg_dd_sq FROM (
         SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY depth DESC) AS rk FROM ep) WHERE rk <= 5 GROUP BY symbol),
md AS (SELECT symbol, greatest(1 - min(value / greatest(pk, 100.0)), 0.0) AS max_dd FROM (
         SELECT symbol, value, max(value) OVER (PARTITION BY symbol ORDER BY p ROWS UNBOUNDED PRECEDING) AS pk FROM v0 WHERE p > 0)
       GROUP BY symbol)"""


@register("rsk08_drawdown_at", DD_SQL + "\nSELECT symbol, tau, round(dd, 6) AS dd FROM dd")
def q_rsk08(spark, sf):
    vals = RK.price_path(RK.bar_returns(bars_hourly(spark, sf)), "r")
    return rounded(RK.drawdown_at(vals, _TAUS).withColumn("tau", F.col("tau").cast("bigint")))


@register("rsk09_11_drawdowns", DD_SQL + """
SELECT md.symbol, round(max_dd, 6) AS max_dd, round(avg_dd, 6) AS avg_dd, round(avg_dd_sq, 6) AS avg_dd_sq
FROM md LEFT JOIN ad USING (symbol)""")
def q_rsk09(spark, sf):
    vals = RK.price_path(RK.bar_returns(bars_hourly(spark, sf)), "r")
    return rounded(RK.max_drawdown(vals).join(RK.average_drawdown(vals, 5), "symbol", "left"))


_RT = ["symbol", "treynor", "sharpe", "information", "modigliani", "excess_var", "conditional_sharpe", "omega", "sortino",
       "kappa3", "gain_loss", "upside_potential", "calmar", "sterling", "burke"]


@register("rsk12_25_risk_table", DD_SQL + """,
mo AS (SELECT symbol, avg(r) AS mean, stddev_pop(r) AS vol, sum(greatest(-r, 0.0)) / count(r) AS lpm1,
              sum(pow(greatest(-r, 0.0), 2)) / count(r) AS lpm2, sum(pow(greatest(-r, 0.0), 3)) / count(r) AS lpm3,
              sum(greatest(r, 0.0)) / count(r) AS hpm1, covar_samp(r, m) / nullif(stddev_pop(m), 0) AS beta,
              avg(r - m) AS dmean, stddev_pop(r - m) AS dvol, stddev_pop(m) AS mvol FROM rm GROUP BY symbol),
o AS (SELECT symbol, r, row_number() OVER (PARTITION BY symbol ORDER BY r) AS rk, count(*) OVER (PARTITION BY symbol) AS n FROM r1),
kq AS (SELECT symbol, max(CAST(floor(n * 0.05) AS BIGINT)) AS kk FROM o GROUP BY symbol),
vc AS (SELECT o.symbol, abs(max(CASE WHEN rk = kk + 1 THEN r END)) AS var,
              CASE WHEN max(kk) > 0 THEN abs(sum(CASE WHEN rk <= kk THEN r END) / max(kk)) END AS cvar
       FROM o JOIN kq USING (symbol) GROUP BY o.symbol),
t AS (SELECT * FROM mo JOIN vc USING (symbol) JOIN md USING (symbol) LEFT JOIN ad USING (symbol)),
z AS (SELECT symbol, (mean - 0.06) / nullif(beta, 0) AS treynor, (mean - 0.06) / (vol + 1e-15) AS sharpe,
             dmean / nullif(dvol, 0) AS information, (mean - 0.06) * (vol / nullif(mvol, 0)) + 0.06 AS modigliani,
             (mean - 0.06) / nullif(var, 0) AS excess_var, (mean - 0.06) / nullif(cvar, 0) AS conditional_sharpe,
             (mean - 0.06) / nullif(lpm1, 0) AS omega, (mean - 0.06) / (sqrt(lpm2) + 1e-15) AS sortino,
             (mean - 0.06) / nullif(pow(lpm3, 1.0 / 3.0), 0) AS kappa3, hpm1 / nullif(lpm1, 0) AS gain_loss,
             hpm1 / nullif(sqrt(lpm2), 0) AS upside_potential, (mean - 0.06) / nullif(max_dd, 0) AS calmar,
             (mean - 0.06) / nullif(avg_dd, 0) AS sterling, (mean - 0.06) / nullif(sqrt(avg_dd_sq), 0) AS burke FROM t)
""" + rsql(_RT, _RT[1:], "z"))
def q_rsk12(spark, sf):
    return out(RK.risk_table(_returns(spark, sf), "r", "m", 0.06, 0.05, 5), _RT)


# --- JON ----------------------------------------------------------------------------------------

@register("jon01_join_series_ratio", HOURLY + """,
b AS (SELECT bar_ts, close AS close_btc FROM bars WHERE symbol = 'click')
SELECT a.symbol, a.bar_ts, round(b.close_btc, 6) AS close_btc, round(a.close / nullif(b.close_btc, 0), 6) AS ratio
FROM bars a LEFT JOIN b USING (bar_ts)""")
def q_jon01(spark, sf):
    bars = bars_hourly(spark, sf)
    j = JN.price_ratio(JN.join_series(bars, bars.filter(F.col("symbol") == "click"), "_btc"), "close", "close_btc", "ratio")
    return out(j, K + ["close_btc", "ratio"])


_CALENDAR_SQL = """c AS (SELECT DISTINCT CAST(bar_ts AS DATE) AS day FROM bars),
d AS (SELECT day, CAST(day - DATE '1970-01-01' AS BIGINT) % 360 AS deg FROM c)
SELECT b.symbol, b.bar_ts, d.deg, round(sin(2 * pi() * d.deg / 359.0), 6) AS deg_sin FROM bars b JOIN d ON day = CAST(b.bar_ts AS DATE)"""


@register("jon02_join_calendar", DAILY + """,
""" + _CALENDAR_SQL)
def q_jon02(spark, sf):
    bars = bars_daily(spark, sf)
    j = JN.join_calendar(bars, FE.calendar_days(bars))
    return out(FE.with_cyclical(j, "deg", 359), K + ["deg", "deg_sin"])


@register("jon02_join_calendar_hourly", HOURLY + """,
""" + _CALENDAR_SQL)
def q_jon02_hourly(spark, sf):
    """JON-2 on intraday bars: every bar meets its day once."""
    bars = bars_hourly(spark, sf)
    j = JN.join_calendar(bars, FE.calendar_days(bars))
    return out(FE.with_cyclical(j, "deg", 359), K + ["deg", "deg_sin"])


@register("jon04_basket_join", HOURLY + """,
a AS (SELECT bar_ts, close AS close_a FROM bars WHERE symbol = 'view'),
b AS (SELECT bar_ts, close AS close_b FROM bars WHERE symbol = 'purchase')
SELECT a.bar_ts, round(close_a, 6) AS close_a, round(close_b, 6) AS close_b FROM a LEFT JOIN b USING (bar_ts)""")
def q_jon04(spark, sf):
    bars = bars_hourly(spark, sf)
    j = JN.basket_join(bars.filter(F.col("symbol") == "view"), bars.filter(F.col("symbol") == "purchase"), ["close"])
    return rounded(j)


ALT = PRESETS["eth_usd_roc"].with_(roc_period=10, roc_threshold=0.0)


@register("jon05_compare_runs", HOURLY + "," + S.roc_signal_ctes("bars", ROC, "ta") + "," + S.pnl_ctes("ta", ROC, "pa") + ","
          + S.roc_signal_ctes("bars", ALT, "tb") + "," + S.pnl_ctes("tb", ALT, "pb") + """,
j AS (SELECT pa.symbol, pa.bar_ts, pa.SR AS SR_r, pa.DR AS DR_r, pb.SR AS SR_e FROM pa JOIN pb USING (symbol, bar_ts)),
k AS (SELECT symbol, bar_ts, product(SR_r) OVER w AS CSR_r, product(SR_e) OVER w AS CSR_e, product(DR_r) OVER w AS CMR
      FROM j WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts ROWS UNBOUNDED PRECEDING))
""" + rsql(["symbol", "bar_ts", "CSR_r", "CSR_e", "CMR"], ["CSR_r", "CSR_e", "CMR"], "k"))
def q_jon05(spark, sf):
    bars = bars_hourly(spark, sf)
    return out(JN.compare_runs(roc_backtest(bars, ROC, keep_adx=False), roc_backtest(bars, ALT, keep_adx=False)),
               K + ["CSR_r", "CSR_e", "CMR"])


@register("jon06_align_assets", WEEKLY + """,
a AS (SELECT bar_ts FROM bars WHERE close IS NOT NULL GROUP BY bar_ts HAVING count(*) = (SELECT count(DISTINCT symbol) FROM bars))
SELECT bar_ts, symbol, round(close, 6) AS close FROM bars JOIN a USING (bar_ts)""")
def q_jon06(spark, sf):
    """JON-6 over all brands, weekly bars; the columns of the aligned table as rows."""
    bars = bars_weekly(spark, sf)
    names = PF.asset_names(bars)
    wide = JN.align_assets(bars, names, "close")
    cells = F.array(*[F.struct(F.lit(n).alias("symbol"), named(n).alias("close")) for n in names])
    return rounded(wide.select("bar_ts", F.explode(cells).alias("_c")).select("bar_ts", "_c.*"))


@register("jon07_rotate_when", HOURLY + "," + S.roc_signal_ctes("bars", ROC) + """
SELECT b.symbol, b.bar_ts, round(b.close, 6) AS close FROM bars b
WHERE b.symbol = 'view' AND b.bar_ts IN (SELECT bar_ts FROM td WHERE symbol = 'click' AND signal = 'Sell')""")
def q_jon07(spark, sf):
    bars = bars_hourly(spark, sf)
    a = SG.roc_signal(bars, ROC).filter(F.col("symbol") == "click")
    return out(SG.rotate_when(a, bars.filter(F.col("symbol") == "view")), K + ["close"])


def _jon10_sql(timeout: int | None) -> str:
    reach = "b.rn >= e.entry_rn" if timeout is None else f"b.rn BETWEEN e.entry_rn AND e.entry_rn + {timeout}"
    return HOURLY + "," + S.roc_signal_ctes("bars", ROC) + f""",
b AS (SELECT symbol, bar_ts, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) - 1 AS rn, close FROM bars),
s AS (SELECT symbol, bar_ts, signal IS DISTINCT FROM lag(signal) OVER (PARTITION BY symbol ORDER BY bar_ts) AS nw, signal FROM td),
e AS (SELECT b.symbol, b.rn AS entry_rn, b.close * 1.2 AS upper, b.close * 0.8 AS lower FROM s JOIN b USING (symbol, bar_ts)
      WHERE s.nw AND s.signal = 'Buy'),
j AS (SELECT e.symbol, e.entry_rn, b.rn - e.entry_rn AS off, b.close AS px, e.upper, e.lower
      FROM e JOIN b ON b.symbol = e.symbol AND {reach}),
h AS (SELECT symbol, entry_rn, min(CASE WHEN off > 0 AND (px > upper OR px < lower) THEN off END) AS fh, max(off) AS last
      FROM j GROUP BY 1, 2)
SELECT h.symbol, h.entry_rn, coalesce(fh, last) AS bars_held, round(j.px, 6) AS exit_price
FROM h JOIN j ON j.symbol = h.symbol AND j.entry_rn = h.entry_rn AND j.off = coalesce(fh, last)"""


def _jon10(spark, sf, timeout):
    bars = FE.ensure_indexed(bars_hourly(spark, sf))
    td = FE.rolling(SG.roc_signal(bars, ROC), {"_nw": lambda w: ~F.col("signal").eqNullSafe(F.lag("signal").over(w))}, back=1)
    entries = td.filter(F.col("_nw") & (F.col("signal") == "Buy")).select(
        "symbol", F.col("bar_ts").alias("entry_ts"), (F.col("close") * 1.2).alias("upper"), (F.col("close") * 0.8).alias("lower"))
    res = JN.bracket_exit(entries, bars, timeout).drop("upper", "lower", "entry_ts")
    return rounded(res.withColumn("bars_held", F.col("bars_held").cast("bigint")))


@register("jon10_bracket_exit", _jon10_sql(12))
def q_jon10(spark, sf):
    """JON-10: +/-20 % bracket with a 12-bar time-out on every new Buy of the ROC rule."""
    return _jon10(spark, sf, 12)


@register("jon10_bracket_exit_open", _jon10_sql(None))
def q_jon10_open(spark, sf):
    """JON-10: +/-20 % bracket without a time-out on every new Buy of the ROC rule."""
    return _jon10(spark, sf, None)
