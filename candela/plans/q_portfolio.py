"""Registered queries for §2.11 (PRT, SWP) and TOP-1."""

from __future__ import annotations

from pyspark.sql import functions as F

from candela.config import PRESETS
from candela.operators import indicators as IN
from candela.operators import portfolio as PF
from candela.operators import signals as SG
from candela.operators import timeseries as TS
from candela.plans import sqlparts as S
from candela.plans.catalog import HOURLY, WEEKLY, register, rounded, rsql
from candela.sources.fixtures import bars_hourly, bars_weekly

ROC = PRESETS["eth_usd_roc"]
N_PORTFOLIOS = 5000
SWEEP_GRID = PF.param_grid(period=[5, 10, 17, 30], threshold=[-5.0, 0.0, 5.0], delay=[0, 1, 2])
ADR_PERIODS = [5, 10, 20, 40]


# --- PRT-1 ----------------------------------------------------------------------------------------

_BASKET = ["bar_ts", "buy_signals", "DR", "SR", "CSR", "CMR"]


@register("prt01_signal_basket", HOURLY + "," + S.roc_signal_ctes("bars", ROC) + """,
g AS (SELECT bar_ts, count(*) AS n, sum(y_pred_val) AS buy_signals, avg(DR) AS DR,
             sum(CASE WHEN y_pred_val = 1 THEN DR END) AS sel FROM td WHERE DR IS NOT NULL GROUP BY bar_ts HAVING count(*) = 5),
h AS (SELECT bar_ts, buy_signals, DR, CASE WHEN buy_signals > 0 THEN sel / buy_signals ELSE 1.0 END AS SR FROM g),
k AS (SELECT *, product(SR) OVER (ORDER BY bar_ts ROWS UNBOUNDED PRECEDING) AS CSR,
              product(DR) OVER (ORDER BY bar_ts ROWS UNBOUNDED PRECEDING) AS CMR FROM h)
""" + rsql(_BASKET, ["buy_signals", "DR", "SR", "CSR", "CMR"], "k"))
def q_prt01(spark, sf):
    td = SG.roc_signal(bars_hourly(spark, sf), ROC).select("symbol", "bar_ts", "y_pred_val", "DR")
    return rounded(PF.signal_basket(td, 5).select(*_BASKET))


# --- PRT-2..5: all brands, weekly bars ------------------------------------------------------------

_BMS = """CASE WHEN isodow(date_trunc('month', {x})) = 6 THEN CAST(date_trunc('month', {x}) AS DATE) + 2
               WHEN isodow(date_trunc('month', {x})) = 7 THEN CAST(date_trunc('month', {x}) AS DATE) + 1
               ELSE CAST(date_trunc('month', {x}) AS DATE) END"""
_MONTH_START = f"CASE WHEN CAST(bar_ts AS DATE) < {_BMS.format(x='bar_ts')} THEN {_BMS.format(x='(bar_ts - INTERVAL 1 MONTH)')} ELSE {_BMS.format(x='bar_ts')} END"
_CHANGE = "list_transform(range(1, len(c) + 1), lambda i: c[i] / nullif(p[i], 0) - 1)"
_WHOLE = "r IS NOT NULL AND len(list_filter(r, lambda x: x IS NULL)) = 0"
# the multipliers of the weights: square roots of the first primes, as many as there are brands
_ROOTS = """roots AS (SELECT list(sqrt(x) ORDER BY x)[1:(SELECT count(DISTINCT symbol) FROM bars)] AS q FROM range(2, 2000) t(x)
           WHERE NOT EXISTS (SELECT 1 FROM range(2, 45) u(y) WHERE y < x AND x % y = 0))"""
MPT_SQL = WEEKLY + f""",
al AS (SELECT bar_ts, list(close ORDER BY symbol) AS c FROM bars GROUP BY bar_ts HAVING count(*) = (SELECT count(DISTINCT symbol) FROM bars)),
daily AS (SELECT bar_ts, r FROM (SELECT bar_ts, {_CHANGE} AS r FROM (SELECT *, lag(c) OVER (ORDER BY bar_ts) AS p FROM al) WHERE p IS NOT NULL) WHERE {_WHOLE}),
pt AS (SELECT strftime(bar_ts, '%Y-%m') AS month, bar_ts, i, r[i] AS x FROM daily, range(1, (SELECT count(DISTINCT symbol) FROM bars) + 1) t(i)),
cl AS (SELECT a.month, a.i, b.i AS j, covar_samp(a.x, b.x) AS cov FROM pt a JOIN pt b USING (month, bar_ts) GROUP BY 1, 2, 3),
cov AS (SELECT month, list(row ORDER BY i) AS m FROM (SELECT month, i, list(cov ORDER BY j) AS row FROM cl GROUP BY 1, 2) GROUP BY month),
mp AS (SELECT {_MONTH_START} AS month_start, arg_min(c, bar_ts) AS c FROM al GROUP BY 1),
mw AS (SELECT strftime(month_start, '%Y-%m') AS month, r FROM (SELECT month_start, {_CHANGE} AS r FROM
       (SELECT *, lag(c) OVER (ORDER BY month_start) AS p FROM mp) WHERE p IS NOT NULL) WHERE {_WHOLE}),
{_ROOTS},
pf0 AS (SELECT mw.month, r, m, k, list_transform(q, lambda x: (k + 1) * x - floor((k + 1) * x)) AS f
        FROM mw JOIN cov USING (month), roots, range(0, {N_PORTFOLIOS}) t(k) WHERE m[1][1] IS NOT NULL),
pf1 AS (SELECT month, r, m, k AS portfolio, list_transform(f, lambda x: x / list_sum(f)) AS w FROM pf0),
pf AS (SELECT month, portfolio, w, list_dot_product(w, r) AS ret,
              sqrt(greatest(list_dot_product(w, list_transform(m, lambda row: list_dot_product(row, w))), 0)) AS vol FROM pf1),
best AS (SELECT month, arg_max(portfolio, (ret / nullif(vol, 0), -portfolio)) AS portfolio FROM pf GROUP BY month),
bestw AS (SELECT pf.*, ret / nullif(vol, 0) AS best_sharpe FROM pf JOIN best USING (month, portfolio))"""
_PF = ["month", "portfolio", "w_first", "w_last", "w_mean_rank", "ret", "vol"]
_W_SQL = "SELECT *, w[1] AS w_first, w[-1] AS w_last, list_dot_product(w, list_transform(range(1, len(w) + 1), lambda i: CAST(i AS DOUBLE))) AS w_mean_rank FROM"


def _mpt(spark, sf):
    bars = bars_weekly(spark, sf)
    names = PF.asset_names(bars)
    daily, monthly, cov = PF.aligned_monthly(bars, names)
    cov = cov.filter(F.get(F.get("tri", F.lit(0)), F.lit(0)).isNotNull())
    return daily, monthly, PF.random_portfolios(monthly, cov, len(names), N_PORTFOLIOS), names


def _weights(df):
    """Three figures that depend on all weights stand for the list."""
    rank = F.aggregate(F.transform("weights", lambda w, i: w * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return df.withColumns({"portfolio": F.col("portfolio").cast("bigint"), "w_first": F.element_at("weights", 1), "w_last": F.element_at("weights", -1), "w_mean_rank": rank})


@register("prt02_random_portfolios", MPT_SQL + f",\npw AS ({_W_SQL} pf)\n" + rsql(_PF, _PF[2:], "pw"))
def q_prt02(spark, sf):
    """PRT-2 over all brands."""
    return rounded(_weights(_mpt(spark, sf)[2]).select(*_PF))


@register("prt03_best_sharpe", MPT_SQL + f",\npw AS ({_W_SQL} bestw)\n" + rsql(_PF + ["best_sharpe"], _PF[2:] + ["best_sharpe"], "pw"))
def q_prt03(spark, sf):
    """PRT-3 over all brands."""
    return rounded(_weights(PF.best_sharpe(_mpt(spark, sf)[2])).select(*_PF, F.col("sharpe").alias("best_sharpe")))


@register("prt05_realised_vs_benchmark", MPT_SQL + """,
pw AS (SELECT month, lag(w) OVER (ORDER BY month) AS w FROM bestw),
rv AS (SELECT mw.month, list_dot_product(pw.w, r) AS realised, list_sum(r) / len(r) AS bench_r FROM mw JOIN pw USING (month) WHERE pw.w IS NOT NULL),
acc AS (SELECT month, realised, bench_r, 1000.0 * product(1 + realised) OVER (ORDER BY month ROWS UNBOUNDED PRECEDING) AS account,
               1000.0 * product(1 + bench_r) OVER (ORDER BY month ROWS UNBOUNDED PRECEDING) AS benchmark FROM rv)
""" + rsql(["month", "realised", "bench_r", "account", "benchmark"], ["realised", "bench_r", "account", "benchmark"], "acc"))
def q_prt05(spark, sf):
    """PRT-5: last month's best weights held this month, over all brands."""
    _, monthly, pf, _ = _mpt(spark, sf)
    best = PF.best_sharpe(pf).withColumn("_m", F.to_date(F.concat(F.col("month"), F.lit("-01")))).withColumn("book", F.lit("b"))
    prev = TS.shift_monthly(best, ["weights"], ["book"], "_m").select("month", F.col("weights_prev").alias("weights"))
    return rounded(PF.realised_vs_benchmark(monthly, prev.filter(F.col("weights").isNotNull()), 1000.0))


_FT = ["month", "portfolio", "ret", "vol", "best_sharpe", "symbol", "ewma_prev", "weight"]


@register("prt04_features_targets", MPT_SQL + f""",
lp AS (SELECT i, x AS r, bar_ts, row_number() OVER (PARTITION BY i ORDER BY bar_ts) - 1 AS pos FROM pt),
ew AS (SELECT a.i, a.bar_ts, sum(pow(1 - 2 / 31.0, a.pos - b.pos) * b.r) / sum(pow(1 - 2 / 31.0, a.pos - b.pos)) AS ewma
       FROM lp a JOIN lp b ON a.i = b.i AND b.pos <= a.pos GROUP BY 1, 2),
mb AS (SELECT i, {_MONTH_START} AS month_start, arg_min(ewma, bar_ts) AS ewma FROM ew GROUP BY 1, 2),
sh AS (SELECT i, month_start, lag(ewma) OVER (PARTITION BY i ORDER BY month_start) AS ewma_prev FROM mb),
nm AS (SELECT symbol, row_number() OVER (ORDER BY symbol) AS i FROM (SELECT DISTINCT symbol FROM bars)),
ft AS (SELECT month, portfolio, ret, vol, best_sharpe, symbol, ewma_prev, w[i] AS weight FROM sh JOIN nm USING (i) JOIN bestw ON bestw.month = strftime(month_start, '%Y-%m')
       WHERE ewma_prev IS NOT NULL)
""" + rsql(_FT, [c for c in _FT if c not in ("month", "portfolio", "symbol")], "ft"))
def q_prt04(spark, sf):
    """PRT-4: EWMA(30) of the bar returns, first value per business-month bin, shifted one month, joined with that month's
    best-Sharpe weights; one row per month and brand."""
    daily, _, pf, names = _mpt(spark, sf)
    labels = F.array(*[F.lit(x) for x in names])
    lng = daily.select("bar_ts", F.posexplode("r").alias("_i", "r")).withColumn("symbol", F.get(labels, F.col("_i")))
    mb = TS.month_bins_first(IN.ewma(lng.select("symbol", "bar_ts", "r"), "r", 30, "ewma"), "ewma")
    feats = TS.shift_monthly(mb, ["ewma"]).filter(F.col("ewma_prev").isNotNull()).select(F.date_format("month_start", "yyyy-MM").alias("month"), "symbol", "ewma_prev")
    best = PF.best_sharpe(pf).withColumn("portfolio", F.col("portfolio").cast("bigint")).withColumnRenamed("sharpe", "best_sharpe")
    weight = F.element_at("weights", F.array_position(labels, F.col("symbol")).cast("int"))
    return rounded(PF.features_targets(feats, best).withColumn("weight", weight).select(*_FT))


# --- SWP-1 / TOP-1 ------------------------------------------------------------------------------

def _sweep_sql() -> str:
    vals = ", ".join(f"({i}, {p['period']}, {S.f(p['threshold'])}, {p['delay']})" for i, p in enumerate(SWEEP_GRID))
    return HOURLY + f""",
params AS (SELECT * FROM (VALUES {vals}) p(param_id, period, threshold, delay)),
b AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) - 1 AS pos FROM bars),
x AS (SELECT b.symbol AS base_symbol, b.symbol || '|' || CAST(p.param_id AS VARCHAR) AS symbol, b.bar_ts, b.pos,
             b.open, b.high, b.low, b.close, b.volume, p.period, p.threshold, p.delay FROM b, params p),
x1 AS (SELECT x.*, pr.close AS prev FROM x LEFT JOIN b pr ON pr.symbol = x.base_symbol AND pr.pos = x.pos - x.period),
x2 AS (SELECT *, CASE WHEN prev IS NULL THEN NULL WHEN prev = 0 THEN 0.0 ELSE 100.0 * (close / prev - 1) END AS ROC FROM x1),
x3 AS (SELECT *, CASE WHEN ROC > threshold THEN 1.0 ELSE 0.0 END AS raw FROM x2),
x4 AS (SELECT a.*, s.raw AS y_pred_val FROM x3 a LEFT JOIN x3 s ON s.symbol = a.symbol AND s.pos = a.pos - (a.delay + 1)),
x5 AS (SELECT *, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY bar_ts), 0) AS DR FROM x4),
c AS (SELECT symbol, bar_ts, open, high, low, close, volume, DR, ROC, y_pred_val,
             coalesce(y_pred_val >= {S.f(ROC.signal_threshold)}, false) AS y_pred,
             CAST(trunc(y_pred_val * {S.f(ROC.signal_scale)}) AS BIGINT) AS y_pred_id,
             CASE WHEN coalesce(y_pred_val >= {S.f(ROC.signal_threshold)}, false) THEN 'Buy' ELSE 'Sell' END AS signal
      FROM x5 WHERE y_pred_val IS NOT NULL AND DR IS NOT NULL AND ROC IS NOT NULL),
{S.indexed("c", "td")},""" + S.pnl_ctes("td", ROC) + """,
res AS (SELECT split_part(symbol, '|', 1) AS sym, CAST(split_part(symbol, '|', 2) AS INT) AS param_id,
               arg_max(CSR, pos) AS CSR FROM pnl GROUP BY pnl.symbol),
sweep AS (SELECT sym AS symbol, param_id, CSR, -CSR AS loss FROM res)"""


SWEEP_SQL = _sweep_sql()


def _sweep(spark, sf):
    return PF.roc_sweep(bars_hourly(spark, sf), SWEEP_GRID, ROC)


@register("swp01_roc_sweep", SWEEP_SQL + "\n" + rsql(["symbol", "param_id", "CSR", "loss"], ["CSR", "loss"], "sweep"))
def q_swp01(spark, sf):
    return rounded(_sweep(spark, sf))


@register("swp01_basket_sweep", SWEEP_SQL.replace("res AS (SELECT split_part", """bk AS (
  SELECT CAST(split_part(symbol, '|', 2) AS INT) AS param_id, bar_ts, count(*) AS n, sum(y_pred_val) AS buys, avg(DR) AS DR,
         sum(CASE WHEN y_pred_val = 1 THEN DR END) AS sel FROM c WHERE DR IS NOT NULL GROUP BY 1, 2 HAVING count(*) = 5),
bs AS (SELECT param_id, product(CASE WHEN buys > 0 THEN sel / buys ELSE 1.0 END) AS CSR, product(DR) AS CMR, count(*) AS n_bars FROM bk GROUP BY 1),
basket AS (SELECT *, -CSR AS loss FROM bs),
res AS (SELECT split_part""", 1) + "\n" + rsql(["param_id", "CSR", "CMR", "n_bars", "loss"], ["CSR", "CMR", "loss"], "basket"))
def q_swp01_basket(spark, sf):
    """SWP-1 maximising the return of the basket of all five symbols."""
    return rounded(PF.basket_sweep(bars_hourly(spark, sf), SWEEP_GRID, ROC, 5))


@register("top01_running_best", SWEEP_SQL + """,
rb AS (SELECT *, min(loss) OVER (PARTITION BY symbol ORDER BY param_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_best
       FROM sweep)
""" + rsql(["symbol", "param_id", "CSR", "loss"], ["CSR", "loss"], "rb") + " WHERE prev_best IS NULL OR loss < prev_best")
def q_top01(spark, sf):
    return rounded(TS.running_best(_sweep(spark, sf), "loss", "param_id"))


def _adr_sql(params: list[tuple[int, int | None]]) -> str:
    """``params``: (averaging period, ROC period or None for the rule on the average alone)."""
    parts = []
    for i, (n, m) in enumerate(params):
        roc = "1.0" if m is None else (f"CASE WHEN lag(close, {m}) OVER (w) IS NULL THEN NULL WHEN lag(close, {m}) OVER (w) = 0 THEN 0.0 "
                                       f"ELSE 100.0 * (close / lag(close, {m}) OVER (w) - 1) END")
        parts.append(f"""SELECT symbol || '|' || '{i}' AS symbol, bar_ts, open, high, low, close, volume, DR, pos,
               CASE WHEN pos >= {n} THEN {S.full_avg('DR', n)} END AS ADR, {roc.replace("OVER (w)", "OVER (w )")} AS ROC FROM d""")
    return HOURLY + f""",
d AS (SELECT *, close / nullif(lag(close) OVER w, 0) AS DR, row_number() OVER w - 1 AS pos FROM bars
      WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts)),
e AS ({' UNION ALL '.join(p.replace('OVER (w ', 'OVER (PARTITION BY symbol ORDER BY bar_ts ') for p in parts)}),
f AS (SELECT *, lag(CASE WHEN ADR > 1 AND ROC > 0 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY symbol ORDER BY bar_ts) AS y_pred_val FROM e),
c AS (SELECT symbol, bar_ts, open, high, low, close, volume, y_pred_val,
             coalesce(y_pred_val >= {S.f(ROC.signal_threshold)}, false) AS y_pred,
             CAST(trunc(y_pred_val * {S.f(ROC.signal_scale)}) AS BIGINT) AS y_pred_id,
             CASE WHEN coalesce(y_pred_val >= {S.f(ROC.signal_threshold)}, false) THEN 'Buy' ELSE 'Sell' END AS signal
      FROM f WHERE y_pred_val IS NOT NULL AND DR IS NOT NULL AND ADR IS NOT NULL AND ROC IS NOT NULL),
{S.indexed("c", "td")},""" + S.pnl_ctes("td", ROC) + """,
res AS (SELECT split_part(symbol, '|', 1) AS sym, CAST(split_part(symbol, '|', 2) AS INT) AS param_id,
               arg_max(CSR, pos) AS CSR FROM pnl GROUP BY pnl.symbol)
SELECT sym AS symbol, param_id, """ + S.sig_sql("CSR") + " AS CSR, " + S.sig_sql("-CSR") + " AS loss FROM res"


ADX_PERIODS = list(range(2, 11))
BAND = ROC.with_(adjust_signal=True, adx_lo_threshold=25.0, adx_hi_threshold=75.0, asr_threshold=0.99)


def _adx_sql() -> str:
    head = HOURLY + "," + S.roc_signal_ctes("bars", BAND)
    parts = ", ".join(S.pnl_ctes("td", BAND.with_(adx_period=n), f"p{n}").strip() for n in ADX_PERIODS)
    res = " UNION ALL ".join(f"SELECT symbol, {i} AS param_id, arg_max(CSR, pos) AS CSR FROM p{n} GROUP BY symbol" for i, n in enumerate(ADX_PERIODS))
    return f"{head}, {parts}, res AS ({res}) SELECT symbol, param_id, " + S.sig_sql("CSR") + " AS CSR, " + S.sig_sql("-CSR") + " AS loss FROM res"


@register("swp02_adx_sweep", _adx_sql())
def q_swp02_adx(spark, sf):
    """SWP-2 over the ADX period 2..10 with the risk-off band on ADX and on the average strategy return."""
    return rounded(PF.adx_sweep(bars_hourly(spark, sf), ADX_PERIODS, BAND))


ADR_ROC_GRID = PF.param_grid(adr_period=[2, 10, 30], roc_period=[3, 17])


@register("swp02_adr_roc_sweep", _adr_sql([(p["adr_period"], p["roc_period"]) for p in ADR_ROC_GRID]))
def q_swp02_adr_roc(spark, sf):
    """SWP-2 over averaging period and ROC period: buy while both rules agree."""
    return rounded(PF.adr_roc_sweep(bars_hourly(spark, sf), ADR_ROC_GRID, ROC))


@register("swp02_adr_sweep", _adr_sql([(n, None) for n in ADR_PERIODS]))
def q_swp02(spark, sf):
    return rounded(PF.adr_sweep(bars_hourly(spark, sf), ADR_PERIODS, ROC))
