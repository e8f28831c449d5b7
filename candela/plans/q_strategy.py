"""Registered queries for §2.6 (SIG) and §2.7 (PNL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from candela.config import PRESETS, StrategyConfig
from candela.operators import features as FE
from candela.operators import indicators as IN
from candela.operators import pnl as PN
from candela.operators import signals as SG
from candela.plans import sqlparts as S
from candela.plans.catalog import DAILY, HOURLY, PNL_COLS, PNL_DBL, RESULT_SQL, register, rounded, rsql
from candela.plans.strategies import final_returns, roc_backtest
from candela.sources.fixtures import bars_daily, bars_hourly

W = "WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts)"
K = ["symbol", "bar_ts"]
ROC = PRESETS["eth_usd_roc"]


def out(df, cols):
    return rounded(df.select(*cols))


# --- SIG ----------------------------------------------------------------------------------------

_TD = ["symbol", "bar_ts", "DR", "ROC", "y_pred_val", "y_pred", "y_pred_id", "signal"]


@register("sig01_05_roc_signal_frame", HOURLY + "," + S.roc_signal_ctes("bars", ROC) + "\n"
          + rsql(_TD, ["DR", "ROC", "y_pred_val"], "td"))
def q_sig01(spark, sf):
    return out(SG.roc_signal(bars_hourly(spark, sf), ROC), _TD)


MASK = StrategyConfig(signal_scale=10, ignore_signals=(5,), hold_signals=(3,))


@register("sig04_mask_signals", HOURLY + f""",
a AS (SELECT symbol, bar_ts, CASE WHEN lag(close, 10) OVER w IS NULL THEN NULL WHEN lag(close, 10) OVER w = 0 THEN 0.0
             ELSE 100.0 * (close / lag(close, 10) OVER w - 1) END AS ROC FROM bars {W}),
b AS (SELECT symbol, bar_ts, 0.5 + ROC / 100.0 AS score FROM a WHERE ROC IS NOT NULL),
c AS (SELECT *, CAST(trunc(score * 10.0) AS BIGINT) AS y_pred_id FROM b),
d AS (SELECT *, CASE WHEN y_pred_id NOT IN (5) THEN CASE WHEN score >= 0.5 THEN 'Buy' ELSE 'Sell' END END AS s0 FROM c),
e AS (SELECT *, last_value(s0 IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS s1 FROM d {W})
SELECT symbol, bar_ts, round(score, 6) AS score, y_pred_id, CASE WHEN y_pred_id IN (3) THEN 'Cash' ELSE s1 END AS signal FROM e""")
def q_sig04(spark, sf):
    d = FE.rolling(bars_hourly(spark, sf), {"ROC": FE.e_roc(10)}, back=10).withColumn("score", 0.5 + F.col("ROC") / 100.0)
    return out(SG.gen_signal(d, MASK, score="score"), K + ["score", "y_pred_id", "signal"])


def _pos(src, name="b"):
    return f"{name} AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) - 1 AS pos FROM {src})"


@register("sig06_rule_signal", HOURLY + ",\n" + _pos("bars") + "," + S.rsi_ctes("b", 14, "RSI", "r14") + f""",
z AS (SELECT symbol, bar_ts, RSI, CASE WHEN lag(close, 10) OVER w IS NULL THEN NULL WHEN lag(close, 10) OVER w = 0 THEN 0.0
             ELSE 100.0 * (close / lag(close, 10) OVER w - 1) END AS ROC,
             {S.full_avg('close', 10)} AS MA1, {S.full_avg('close', 30)} AS MA2 FROM r14 {W})
SELECT symbol, bar_ts, CASE WHEN RSI > 50.0 AND ROC > 0.0 AND MA1 >= MA2 THEN 1.0 ELSE 0.0 END AS rule FROM z""")
def q_sig06(spark, sf):
    d = IN.rsi(bars_hourly(spark, sf), 14)
    d = FE.rolling(d, {"ROC": FE.e_roc(10), "MA1": FE.e_sma("close", 10), "MA2": FE.e_sma("close", 30)}, back=30)
    return out(d.withColumn("rule", SG.rule_signal("RSI", "ROC", "MA1", "MA2", 50.0, 0.0)), K + ["rule"])


ENS = PRESETS["eth_usd_ens"].with_(position_sizing=True)
MEMBERS = [PRESETS["eth_usd_roc"].with_(roc_period=10), PRESETS["eth_usd_roc"],
           PRESETS["eth_usd_roc"].with_(roc_period=24, roc_threshold=0.0, signal_delay=2)]


def _ens_sql():
    parts = [S.roc_signal_ctes("bars", m, f"m{i}") for i, m in enumerate(MEMBERS)]
    return DAILY + "," + ",".join(parts) + f""",
e0 AS (SELECT m0.symbol, m0.bar_ts, b.open, b.high, b.low, b.close,
              ((CASE WHEN m0.signal = 'Buy' THEN 1.0 ELSE 0.0 END) + (CASE WHEN m1.signal = 'Buy' THEN 1.0 ELSE 0.0 END)
               + (CASE WHEN m2.signal = 'Buy' THEN 1.0 ELSE 0.0 END)) / 3.0 AS y_pred_val
       FROM m0 JOIN m1 ON m0.symbol = m1.symbol AND m0.bar_ts = m1.bar_ts
               JOIN m2 ON m0.symbol = m2.symbol AND m0.bar_ts = m2.bar_ts
               JOIN bars b ON b.symbol = m0.symbol AND b.bar_ts = m0.bar_ts),
e1 AS (SELECT *, y_pred_val >= {S.f(ENS.signal_threshold)} AS y_pred,
              CAST(trunc(y_pred_val * {S.f(ENS.signal_scale)}) AS BIGINT) AS y_pred_id,
              CASE WHEN y_pred_val >= {S.f(ENS.signal_threshold)} THEN 'Buy' ELSE 'Sell' END AS signal, y_pred_val AS size FROM e0),
{S.indexed("e1", "ens")},""" + S.pnl_ctes("ens", ENS) + RESULT_SQL


@register("sig07_ensemble_result", _ens_sql())
def q_sig07(spark, sf):
    bars = bars_daily(spark, sf)
    members = None
    for i, m in enumerate(MEMBERS):
        td = SG.roc_signal(bars, m).select("symbol", "bar_ts", F.lit(f"m{i}").alias("model"), "signal")
        members = td if members is None else members.unionByName(td)
    ens = SG.ensemble_signal(members, ENS, len(MEMBERS))
    td = ens.join(bars, ["symbol", "bar_ts"])
    return rounded(final_returns(PN.run_pnl(td, ENS, keep_adx=False)))


ADJ = PRESETS["eth_usd_roc"].with_(adjust_signal=True, adx_lo_threshold=20.0, adx_hi_threshold=60.0,
                                   asr_threshold=0.999, asr_period=10)


@register("sig08_adjust_signal", HOURLY + "," + S.roc_signal_ctes("bars", ADJ) + "," + S.pnl_ctes("td", ADJ) + "\n"
          + rsql(PNL_COLS + ["ASR"], PNL_DBL + ["ASR"], "pnl"))
def q_sig08(spark, sf):
    return out(roc_backtest(bars_hourly(spark, sf), ADJ), PNL_COLS + ["ASR"])


@register("sig09_breakout_position", HOURLY + f""",
a AS (SELECT symbol, bar_ts, close,
             CASE WHEN count(close) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) >= 5
                  THEN max(close) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) END AS ch_high,
             CASE WHEN count(close) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) >= 5
                  THEN min(close) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) END AS ch_low FROM bars {W}),
b AS (SELECT *, last_value(CASE WHEN close > ch_high THEN 1.0 WHEN close < ch_low THEN -1.0 END IGNORE NULLS)
                  OVER (w ROWS UNBOUNDED PRECEDING) AS position FROM a {W}),
c AS (SELECT *, ln(close / nullif(lag(close) OVER w, 0)) * lag(position) OVER w AS strat_log_ret FROM b {W})
SELECT symbol, bar_ts, position, round(strat_log_ret, 6) AS strat_log_ret,
       round(sum(strat_log_ret) OVER (w ROWS UNBOUNDED PRECEDING), 6) AS cum_log_ret FROM c {W}""")
def q_sig09(spark, sf):
    d = PN.breakout_returns(SG.breakout_position(bars_hourly(spark, sf), 5))
    return out(d, K + ["position", "strat_log_ret", "cum_log_ret"])


@register("sig10_today_action", HOURLY + "," + S.roc_signal_ctes("bars", ROC) + """,
l AS (SELECT symbol, bar_ts, y_pred_val AS cur, lag(y_pred_val) OVER (PARTITION BY symbol ORDER BY pos) AS prev, pos FROM td),
m AS (SELECT symbol, arg_max(bar_ts, pos) AS bar_ts, arg_max(cur, pos) AS cur, arg_max(prev, pos) AS prev FROM l GROUP BY symbol)
SELECT symbol, bar_ts, cur, prev, CASE WHEN cur IS DISTINCT FROM prev AND cur > 0 THEN 'BUY'
                                       WHEN cur IS DISTINCT FROM prev THEN 'SELL' ELSE 'HOLD' END AS action FROM m""")
def q_sig10(spark, sf):
    td = SG.roc_signal(bars_hourly(spark, sf), ROC)
    return out(SG.today_action(td, "y_pred_val"), ["symbol", "bar_ts", "cur", "prev", "action"])


_LATEST = ["symbol", "bar_ts", "date_to", "new_trade", "signal", "open", "close", "CSR", "sl", "sl_price", "tp",
           "tp_price", "pnl", "text"]


def _trunc_sql(x, d=2):
    sc = float(10 ** d)
    return f"(CASE WHEN {x} * {sc} >= 0 THEN floor({x} * {sc}) ELSE ceil({x} * {sc}) END / {sc})"


@register("sig11_latest_signal_text", HOURLY + "," + S.roc_signal_ctes("bars", ROC) + "," + S.pnl_ctes("td", ROC) + f""",
l AS (SELECT symbol, arg_max(bar_ts, pos) AS bar_ts, arg_max(date_to, pos) AS date_to, arg_max(new_trade, pos) AS new_trade,
             arg_max(signal, pos) AS signal, arg_max(open, pos) AS open, arg_max(close, pos) AS close, arg_max(CSR, pos) AS CSR,
             arg_max(sl, pos) AS sl, arg_max(sl_price, pos) AS sl_price, arg_max(tp, pos) AS tp, arg_max(tp_price, pos) AS tp_price
      FROM pnl GROUP BY symbol),
m AS (SELECT * REPLACE ({_trunc_sql('sl_price')} AS sl_price, {_trunc_sql('tp_price')} AS tp_price),
             round(100.0 * (CSR - 1), 2) AS pnl FROM l)
SELECT symbol, bar_ts, date_to, new_trade, signal, round(open, 6) AS open, round(close, 6) AS close, """ + S.sig_sql("CSR") + """ AS CSR,
       sl, round(sl_price, 6) AS sl_price, tp, round(tp_price, 6) AS tp_price, round(pnl, 6) AS pnl,
       symbol || ':' || CASE WHEN new_trade THEN ' NEW' ELSE ' Same' END || ' Signal: ' || signal
       || CASE WHEN new_trade THEN ', Open: ' || CAST(open AS VARCHAR) ELSE '' END
       || ', Total PnL: ' || coalesce(CAST(TRY_CAST(pnl AS DECIMAL(38, 2)) AS VARCHAR), CAST(pnl AS VARCHAR)) || '%'
       || CASE WHEN tp THEN ' TAKE PROFIT!' ELSE '' END || CASE WHEN sl THEN ' STOP LOSS!' ELSE '' END AS text FROM m""")
def q_sig11(spark, sf):
    pnl = roc_backtest(bars_hourly(spark, sf), ROC, keep_adx=False)
    return out(SG.signal_text(SG.latest_signal(pnl, ROC)), _LATEST)


def _state_frame(spark, sf):
    d = FE.base_features(bars_hourly(spark, sf))
    d = FE.rolling(d, {"next_ret": lambda w: F.lead("DR", 1).over(w)}, back=0, fwd=1)
    d = FE.chrono_split(FE.drop_warmup(d, ["MA", "STD", "WR", "VOL", "next_ret"]), 0.8, 0.2)
    return SG.state_id(d, ["MA", "STD", "WR", "VOL"], bins=3, train_col="is_train")


_SFEATS = ["MA", "STD", "WR", "VOL"]


def _state_sql() -> str:
    wr = (f"CASE WHEN {S.full_agg('max', 'high', 7)} IS NULL OR {S.full_agg('min', 'low', 7)} IS NULL THEN NULL "
          f"WHEN {S.full_agg('max', 'high', 7)} = {S.full_agg('min', 'low', 7)} THEN 0.0 "
          f"ELSE -100.0 * ({S.full_agg('max', 'high', 7)} - close) / ({S.full_agg('max', 'high', 7)} - {S.full_agg('min', 'low', 7)}) END")
    stk = " UNION ALL ".join(f"SELECT symbol, '{f}' AS feature, {f} AS v FROM h WHERE is_train" for f in _SFEATS)
    digits = ", ".join(f"(SELECT count(*) FROM edges e WHERE e.symbol = h.symbol AND e.feature = '{f}' AND e.v < h.{f}) AS d_{f}"
                       for f in _SFEATS)
    sid = "0"
    for f in _SFEATS:
        sid = f"({sid}) * 3 + d_{f}"
    return HOURLY + f""",
t AS (SELECT symbol, bar_ts, close / nullif(lag(close) OVER w, 0) AS DR, close / nullif({S.full_avg('close', 50)}, 0) AS MA,
             {S.full_agg('stddev_samp', 'close', 7)} / nullif(close, 0) AS STD, volume / nullif({S.full_avg('volume', 30)}, 0) AS VOL,
             {wr} AS WR FROM bars {W}),
t2 AS (SELECT *, lead(DR) OVER w AS next_ret FROM t {W}),
f AS (SELECT * FROM t2 WHERE MA IS NOT NULL AND STD IS NOT NULL AND WR IS NOT NULL AND VOL IS NOT NULL AND next_ret IS NOT NULL),
g AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) - 1 AS p, count(*) OVER (PARTITION BY symbol) AS n FROM f),
h AS (SELECT *, p < floor(n * 0.8) AS is_train FROM g),
stk AS ({stk}),
rk AS (SELECT symbol, feature, v, row_number() OVER (PARTITION BY symbol, feature ORDER BY v) AS r,
              count(*) OVER (PARTITION BY symbol, feature) AS nn FROM stk),
edges AS (SELECT rk.symbol, rk.feature, ed.edge, rk.v FROM rk JOIN (VALUES (1), (2)) ed(edge)
          ON rk.r = floor(ed.edge / 3.0 * (rk.nn - 1)) + 1),
d AS (SELECT h.symbol, h.bar_ts, h.next_ret, {digits} FROM h),
st AS (SELECT symbol, bar_ts, next_ret, CAST({sid} AS BIGINT) AS state FROM d)"""


@register("sig12_state_id", _state_sql() + "\nSELECT symbol, bar_ts, state FROM st")
def q_sig12(spark, sf):
    """SIG-12: state ids from three equal-frequency bins of MA, STD, WR and VOL (edges from training rows)."""
    return _state_frame(spark, sf).select("symbol", "bar_ts", "state")


@register("sig13_state_reward_table", _state_sql() + """,
tb AS (SELECT symbol, state, count(*) AS visits, avg(next_ret) AS mean_reward FROM st GROUP BY 1, 2)
SELECT symbol, state, visits, round(mean_reward, 6) AS mean_reward,
       round(visits / sum(visits) OVER (PARTITION BY symbol), 6) AS share, visits >= 10 AS confident FROM tb""")
def q_sig13(spark, sf):
    """SIG-13: visits, mean next return, share and confidence per state."""
    return rounded(SG.state_reward_table(_state_frame(spark, sf), "next_ret", 10))


@register("agg22_state_counts", _state_sql() + """,
tb AS (SELECT symbol, state, count(*) AS visits FROM st WHERE state IS NOT NULL GROUP BY 1, 2)
SELECT symbol, count(*) AS n_states, count(*) AS n_valid, CAST(sum(CAST(visits >= 10 AS INT)) AS BIGINT) AS n_confident FROM tb GROUP BY symbol""")
def q_agg22_states(spark, sf):
    """AGG-22: how many states occur, and how many of them often enough to trust."""
    from candela.operators.aggregates import state_counts
    return state_counts(SG.state_reward_table(_state_frame(spark, sf), "next_ret", 10))


# --- PNL ----------------------------------------------------------------------------------------

STOPS = PRESETS["eth_usd_roc"].with_(buy_sl=True, sell_sl=True, short=True, buy_tp=True, sell_tp=True, take_profit=0.05,
                                     order_type="limit", limit_fee=0.001, market_fee=0.0016)
BREAKOUT = STOPS.with_(breakout=True, buy_tp=False, sell_tp=False)
_PX = PNL_COLS + ["sl", "tp", "tp_price", "summargin"]
_PXD = PNL_DBL + ["tp_price", "summargin"]


@register("pnl01_12_stops_short_daily", DAILY + "," + S.roc_signal_ctes("bars", STOPS) + "," + S.pnl_ctes("td", STOPS) + "\n"
          + rsql(_PX, _PXD, "pnl"))
def q_pnl_stops(spark, sf):
    return out(roc_backtest(bars_daily(spark, sf), STOPS), _PX)


@register("pnl07_09_breakout_daily", DAILY + "," + S.roc_signal_ctes("bars", BREAKOUT) + "," + S.pnl_ctes("td", BREAKOUT) + "\n"
          + rsql(_PX, _PXD, "pnl"))
def q_pnl_breakout(spark, sf):
    return out(roc_backtest(bars_daily(spark, sf), BREAKOUT), _PX)


_LEDGER = ["symbol", "bar_ts", "shares", "value", "cash", "pnl"]
LEDGER_SQL = HOURLY + "," + S.roc_signal_ctes("bars", ROC) + f""",
g0 AS (SELECT symbol, bar_ts, close, 1000.0 * y_pred_val AS target FROM td),
g1 AS (SELECT *, coalesce(last_value(target IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING), 0.0) AS sig FROM g0 {W}),
g2 AS (SELECT *, coalesce(sig - lag(sig) OVER w, 0.0) <> 0 AS trade FROM g1 {W}),
g3 AS (SELECT *, CASE WHEN trade THEN round_even(sig / nullif(close, 0), 0) END AS tr FROM g2),
g4 AS (SELECT *, coalesce(last_value(tr IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING), 0.0) AS shares FROM g3 {W}),
g5 AS (SELECT *, coalesce(-(shares - lag(shares) OVER w) * close, 0.0) AS cflow FROM g4 {W}),
ledger AS (SELECT symbol, bar_ts, shares, shares * close AS value, sum(cflow) OVER (w ROWS UNBOUNDED PRECEDING) AS cash,
                  sum(cflow) OVER (w ROWS UNBOUNDED PRECEDING) + shares * close AS pnl,
                  row_number() OVER w AS pos FROM g5 {W})"""


def _ledger(spark, sf):
    td = SG.roc_signal(bars_hourly(spark, sf), ROC).withColumn("target", F.lit(1000.0) * F.col("y_pred_val"))
    return PN.position_ledger(td, "target", "close", "capital", 0.0, True)


@register("pnl13_position_ledger", LEDGER_SQL + "\n" + rsql(_LEDGER, ["shares", "value", "cash", "pnl"], "ledger"))
def q_pnl13(spark, sf):
    return out(_ledger(spark, sf), _LEDGER)


@register("pnl14_ledger_sharpe", LEDGER_SQL + f""",
d AS (SELECT symbol, shares, lead(pnl) OVER w - pnl AS dp FROM ledger {W})
SELECT symbol, round(sqrt(250.0) * avg(dp) / nullif(stddev_samp(dp), 0), 6) AS sharpe FROM d
WHERE shares <> 0 AND dp IS NOT NULL GROUP BY symbol""")
def q_pnl14(spark, sf):
    return rounded(PN.ledger_sharpe(_ledger(spark, sf), 250.0))


@register("pnl15_buy_and_hold", DAILY + """
SELECT symbol, round(arg_min(open, bar_ts), 6) AS start_price, round(arg_max(close, bar_ts), 6) AS end_price,
       min(bar_ts) AS start_ts, max(bar_ts) AS end_ts, round(10.0 * (arg_max(close, bar_ts) - arg_min(open, bar_ts)), 6) AS hold_profit
FROM bars WHERE bar_ts >= TIMESTAMP '1996-01-01' AND bar_ts <= TIMESTAMP '1999-12-31' GROUP BY symbol""")
def q_pnl15(spark, sf):
    return rounded(PN.buy_and_hold(bars_daily(spark, sf), "1996-01-01", "1999-12-31", 10.0))


@register("pnl17_trade_log_balances", LEDGER_SQL + f""",
t0 AS (SELECT symbol, bar_ts AS ts, shares - coalesce(lag(shares) OVER w, 0.0) AS equity, close FROM g4 {W}),
t1 AS (SELECT symbol, ts, equity, -equity * close AS cash FROM t0 WHERE equity <> 0)
SELECT symbol, ts, round(cash, 6) AS cash, round(equity, 6) AS equity, round(abs(cash) / nullif(abs(equity), 0), 6) AS price,
       round(sum(cash) OVER (PARTITION BY symbol ORDER BY ts ROWS UNBOUNDED PRECEDING), 6) AS cash_bal,
       round(sum(equity) OVER (PARTITION BY symbol ORDER BY ts ROWS UNBOUNDED PRECEDING), 6) AS equity_bal FROM t1""")
def q_pnl17(spark, sf):
    led = _ledger(spark, sf)
    log = FE.rolling(led, {"equity": lambda w: F.col("shares") - F.coalesce(F.lag("shares").over(w), F.lit(0.0))}, back=1)
    log = log.filter(F.col("equity") != 0).select("symbol", F.col("bar_ts").alias("ts"), "equity",
                                                  (-F.col("equity") * F.col("close")).alias("cash"))
    return out(PN.trade_log_balances(log), ["symbol", "ts", "cash", "equity", "price", "cash_bal", "equity_bal"])


POS_SQL = f""",
lp AS (SELECT symbol, arg_max(shares, pos) AS shares, arg_max(close, pos) AS price FROM ledger JOIN g0 USING (symbol, bar_ts) GROUP BY symbol),
bal AS (SELECT symbol AS account, symbol AS asset, shares AS amount FROM lp
        UNION ALL SELECT symbol AS account, 'USD' AS asset, 1000.0 AS amount FROM lp)"""


@register("pnl20_21_portfolio_value_position", LEDGER_SQL + POS_SQL + """,
v AS (SELECT b.account, sum(b.amount * CASE WHEN b.asset = 'USD' THEN 1.0 ELSE lp.price END) AS value
      FROM bal b LEFT JOIN lp ON lp.symbol = b.asset GROUP BY b.account),
c AS (SELECT account, sum(CASE WHEN asset = account THEN amount ELSE 0.0 END) AS equity FROM bal GROUP BY account)
SELECT v.account, round(v.value, 6) AS value, round(c.equity, 6) AS equity,
       CASE WHEN c.equity >= 0.001 THEN 'Buy' WHEN c.equity <= -0.001 THEN 'Sell' ELSE 'Cash' END AS position
FROM v JOIN c USING (account)""")
def q_pnl20(spark, sf):
    bal, lp = _balances(spark, sf)
    val = PN.portfolio_value(bal, lp.select(F.col("symbol").alias("asset"), "price"))
    cls = PN.classify_position(_own(bal), "__own__")
    return rounded(val.join(cls, "account"))


def _balances(spark, sf):
    from candela.operators.series import RN
    led = _ledger(spark, sf)
    lp = led.groupBy("symbol").agg(F.max_by("shares", RN).alias("shares"), F.max_by("close", RN).alias("price"))
    bal = lp.select(F.col("symbol").alias("account"), F.col("symbol").alias("asset"), F.col("shares").alias("amount")).unionByName(
        lp.select(F.col("symbol").alias("account"), F.lit("USD").alias("asset"), F.lit(1000.0).alias("amount")))
    return bal, lp


def _own(bal):
    """Mark each account's own asset so one classification call serves every account."""
    return bal.withColumn("asset", F.when(F.col("asset") == F.col("account"), F.lit("__own__")).otherwise(F.col("asset")))


@register("pnl18_19_order_intents", LEDGER_SQL + POS_SQL + "," + S.pnl_ctes("td", ROC) + f""",
ls AS (SELECT symbol, arg_max(signal, pos) AS signal, arg_max(new_trade, pos) AS new_trade, arg_max(sl, pos) AS sl,
              arg_max(close, pos) AS close FROM pnl GROUP BY symbol),
ps AS (SELECT symbol, CASE WHEN shares >= 0.001 THEN 'Buy' WHEN shares <= -0.001 THEN 'Sell' ELSE 'Cash' END AS position FROM lp),
j AS (SELECT ls.*, ps.position FROM ls LEFT JOIN ps USING (symbol)),
i AS (SELECT symbol, signal, position, unnest(list_filter([
        'cancel',
        CASE WHEN coalesce(position, 'Cash') <> 'Cash' AND coalesce(position, 'Cash') <> signal THEN 'close' END,
        CASE WHEN signal = 'Buy' AND coalesce(position, 'Cash') <> 'Buy' THEN 'open_long' END], lambda a: a IS NOT NULL)) AS intent,
        {_trunc_sql('1000.0 * 1.0 / close', 2)} AS order_size FROM j)
SELECT symbol, signal, position, intent, round(order_size, 6) AS order_size FROM i""")
def q_pnl18(spark, sf):
    pnl = roc_backtest(bars_hourly(spark, sf), ROC, keep_adx=False)
    from candela.operators.series import RN
    ls = pnl.groupBy("symbol").agg(*[F.max_by(c, RN).alias(c) for c in ("signal", "new_trade", "sl", "close")])
    bal, lp = _balances(spark, sf)
    pos = lp.select("symbol", F.when(F.col("shares") >= 0.001, "Buy").when(F.col("shares") <= -0.001, "Sell")
                    .otherwise("Cash").alias("position"))
    it = PN.order_intents(ls, pos, ROC).join(ls.select("symbol", "close"), "symbol")
    it = it.withColumn("order_size", PN.order_size(F.lit(1000.0), F.col("close"), ROC))
    return rounded(it.select("symbol", "signal", "position", "intent", "order_size"))


