"""Strategy profit and loss as column operators (PNL-1..21).

``run_pnl`` is the whole bar-level pipeline: ADX warm-up, pivots, stops, take-profit, trade keys,
fees, margin, strategy/market returns, risk-off adjustment and compounding. It has no state
feedback (a stop depends on prices and the previous bar only), so it is windows, block scans and
column arithmetic. Frames that feed a block scan are stored once (``session.materialize``), so no
branch re-runs the plan above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.config import StrategyConfig
from candela.functions.scalar import div, full, lag, lead, pivot_points, truncate
from candela.operators.features import ensure_indexed, rolling
from candela.operators.indicators import adx
from candela.operators.series import BLK, RN, at_pos, dropna_dense, from_pos, running



def _lit(v):
    return lambda: F.lit(v)


BUY, SELL, CASH = _lit("Buy"), _lit("Sell"), _lit("Cash")


def stop_price(w, cfg: StrategyConfig) -> Column:
    """PNL-1: Buy -> previous bar's SMA(close, 50); Sell -> previous bar's R2; else 0."""
    sma_prev = F.lag(full(F.avg, "close", w, cfg.stop_sma_period), 1).over(w)
    r2_prev = F.lag(F.col("R2"), 1).over(w)
    return F.when(F.col("signal") == "Sell", r2_prev).when(F.col("signal") == "Buy", sma_prev).otherwise(F.lit(0.0))


def stop_hit(cfg: StrategyConfig) -> Column:
    """PNL-2: stop inside the bar's range on the side of the open (missing stop -> no hit)."""
    s, o = F.col("sl_price"), F.col("open")
    hit = F.lit(False)
    if cfg.buy_sl:
        hit = hit | ((F.col("signal") == "Buy") & (s <= o) & (s >= F.col("low")))
    if cfg.sell_sl:
        hit = hit | ((F.col("signal") == "Sell") & (s >= o) & (s <= F.col("high")))
    return F.coalesce(hit, F.lit(False))


def take_profit_price(cfg: StrategyConfig) -> Column:
    """PNL-3: open * (1 +/- take_profit)."""
    o = F.col("open")
    return (F.when(F.col("signal") == "Sell", o * F.lit(1 - cfg.take_profit))
            .when(F.col("signal") == "Buy", o * F.lit(1 + cfg.take_profit)).otherwise(F.lit(0.0)))


def take_profit_hit(cfg: StrategyConfig) -> Column:
    t, o = F.col("tp_price"), F.col("open")
    hit = F.lit(False)
    if cfg.buy_tp:
        hit = hit | ((F.col("signal") == "Buy") & (t >= o) & (t <= F.col("high")))
    if cfg.sell_tp and cfg.short:
        hit = hit | ((F.col("signal") == "Sell") & (t <= o) & (t >= F.col("low")))
    return F.coalesce(hit, F.lit(False))


def new_trade(w) -> Column:
    """PNL-4: signal changed, or the previous bar hit a stop or take-profit; the first bar is new (Q8)."""
    return (~F.col("signal").eqNullSafe(F.lag("signal", 1).over(w))
            | F.coalesce(F.lag("sl", 1).over(w), F.lit(False)) | F.coalesce(F.lag("tp", 1).over(w), F.lit(False)))


def exit_price() -> Column:
    """PNL-6: take-profit price, overridden by the stop price (stop wins, Q22), else close."""
    return F.when(F.col("sl"), F.col("sl_price")).when(F.col("tp"), F.col("tp_price")).otherwise(F.col("close"))


def trade_return(cfg: StrategyConfig) -> Column:
    """PNL-7: rolling trade return."""
    r = div(F.col("close_price"), F.col("open_price"))
    ctr = F.when(F.col("signal") == "Buy", r)
    if cfg.short:
        ctr = ctr.when(F.col("signal") == "Sell", F.lit(2.0) - r)
    ctr = ctr.otherwise(F.lit(1.0))
    if cfg.breakout:
        ctr = F.when((F.col("signal") == "Sell") & F.col("sl"), ctr * div(F.col("close"), F.col("sl_price"))).otherwise(ctr)
    return ctr


def margin_sum(cfg: StrategyConfig) -> Column:
    """PNL-8: margin accumulated inside the trade. A trade never changes signal (a change opens a new
    trade), so the running sum over the trade is margin_open + margin * (bars so far) for short
    trades and 0 otherwise."""
    if not cfg.short:
        return F.lit(0.0)
    k = (F.col(RN) - F.col("trade_rn") + 1).cast("double")
    return F.when(F.col("signal") == "Sell", F.lit(cfg.margin_open) + F.lit(cfg.margin) * k).otherwise(F.lit(0.0))


def fees(cfg: StrategyConfig) -> Column:
    """PNL-9: open + close fee; market fee on a stop; short/breakout rules."""
    lf, mf = cfg.open_fee, cfg.market_fee
    ctr = F.col("ctr")
    fee = F.when(F.col("sl"), F.lit(lf) + ctr * F.lit(mf)).otherwise(F.lit(lf) + ctr * F.lit(lf))
    if cfg.short:
        if cfg.breakout:
            fee = F.when((F.col("signal") == "Sell") & F.col("sl"), fee + ctr * F.lit(mf + lf)).otherwise(fee)
    elif not cfg.breakout:
        fee = F.when(F.col("signal") == "Sell", F.lit(0.0)).otherwise(fee)
    return fee


def run_pnl(td: DataFrame, cfg: StrategyConfig, checkpoint: bool = True, keep_adx: bool = True,
            lean: bool = False) -> DataFrame:
    """PNL-12: the bar-level P&L frame (columns of the reference's backtest frame plus rn).

    Input: a signal frame (symbol, bar_ts, open, high, low, close, signal[, size, y_pred, y_pred_val,
    y_pred_id, ADX]) whose rows per symbol are contiguous in ``rn``. Phases:
    ADX (unless given) + warm-up drop -> stage 1 (pivots, stops, take-profit, new trade) -> forward fill of trade
    keys and stop price (after the flags, quirk Q7) -> stage 2 (returns, fees, risk-off, bar end)
    -> running products CSR/CMR.

    ADX is needed for its values only by the risk-off adjustment. Otherwise it only removes its
    warm-up (the first 2n-1 bars of each series, where ADX is undefined); with ``keep_adx=False``
    that drop is done by a position flag and the ADX column is not produced. (``checkpoint`` is kept
    for callers; scans store their inputs themselves, see ``session.materialize``.) ``lean`` keeps only
    the columns the returns need (of the pivots only R2, which the sell stop uses), for sweeps.
    """
    td = ensure_indexed(td)
    need_adx = keep_adx or cfg.adjust_signal
    stops = cfg.buy_sl or cfg.sell_sl
    targets = cfg.buy_tp or (cfg.sell_tp and cfg.short)
    warm = 2 * cfg.adx_period - 1
    merged = lean and not need_adx and not stops and not targets and not cfg.ignore_signals
    # like the reference's dropna over the frame: ADX warm-up rows and rows without a signal (an
    # ignored score bucket before any signal) leave; ADX itself is computed over all rows first
    if need_adx:
        bt = dropna_dense(td if "ADX" in td.columns else adx(td, cfg.adx_period, "ADX"), ["ADX", "signal", "open", "high", "low", "close"])
    elif merged:
        bt = td  # the warm-up drop is folded into stage 1 below (signals are never missing here)
    else:
        bt = rolling(td, {"_ok": lambda w: from_pos(w, warm)}, back=warm)
        bt = dropna_dense(bt.withColumn("_ok", F.when(F.col("_ok"), F.lit(1))),
                          ["_ok", "signal", "open", "high", "low", "close"]).drop("_ok")
        bt = bt.withColumn("ADX", F.lit(None).cast("double"))
    if merged:
        # stage 1 needs one-bar look-backs only: flag the first kept bar and treat its look-backs as
        # missing, exactly as if the warm-up bars had been removed first
        bt = rolling(bt, [
            ("_ok", lambda w: from_pos(w, warm)), ("_first", lambda w: at_pos(w, warm)),
            ("sl_price", lambda w: F.lit(None).cast("double")), ("sl", lambda w: F.lit(False)),
            ("tp_price", lambda w: F.lit(None).cast("double")), ("tp", lambda w: F.lit(False)),
            ("new_trade", lambda w: F.col("_first") | ~F.col("signal").eqNullSafe(F.lag("signal", 1).over(w))),
            ("DR", lambda w: F.when(F.col("_first"), F.lit(None).cast("double")).otherwise(div(F.col("close"), lag("close", 1, w)))),
        ], back=warm + 1).filter(F.col("_ok")).drop("_ok", "_first")
        bt = bt.withColumn("ADX", F.lit(None).cast("double")).withColumn("ADX_prev", F.lit(None).cast("double"))
    piv = pivot_points()
    if lean:
        piv = {"R2": piv["R2"]} if stops else {}
    cols = {k: (lambda v: lambda w: v)(v) for k, v in piv.items()}
    if lean and not stops:  # a stop can never fire: its price cannot reach the returns
        cols.update({"sl_price": lambda w: F.lit(None).cast("double"), "sl": lambda w: F.lit(False)})
    else:
        cols.update({"sl_price": lambda w: stop_price(w, cfg), "sl": lambda w: stop_hit(cfg)})
    if lean and not targets:
        cols.update({"tp_price": lambda w: F.lit(None).cast("double"), "tp": lambda w: F.lit(False)})
    else:
        cols.update({"tp_price": lambda w: take_profit_price(cfg), "tp": lambda w: take_profit_hit(cfg)})
    cols.update({
        "new_trade": new_trade,
        "DR": lambda w: div(F.col("close"), lag("close", 1, w)),
        "ADX_prev": lambda w: lag("ADX", 1, w),
    })
    if not merged:
        bt = rolling(bt, cols, back=cfg.stop_sma_period + 1 if (stops or not lean) else 1)
    bt = (bt.withColumn("trade_id", F.when(F.col("new_trade"), F.unix_seconds(F.col("bar_ts").cast("timestamp"))))
          .withColumn("open_price", F.when(F.col("new_trade"), F.col("open")))
          .withColumn("trade_rn", F.when(F.col("new_trade"), F.col(RN))))
    if lean:  # keep only what the returns need before the stored scans
        keep = ["symbol", RN, BLK, "bar_ts", "open", "high", "low", "close", "signal", "sl", "tp", "sl_price", "tp_price",
                "new_trade", "DR", "ADX_prev", "trade_id", "open_price", "trade_rn", "size", "base_symbol", "param_id"]
        bt = bt.select(*[c for c in keep if c in bt.columns])
    filled = ["trade_id", "open_price", "trade_rn", "sl_price"]
    if lean:
        filled = ["trade_id", "open_price"] + (["trade_rn"] if cfg.short else []) + (["sl_price"] if stops else [])
    bt = running(bt, [(c, "last", c) for c in filled])
    bt = (bt.withColumn("close_price", exit_price())
          .withColumn("ctr", trade_return(cfg))
          .withColumn("summargin", margin_sum(cfg))
          .withColumn("fee", fees(cfg))
          .withColumn("ctrf", F.col("ctr") - F.col("fee") - F.col("summargin")))
    sr = lambda w: F.when(F.col("new_trade"), F.col("ctrf")).otherwise(div(F.col("ctrf"), lag("ctrf", 1, w)))
    stage2 = [("SR", sr)]
    if cfg.position_sizing:
        stage2.append(("SR", lambda w: (F.col("SR") - 1) * F.col("size") + 1))
    back = 1
    if cfg.adjust_signal:
        n = cfg.asr_period
        cash_to_one = ("SR", lambda w: F.when(F.col("signal") == "Cash", F.lit(1.0)).otherwise(F.col("SR")))
        stage2 += [
            ("signal", lambda w: F.when(F.col("ADX_prev") < F.lit(cfg.adx_lo_threshold), CASH())
             .when(F.col("ADX_prev") > F.lit(cfg.adx_hi_threshold), CASH()).otherwise(F.col("signal"))),
            cash_to_one,
            ("ASR", lambda w: F.when(F.count("SR").over(w.rowsBetween(-n, -1)) >= n, F.avg("SR").over(w.rowsBetween(-n, -1)))),
            ("signal", lambda w: F.when(F.col("ASR") < F.lit(cfg.asr_threshold), CASH()).otherwise(F.col("signal"))),
            cash_to_one,
        ]
        back = n + 1
    if not lean:  # bar end and Price_Rise are report columns; sweeps read only the returns
        stage2 += [
            ("Price_Rise", lambda w: F.when(F.col("DR") > 1, F.lit(1)).otherwise(F.lit(0))),
            ("date_to", lambda w: F.coalesce(lead("bar_ts", 1, w), F.col("bar_ts") + F.make_dt_interval(
                F.lit(0), F.lit(0), F.lit(cfg.trade_interval)))),
        ]
    bt = rolling(bt, stage2, back=back, fwd=0 if lean else 1)
    bt = running(bt, [("SR", "product", "CSR"), ("DR", "product", "CMR")])
    return bt if need_adx else bt.drop("ADX", "ADX_prev")


# --- ledger, intents and valuation --------------------------------------------------------------

def position_ledger(df: DataFrame, signal: str = "target", price: str = "close", mode: str = "capital",
                    initial_cash: float = 0.0, round_shares: bool = True) -> DataFrame:
    """PNL-13: signal -> trades -> shares, value, cash, pnl.

    The signal is forward filled (leading gaps 0); a trade happens where it differs from the previous
    bar (the first bar never trades, quirk Q15). 'capital' mode buys signal/price shares (rounded
    half-even when ``round_shares``), 'shares' mode holds ``signal`` shares. Shares carry forward
    between trades; cash is the running sum of -delta(shares) * price."""
    df = ensure_indexed(df)
    df = running(df, [(signal, "last", "_sig")])
    df = df.withColumn("_sig", F.coalesce(F.col("_sig"), F.lit(0.0)))
    df = rolling(df, {"_trade": lambda w: F.coalesce(F.col("_sig") - lag("_sig", 1, w), F.lit(0.0)) != 0}, back=1)
    if mode == "shares":
        tr = F.col("_sig")
    else:
        tr = div(F.col("_sig"), F.col(price))
        if round_shares:
            tr = F.bround(tr, 0)
    df = df.withColumn("_tr", F.when(F.col("_trade"), tr))
    df = running(df, [("_tr", "last", "shares")]).withColumn("shares", F.coalesce(F.col("shares"), F.lit(0.0)))
    df = rolling(df, {"_delta": lambda w: F.col("shares") - lag("shares", 1, w)}, back=1)
    df = df.withColumn("_cflow", F.coalesce(-F.col("_delta") * F.col(price), F.lit(0.0)))
    df = running(df, [("_cflow", "sum", "_cash")])
    return (df.withColumn("value", F.col("shares") * F.col(price))
            .withColumn("cash", F.col("_cash") + F.lit(initial_cash))
            .withColumn("pnl", F.col("cash") + F.col("value") - F.lit(initial_cash))
            .drop("_sig", "_trade", "_tr", "_delta", "_cflow", "_cash"))


def ledger_sharpe(ledger: DataFrame, periods: float = 250.0) -> DataFrame:
    """PNL-14: sqrt(periods) * mean/std (sample) of next-bar pnl changes on bars with a position."""
    d = rolling(ledger, {"_dp": lambda w: lead("pnl", 1, w) - F.col("pnl")}, back=0, fwd=1)
    d = d.filter((F.col("shares") != 0) & F.col("_dp").isNotNull())
    return d.groupBy("symbol").agg(
        (F.lit(periods ** 0.5) * div(F.avg("_dp"), F.stddev_samp("_dp"))).alias("sharpe"))


def buy_and_hold(bars: DataFrame, start: str | None = None, end: str | None = None, nshares: float = 1.0) -> DataFrame:
    """PNL-15: profit of holding ``nshares`` from the first bar's open to the last bar's close in range."""
    b = bars
    if start:
        b = b.filter(F.col("bar_ts") >= F.to_timestamp(F.lit(start)).cast("timestamp_ntz"))
    if end:
        b = b.filter(F.col("bar_ts") <= F.to_timestamp(F.lit(end)).cast("timestamp_ntz"))
    g = b.groupBy("symbol").agg(F.min_by("open", "bar_ts").alias("start_price"),
                                F.max_by("close", "bar_ts").alias("end_price"),
                                F.min("bar_ts").alias("start_ts"), F.max("bar_ts").alias("end_ts"))
    return g.withColumn("hold_profit", F.lit(nshares) * (F.col("end_price") - F.col("start_price")))


def breakout_returns(df: DataFrame) -> DataFrame:
    """PNL-16: log return times the previous bar's position, and its running sum."""
    df = rolling(df, {"strat_log_ret": lambda w: F.ln(div(F.col("close"), lag("close", 1, w))) * lag("position", 1, w)},
                 back=1)
    return running(df, [("strat_log_ret", "sum", "cum_log_ret")])


def trade_log_balances(log: DataFrame, keys=("symbol",)) -> DataFrame:
    """PNL-17: execution log (action, cash, equity amounts per fill) -> price per fill and running
    cash / equity balances (running sums in ``rn`` order)."""
    log = ensure_indexed(log, keys, "ts")
    log = log.withColumn("price", div(F.abs(F.col("cash")), F.abs(F.col("equity"))))
    return running(log, [("cash", "sum", "cash_bal"), ("equity", "sum", "equity_bal")], keys)


def order_size(balance: Column, price: Column, cfg: StrategyConfig, short: bool = False) -> Column:
    """PNL-19: truncated balance * pct / price (or the fixed order size), capped by max_short; NULL at a
    zero price."""
    size = truncate(div(balance * F.lit(cfg.order_pct), price), cfg.order_precision) if cfg.order_size == 0 \
        else F.lit(float(cfg.order_size))
    if short and cfg.max_short > 0:
        size = F.least(size, F.lit(float(cfg.max_short)))
    return size


def classify_position(balances: DataFrame, asset: str, cash_asset: str = "USD", min_equity: float = 0.001) -> DataFrame:
    """PNL-21: Buy when holding at least min_equity of the asset, Sell when short (negative), else Cash.
    ``balances`` is (account, asset, amount)."""
    eq = balances.groupBy("account").agg(F.sum(F.when(F.col("asset") == asset, F.col("amount")).otherwise(F.lit(0.0))).alias("equity"))
    return eq.withColumn("position", F.when(F.col("equity") >= min_equity, BUY())
                         .when(F.col("equity") <= -min_equity, SELL()).otherwise(CASH()))


def portfolio_value(balances: DataFrame, last_prices: DataFrame, usd: str = "USD") -> DataFrame:
    """PNL-20: sum of balance x last USD price per account (USD priced at 1). ``last_prices`` is
    (asset, price): one row per asset, joined on the asset key."""
    j = balances.join(last_prices, "asset", "left")
    px = F.when(F.col("asset") == usd, F.lit(1.0)).otherwise(F.col("price"))
    return j.groupBy("account").agg(F.sum(F.col("amount") * px).alias("value"))


def order_intents(latest: DataFrame, position: DataFrame, cfg: StrategyConfig) -> DataFrame:
    """PNL-18: order intents from the latest signal vs the current position, one row per action:
    cancel open orders; close a position whose side differs from the signal; open the signal's side
    (Sell only when short trading is on); a stop and a take-profit for a new long when configured;
    a breakout re-entry when a short was stopped."""
    j = latest.join(position, "symbol", "left")
    sig, pos = F.col("signal"), F.coalesce(F.col("position"), CASH())
    acts = F.array(
        F.lit("cancel"),
        F.when((pos != "Cash") & (pos != sig), F.lit("close")),
        F.when((sig == "Buy") & (pos != "Buy"), F.lit("open_long")),
        F.when(F.lit(cfg.short) & (sig == "Sell") & (pos != "Sell"), F.lit("open_short")),
        F.when(F.lit(cfg.buy_sl) & (sig == "Buy") & F.col("new_trade"), F.lit("stop")),
        F.when(F.lit(cfg.buy_tp and cfg.take_profit < 1) & (sig == "Buy") & F.col("new_trade"), F.lit("take_profit")),
        F.when(F.lit(cfg.breakout) & (sig == "Sell") & F.col("sl"), F.lit("breakout_long")),
    )
    return (j.select("symbol", "signal", "position", F.explode(F.filter(acts, lambda a: a.isNotNull())).alias("intent")))

