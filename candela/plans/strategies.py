"""End-to-end strategy plans: bars -> features -> signal -> P&L -> summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.config import PRESETS, StrategyConfig
from candela.operators.pnl import run_pnl
from candela.operators.series import RN
from candela.operators.signals import roc_signal


def roc_backtest(bars: DataFrame, cfg: StrategyConfig | None = None, checkpoint: bool = True,
                 keep_adx: bool = True) -> DataFrame:
    """Entry 2 of the reference: ROC rule on every symbol -> bar-level P&L frame."""
    cfg = cfg or PRESETS["eth_usd_roc"]
    return run_pnl(roc_signal(bars, cfg), cfg, checkpoint=checkpoint, keep_adx=keep_adx)


def final_returns(pnl: DataFrame) -> DataFrame:
    """Per symbol: bars in the P&L frame, final strategy and market multiple, trades, share of Buy bars."""
    return pnl.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_bars"),
        F.max_by("CSR", RN).alias("strategy_return"),
        F.max_by("CMR", RN).alias("market_return"),
        F.sum(F.col("new_trade").cast("long")).alias("n_trades"),
        F.avg((F.col("signal") == "Buy").cast("double")).alias("buy_pct"))


STRATEGIES = {"roc": roc_backtest}
