"""Registered queries: each is a Spark plan over the test tables plus its DuckDB oracle SQL.

``REGISTRY[name] = (spark_fn(spark, sf_dir) -> DataFrame, sql | None)``. Doubles are rounded to 6
decimals on both sides; every computed column carries the same alias on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from candela.config import PRESETS
from candela.functions.scalar import publish_frame
from candela.plans import sqlparts as S
from candela.plans.strategies import final_returns, roc_backtest
from candela.sources.fixtures import BARS_DAILY_SQL, BARS_HOURLY_SQL, BARS_WEEKLY_SQL, bars_daily, bars_hourly

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (fn, S.half_up_sql(sql) if sql else None)
        return fn
    return deco


# Every double is published with 6 decimals and at most 10 significant digits (see scalar.publish);
# compounded multiples (products over many bars, whose last bits depend on multiplication order)
# with at most 8 significant digits.
COMPOUNDED = {"CSR", "CMR", "strategy_return", "market_return", "mr", "sr", "SRTotal", "DRTotal", "MR", "SR", "SR_total",
              "account", "growth", "cum_ret", "total_return_pct", "cond_return", "trailing_return", "value_path",
              "CSR_r", "CSR_e", "ret", "basket_CSR", "bench_CMR", "realised", "benchmark",
              "sign_penalty_loss", "loss"}

# ratios to a volatility that may be all but 0 (the covariance of 25 assets over four weeks is singular), whose last digits
# are what cancellation leaves
CANCELLED = {"best_sharpe"}


def _digits(name: str) -> int:
    return 6 if name in CANCELLED else 8 if name in COMPOUNDED else 10


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Publish every DOUBLE column (the oracle SQL publishes the same columns the same way)."""
    specs = {f.name: (digits, _digits(f.name)) for f in df.schema.fields
             if isinstance(f.dataType, T.DoubleType)}
    return publish_frame(df, specs) if specs else df


def rsql(cols: list[str], dbl: list[str], src: str, digits: int = 6) -> str:
    """SELECT list with the DOUBLE columns rounded."""
    parts = [f"{S.publish_sql(c, 6, _digits(c))} AS {c}" if c in dbl else c for c in cols]
    return f"SELECT {', '.join(parts)} FROM {src}"


HOURLY = "WITH RECURSIVE " + BARS_HOURLY_SQL
DAILY = "WITH RECURSIVE " + BARS_DAILY_SQL
WEEKLY = "WITH RECURSIVE " + BARS_WEEKLY_SQL

ROC = PRESETS["eth_usd_roc"]

# --- sources ------------------------------------------------------------------------------------


@register("src10_bars_hourly", HOURLY + "\nSELECT * FROM bars")
def q_bars_hourly(spark, sf):
    return bars_hourly(spark, sf)


@register("src10_bars_daily", DAILY + "\nSELECT * FROM bars")
def q_bars_daily(spark, sf):
    return bars_daily(spark, sf)


# --- minimum slice: ROC rule P&L -----------------------------------------------------------------

PNL_COLS = ["symbol", "bar_ts", "signal", "y_pred_id", "new_trade", "trade_id", "open_price", "close_price", "ctr",
            "fee", "SR", "DR", "CSR", "CMR", "ADX", "sl_price", "date_to", "Price_Rise"]
PNL_DBL = ["open_price", "close_price", "ctr", "fee", "SR", "DR", "CSR", "CMR", "ADX", "sl_price"]


@register("pnl12_roc_hourly", HOURLY + "," + S.roc_signal_ctes("bars", ROC) + "," + S.pnl_ctes("td", ROC) + "\n"
          + rsql(PNL_COLS, PNL_DBL, "pnl"))
def q_pnl_roc_hourly(spark, sf):
    return rounded(roc_backtest(bars_hourly(spark, sf), ROC).select(*PNL_COLS))


RESULT_SQL = """
SELECT symbol, count(*) AS n_bars, """ + S.sig_sql("arg_max(CSR, pos)") + """ AS strategy_return,
       """ + S.sig_sql("arg_max(CMR, pos)") + """ AS market_return, CAST(sum(CAST(new_trade AS INT)) AS BIGINT) AS n_trades,
       round(avg(CASE WHEN signal = 'Buy' THEN 1.0 ELSE 0.0 END), 6) AS buy_pct
FROM pnl GROUP BY symbol"""


@register("roc_rule_result_daily", DAILY + "," + S.roc_signal_ctes("bars", ROC) + "," + S.pnl_ctes("td", ROC) + RESULT_SQL)
def q_roc_result_daily(spark, sf):
    return rounded(final_returns(roc_backtest(bars_daily(spark, sf), ROC, keep_adx=False)))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per symbol: what does the 17-bar ROC rule with a -5 threshold return against holding?"""
    return q_roc_result_daily(spark, sf_dir)
