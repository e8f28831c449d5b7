"""Headline benchmark: prints one JSON line with per-query seconds.

Queries run over the whole tables at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``; each result is fully computed with the ``noop`` sink (no collect). A query's figure is the
median of ``$BENCH_RUNS`` (3) runs; single runs scatter, and the first one compiles.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from candela.config import PRESETS  # noqa: E402
from candela.operators import features as FE  # noqa: E402
from candela.operators import indicators as IN  # noqa: E402
from candela.operators import portfolio as PF  # noqa: E402
from candela.operators import risk as RK  # noqa: E402
from candela.operators.aggregates import gen_trades, strategy_summary  # noqa: E402
from candela.plans.strategies import final_returns, roc_backtest  # noqa: E402
from candela.session import get_spark  # noqa: E402
from candela.sources.fixtures import bars_daily, bars_hourly  # noqa: E402

ROC = PRESETS["eth_usd_roc"]
SWEEP = PF.param_grid(period=[2, 5, 8, 11, 14, 17, 20, 30, 40, 50], threshold=[-20.0, -15.0, -10.0, -5.0, -2.0, 0.0, 2.0, 5.0, 11.0, 20.0],
                      delay=list(range(1, 11)))


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", app="candela-bench")
    queries = {
        "bars": lambda: bars_hourly(spark, sf_dir).unionByName(bars_daily(spark, sf_dir)),
        "feature_bank": lambda: FE.feature_bank(IN.rsi(bars_daily(spark, sf_dir), 14)),  # scans before wide columns
        "pnl_summary": lambda: _pnl_summary(spark, sf_dir),
        "risk_table": lambda: RK.risk_table(RK.with_market(RK.bar_returns(bars_hourly(spark, sf_dir)), "r")),
        "sweep_1000": lambda: PF.roc_sweep(bars_hourly(spark, sf_dir), SWEEP, ROC),
        "portfolios_5000": lambda: _mpt(spark, sf_dir),
    }
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]
    times = {}
    for name, build in queries.items():
        if only and name not in only:
            continue
        seen = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "3"))):
            t0 = time.time()
            run(build())
            seen.append(time.time() - t0)
        times[name] = round(statistics.median(seen), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


def _pnl_summary(spark, sf_dir):
    pnl = roc_backtest(bars_daily(spark, sf_dir), ROC, keep_adx=False)
    return strategy_summary(pnl, gen_trades(pnl)).join(final_returns(pnl).select("symbol", "n_trades"), "symbol")


def _mpt(spark, sf_dir):
    """All brands."""
    bars = bars_daily(spark, sf_dir)
    names = PF.asset_names(bars)
    _, monthly, cov = PF.aligned_monthly(bars, names)
    return PF.best_sharpe(PF.random_portfolios(monthly, cov, len(names), 5000)).withColumn("x", F.lit(1))


if __name__ == "__main__":
    main()
