"""Properties from the survey's test strategy: CSR is the product of SR, trade durations sum to the
bars, and trade-level products chain to the bar-level ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from candela.config import PRESETS
from candela.operators.aggregates import gen_trades
from candela.operators.series import RN
from candela.plans.strategies import roc_backtest
from candela.sources.fixtures import bars_daily
from tests.conftest import SF0001


@pytest.fixture(scope="module")
def pnl(spark):
    return roc_backtest(bars_daily(spark, SF0001), PRESETS["eth_usd_roc"], keep_adx=False)


def test_final_csr_is_product_of_sr(pnl):
    rows = pnl.groupBy("symbol").agg(F.max_by("CSR", RN).alias("csr"), F.product("SR").alias("prod")).collect()
    for r in rows:
        assert r.csr == pytest.approx(r.prod, rel=1e-9)


def test_trade_durations_sum_to_bars(pnl):
    bars = dict(pnl.groupBy("symbol").count().collect())
    dur = dict(gen_trades(pnl).groupBy("symbol").agg(F.sum("duration")).collect())
    assert bars == dur


def test_trade_products_chain_to_bar_products(pnl):
    last_trade = gen_trades(pnl).groupBy("symbol").agg(F.max_by("CSR", "open_ts").alias("t")).toPandas().set_index("symbol")
    last_bar = pnl.groupBy("symbol").agg(F.max_by("CSR", RN).alias("b")).toPandas().set_index("symbol")
    j = last_trade.join(last_bar)
    np.testing.assert_allclose(j.t, j.b, rtol=1e-9)
