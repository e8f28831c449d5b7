"""Driver contract at sf0.001: entry() runs, and a spread of registered queries equals its DuckDB SQL."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF0001
from tests.oracle_check import compare, duck

SAMPLE = ["src10_bars_daily", "prj06_lagged_return_frame", "win01_09_base_features", "scn07_adx", "sig04_mask_signals",
          "pnl12_roc_hourly", "agg05_gen_trades", "rsk12_25_risk_table", "jon10_bracket_exit", "ts03_upsample_interpolate",
          "swp02_adr_sweep", "ml10_qda", "str01_stream_bars", "jon10_bracket_exit_open", "ml03_naive_bayes", "ml04_regression_terms",
          "swp02_adr_roc_sweep", "agg22_state_counts"]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"symbol", "strategy_return", "market_return"} <= set(df.columns)


def test_every_query_has_a_callable_and_sql_keys_exist():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 100


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, name):
    sp = E.queries()[name](spark, SF0001).toPandas()
    dk = duck(SF0001).execute(E.oracle_sql()[name]).df()
    ok, msg = compare(sp, dk)
    assert ok, msg
