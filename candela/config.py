"""Strategy configuration (frozen dataclass) with the reference's default parameter values."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class StrategyConfig:
    # fixed values: defaults of the reference's configuration
    signal_threshold: float = 0.5
    signal_scale: float = 1000
    ignore_signals: tuple | None = None
    hold_signals: tuple | None = None
    take_profit: float = 1.0
    buy_sl: bool = False
    sell_sl: bool = False
    buy_tp: bool = False
    sell_tp: bool = False
    short: bool = False
    breakout: bool = False
    limit_fee: float = 0.0010
    market_fee: float = 0.0016
    order_type: str = "limit"
    margin: float = 0.0012
    margin_open: float = 0.0002
    position_sizing: bool = False
    adjust_signal: bool = True
    adx_period: int = 6
    adx_lo_threshold: float = 0.0
    adx_hi_threshold: float = 1000.0
    asr_period: int = 10
    asr_threshold: float = 0.0
    trade_interval: int = 60 * 24
    sma_period: int = 50
    stop_sma_period: int = 50
    adr_period: int = 20
    hh_period: int = 50
    ll_period: int = 50
    rsi_period: int = 50
    vol_period: int = 30
    std_period: int = 7
    wil_period: int = 7
    roc_period: int = 17
    roc_threshold: float = -5.0
    signal_delay: int = 1
    train_pct: float = 0.8
    test_pct: float = 0.2
    test_bars: int = 0
    price_precision: int = 2
    order_pct: float = 1.0
    order_precision: int = 2
    order_size: float = 0.0
    max_short: float = 0.0
    min_equity: float = 0.001
    min_cash: float = 1.0

    @property
    def open_fee(self) -> float:
        """Fee charged as the 'limit' fee; a market order type pays the market fee (quirk Q21)."""
        return self.market_fee if self.order_type == "market" else self.limit_fee

    def with_(self, **kw) -> "StrategyConfig":
        return replace(self, **kw)


# Rule-strategy presets (fixed values from the reference's configuration list).
PRESETS = {
    "eth_usd_roc": StrategyConfig(adjust_signal=False, limit_fee=0.002, market_fee=0.004, order_type="market",
                                  roc_period=17, roc_threshold=-5, signal_delay=1),
    "btc_usd_roc": StrategyConfig(adjust_signal=False, limit_fee=0.002, market_fee=0.004, order_type="market",
                                  roc_period=15, roc_threshold=0, signal_delay=4),
    "eth_btc_roc": StrategyConfig(adjust_signal=False, limit_fee=0.002, market_fee=0.004, order_type="market",
                                  roc_period=16, roc_threshold=11, signal_delay=6),
    "eth_usd_nn1": StrategyConfig(limit_fee=0.002, market_fee=0.004, order_type="market", signal_threshold=1,
                                  signal_scale=100, adx_period=6),
    "eth_usd_nn1_safe": StrategyConfig(limit_fee=0.002, market_fee=0.004, order_type="market", signal_threshold=1,
                                       signal_scale=100, adx_period=6, adx_lo_threshold=40, asr_threshold=0.99,
                                       buy_sl=True),
    "eth_usd_ens": StrategyConfig(limit_fee=0.002, market_fee=0.004, order_type="market", signal_threshold=0.5,
                                  adjust_signal=False),
    "btc_usd_nn_breakout": StrategyConfig(breakout=True, short=True, limit_fee=0.0008, test_bars=365),
}
