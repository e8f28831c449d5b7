"""State of the signal stream (STR-2): per symbol the bars that can still change, with a signal checkpoint at each.

A symbol's state holds the bars no older than the allowed lateness behind its newest one, the look-back before them, and what is
left of the bars before that: their number, the signal held after them and their last signal row. Every bar carries the
signal held after it and its own signal row. A corrected or inserted bar is replayed from its place: the signal held
before it comes from the bar in front, and all later bars, whose look-backs may reach it, are computed again. The result
is what a batch run over all bars gives.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from candela.config import StrategyConfig

PARTIAL = "symbol string, bar long, at long, close double"
RESULT = "symbol string, bar long, y_pred_val double, signal string"
BAR = "bar long, at long, close double, held string, score double, signal string"
META = "gone long, held string, bar long, score double, signal string"


def partial_closes(width: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Per symbol and bar (of ``width`` microseconds) the last price of each batch of ticks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            t = t.dropna(subset=["symbol", "at", "price"])
            t = t.assign(bar=t["at"] // width * width).sort_values("at", kind="stable")
            yield t.groupby(["symbol", "bar"], as_index=False).last().rename(columns={"price": "close"})[["symbol", "bar", "at", "close"]]
    return run


class SignalState(StatefulProcessor):
    def __init__(self, cfg: StrategyConfig, width: int, late: int):
        self.cfg, self.width, self.late = cfg, width, late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bars = handle.getListState("bars", BAR)
        self.meta = handle.getValueState("meta", META)

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802 (the interface's name)
        bars = [list(b) for b in self.bars.get()]
        gone, *before = self.meta.get() if self.meta.exists() else (0, None, None, None, None)
        oldest = bars[-1][0] - self.late - self.width if bars else None
        known = {b[0]: b for b in bars}
        changed = None
        for part in rows:
            for bar, at, close in zip(part["bar"].tolist(), part["at"].tolist(), part["close"].tolist()):
                if oldest is not None and bar < oldest:
                    continue
                old = known.get(bar)
                if old is None or at >= old[1]:
                    if old is None:
                        known[bar] = [bar, at, close, None, None, None]
                    else:
                        old[1:3] = at, close
                    changed = bar if changed is None else min(changed, bar)
        if changed is None:
            return
        bars = [known[b] for b in sorted(known)]
        replay(bars, next(i for i, b in enumerate(bars) if b[0] == changed), int(gone), before[0], self.cfg)
        gone, before, bars = trimmed(bars, int(gone), before, self.keep_from(bars))
        self.bars.put([tuple(b) for b in bars])
        self.meta.update((gone, *before))
        last = next((b for b in reversed(bars) if b[4] is not None), None)
        row = (last[0], last[4], last[5]) if last else tuple(before[1:])
        if row[0] is not None:
            yield pd.DataFrame({"symbol": [key[0]], "bar": [row[0]], "y_pred_val": [row[1]], "signal": pd.Series([row[2]], dtype=object)})

    def keep_from(self, bars: list[list]) -> int:
        """The first bar to keep: the look-back in front of the oldest bar that may still change."""
        oldest = bars[-1][0] - self.late - self.width
        first = next(i for i, b in enumerate(bars) if b[0] >= oldest)
        return max(0, first - (self.cfg.roc_period + self.cfg.signal_delay + 2))


def replay(bars: list[list], start: int, gone: int, held: str | None, cfg: StrategyConfig) -> None:
    """Signals of ``bars[start:]``; ``gone`` bars precede ``bars``, after which ``held`` was the signal."""
    n, lag = cfg.roc_period, cfg.signal_delay + 1
    closes = [b[2] for b in bars]
    if start:
        held = bars[start - 1][3]
    for i in range(start, len(bars)):
        place = gone + i
        score = shown = None
        if place >= max(n, lag, 1) and closes[i - 1] != 0:
            score, u = 0.0, i - lag
            if place - lag >= n:
                change = 100.0 * (closes[u] / closes[u - n] - 1) if closes[u - n] != 0 else 0.0
                score = 1.0 if change > cfg.roc_threshold else 0.0
            bucket = math.trunc(score * cfg.signal_scale)
            if not (cfg.ignore_signals and bucket in cfg.ignore_signals):
                held = "Buy" if score >= cfg.signal_threshold else "Sell"
            shown = "Cash" if cfg.hold_signals and bucket in cfg.hold_signals else held
        bars[i][3:] = held, score, shown


def trimmed(bars: list[list], gone: int, before: list, first: int) -> tuple[int, list, list[list]]:
    """State without the bars in front of ``first``, of which the number, the signal held and the last row are kept."""
    for b in bars[:first]:
        gone, before = gone + 1, [b[3], *((b[0], b[4], b[5]) if b[4] is not None else before[1:])]
    return gone, list(before), bars[first:]
