"""ROC-rule parameter sweeps by block summaries (SWP-1, SWP-3).

A trade's returns telescope: whatever happens between its bars, it multiplies the strategy's value by its net value at its
last bar. So what a block of bars does under one parameter set is a small summary: its first run of equal signals (part of
a trade that may have begun before), the product of the trades that lie inside, and its last run (which may go on). Summaries
merge in order, and merging is associative, so blocks of one symbol are summarised in any task and folded by levels.

A task gets one block of bars with the halo rows its look-backs need and evaluates every parameter set on the block's
columns with NumPy. Only summaries leave it: one row per (symbol, block, parameter set). Bars x parameters is never a
frame. The parameter grid is a fixed-size argument.

This holds for signals that depend on closes alone: no stops, targets, sizing, ignored or held score buckets and no risk-off
adjustment (``summarisable``); other configurations take the general path of ``portfolio``. A trade whose net value touches
exactly 0 on the way is taken at its last value.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.config import StrategyConfig
from candela.functions.scalar import div, product
from candela.operators.features import ensure_indexed, rolling
from candela.operators.series import BLK, RN, block_rows, running
from candela.session import materialize

FOLD_BLOCKS = 4096
RUN = "{0}_buy boolean, {0}_open double, {0}_close double, {0}_len long"
SUMMARY = f"param_id int, blk long, n long, whole boolean, prod double, {RUN.format('f')}, {RUN.format('l')}"
NAMES = [c.split()[0] for c in SUMMARY.split(", ")]


def summarisable(cfg: StrategyConfig) -> bool:
    return not (cfg.buy_sl or cfg.sell_sl or cfg.buy_tp or (cfg.sell_tp and cfg.short) or cfg.adjust_signal or cfg.position_sizing
                or cfg.ignore_signals or cfg.hold_signals)


def net_value(buy, open_, close, length, cfg: StrategyConfig):
    """Factor of a finished trade after fees and margin (Column or numpy operands). A return that needs a missing entry
    price (0) is undefined and counts as 1."""
    column = isinstance(buy, Column)
    if column:
        ratio = div(close, open_)
    else:
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(open_ == 0, np.nan, close / open_)
    lf = cfg.open_fee
    bought = ratio - (lf + ratio * lf)
    other = 2.0 - ratio if cfg.short else F.lit(1.0) if column else np.ones(len(ratio))
    sold = other - (lf + other * lf) if cfg.short or cfg.breakout else other
    if cfg.short:
        sold = sold - (cfg.margin_open + cfg.margin * length)
    if column:
        return F.coalesce(F.when(buy, bought).otherwise(sold), F.lit(1.0))
    value = np.where(buy, bought, sold)
    return np.where(np.isnan(value), 1.0, value)


class Grid:
    """Parameter sets as tasks need them."""

    def __init__(self, grid: Sequence[dict], cfg: StrategyConfig):
        self.sets = [(i, int(p["period"]), float(p["threshold"]), int(p["delay"])) for i, p in enumerate(grid)]
        self.first = sorted({self.start(p, d) for _, p, _, d in self.sets})
        self.back = max(d for *_, d in self.sets) + 1 + max(p for _, p, _, _ in self.sets)
        self.warm = 2 * cfg.adx_period - 1
        self.up, self.down = (bool(s >= cfg.signal_threshold) for s in (1.0, 0.0))

    @staticmethod
    def start(period: int, delay: int) -> int:
        """The first bar with a return, a rate of change and a score."""
        return max(period, delay + 1, 1)


def _change(close: np.ndarray, period: int) -> np.ndarray:
    out = np.full(len(close), np.nan)
    if period < len(close):
        now, then = close[period:], close[: len(close) - period]
        with np.errstate(divide="ignore", invalid="ignore"):
            out[period:] = np.where(then == 0, 0.0, 100.0 * (now / then - 1))
    return out


def block_summaries(rn, open_, close, kept, count, home, skipped, grid: Grid, cfg: StrategyConfig) -> dict[str, list]:
    """Summaries of one block under every parameter set. Arrays are in bar order; ``kept``: the bar has a return; ``count``:
    bars with one so far; ``skipped``: for each value of ``grid.first`` the bars with a return before it, or None where
    every set is under way."""
    out: dict[str, list] = {n: [] for n in NAMES}
    use = np.flatnonzero(home & kept)
    if not len(use):
        return out
    opens, closes, counts = open_[use], close[use], count[use]
    changes = {p: _change(close, p) for p in {s[1] for s in grid.sets}}
    for i, period, threshold, delay in grid.sets:
        lo = 0
        if skipped is not None:
            lo = int(np.searchsorted(counts, grid.warm + skipped[grid.first.index(grid.start(period, delay))], "right"))
        if lo >= len(use):
            continue
        at = use[lo:] - (delay + 1)
        rose = np.zeros(len(at), bool)
        rose[at >= 0] = changes[period][at[at >= 0]] > threshold
        buy = np.where(rose, grid.up, grid.down)
        o, c = opens[lo:], closes[lo:]
        head = np.concatenate(([0], np.flatnonzero(buy[1:] != buy[:-1]) + 1))
        tail = np.concatenate((head[1:], [len(buy)])) - 1
        product = 1.0
        if len(head) > 2:
            h, t = head[1:-1], tail[1:-1]
            product = float(np.prod(net_value(buy[h], o[h], c[t], t - h + 1, cfg)))
        row = (i, None, len(buy), len(head) == 1, product, *[v for k in (0, -1) for v in (bool(buy[head[k]]), o[head[k]], c[tail[k]], int(tail[k] - head[k] + 1))])
        for n, v in zip(NAMES, row):
            out[n].append(v)
    return out


def _merged(a: Column, b: Column, cfg: StrategyConfig) -> Column:
    """Summary of two stretches, ``b`` right after ``a``."""
    def run(open_of: Column, x: str, close_of: Column, y: str, length: Column):
        return {"open": open_of[f"{x}_open"], "close": close_of[f"{y}_close"], "len": length}

    def done(buy: Column, r: dict) -> Column:
        return net_value(buy, r["open"], r["close"], r["len"], cfg)

    same = a["l_buy"] == b["f_buy"]
    joint = run(a, "l", b, "f", a["l_len"] + b["f_len"])
    ends, begins = run(a, "l", a, "l", a["l_len"]), run(b, "f", b, "f", b["f_len"])
    one = F.lit(1.0)
    apart = F.when(a["whole"], one).otherwise(done(a["l_buy"], ends)) * F.when(b["whole"], one).otherwise(done(b["f_buy"], begins))
    between = F.when(same, F.when(a["whole"] | b["whole"], one).otherwise(done(a["l_buy"], joint))).otherwise(apart)
    first = {k: F.when(same & a["whole"], joint[k]).otherwise(a[f"f_{k}"]) for k in ("open", "close", "len")}
    last = {k: F.when(same & b["whole"], joint[k]).otherwise(b[f"l_{k}"]) for k in ("open", "close", "len")}
    return F.struct((a["n"] + b["n"]).alias("n"), (same & a["whole"] & b["whole"]).alias("whole"), (a["prod"] * between * b["prod"]).alias("prod"),
                    a["f_buy"].alias("f_buy"), *[first[k].alias(f"f_{k}") for k in first],
                    b["l_buy"].alias("l_buy"), *[last[k].alias(f"l_{k}") for k in last])


def _folded(summaries: DataFrame, keys: list[str], cfg: StrategyConfig) -> DataFrame:
    """Summaries per ``keys``, merged in the order of ``blk``."""
    rest = [n for n in NAMES if n not in ("param_id", "blk")]
    listed = summaries.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("blk", F.struct(*rest).alias("s")))).alias("_l"))
    parts = F.transform("_l", lambda e: e["s"])
    merged = F.aggregate(F.slice(parts, F.lit(2), F.size("_l")), F.element_at(parts, 1), lambda a, b: _merged(a, b, cfg))
    return listed.select(*keys, merged.alias("s")).select(*keys, "s.*")


def roc_sweep_by_blocks(bars: DataFrame, grid: Sequence[dict], cfg: StrategyConfig) -> DataFrame:
    """SWP-1/SWP-3: final CSR and loss per (symbol, parameter set)."""
    if not summarisable(cfg):
        raise ValueError("this configuration needs the bar-level P&L")
    g = Grid(grid, cfg)
    b = ensure_indexed(bars).select("symbol", "bar_ts", RN, BLK, "open", "close")
    b = rolling(b, {"_kept": lambda w: div(F.col("close"), F.lag("close").over(w)).isNotNull()}, back=1)
    b = running(b, [(F.col("_kept").cast("int"), "sum", "_count")])
    # the bars with a return before each possible start matter to the first bars of a series only
    early = F.col("_count") <= g.warm + max(g.first)
    heads = b.filter(F.col(RN) < max(g.first)).groupBy("symbol").agg(
        F.array(*[F.sum(F.when((F.col(RN) < r) & F.col("_kept"), 1).otherwise(0)) for r in g.first]).alias("_skipped"))
    b = b.filter(early).join(heads, "symbol").unionByName(b.filter(~early).withColumn("_skipped", F.lit(None).cast("array<bigint>")))
    size = block_rows(b)
    lo, hi = F.col(BLK), F.floor((F.col(RN) + F.lit(g.back)) / F.lit(size)).cast("long")
    b = b.withColumn("_w", F.explode(F.sequence(lo, hi))).select("symbol", "_w", RN, "open", "close", "_kept", "_count", (F.col("_w") == F.col(BLK)).alias("_home"), "_skipped")

    def summarise(key, table):
        table = table.sort_by(RN)
        rn, open_, close, kept, count, home = (table.column(c).to_numpy() for c in (RN, "open", "close", "_kept", "_count", "_home"))
        skipped = next((s for s in table.column("_skipped").to_pylist() if s is not None), None) if len(rn) and count[0] <= g.warm + max(g.first) else None
        out = block_summaries(rn, open_.astype(float), close.astype(float), kept.astype(bool), count, home.astype(bool), skipped, g, cfg)
        n = len(out["n"])
        out["blk"] = [key[1].as_py()] * n
        kinds = {"boolean": pa.bool_(), "double": pa.float64(), "long": pa.int64(), "int": pa.int32()}
        return pa.table([pa.array([key[0].as_py()] * n, pa.string())] + [pa.array(out[c.split()[0]], kinds[c.split()[1]]) for c in SUMMARY.split(", ")], names=["symbol", *NAMES])

    blocks = materialize(b.groupBy("symbol", "_w").applyInArrow(summarise, f"symbol string, {SUMMARY}"))
    parts = _folded(blocks.withColumn("_g", F.floor(F.col("blk") / FOLD_BLOCKS)), ["symbol", "param_id", "_g"], cfg).withColumnRenamed("_g", "blk")
    s = _folded(parts, ["symbol", "param_id"], cfg)

    def done(x: str) -> Column:
        return net_value(F.col(f"{x}_buy"), F.col(f"{x}_open"), F.col(f"{x}_close"), F.col(f"{x}_len"), cfg)

    csr = F.when(F.col("whole"), done("f")).otherwise(done("f") * F.col("prod") * done("l"))
    return s.select("symbol", "param_id", csr.alias("CSR")).withColumn("loss", -F.col("CSR"))


def basket_sweep(bars: DataFrame, grid: Sequence[dict], cfg: StrategyConfig, n_assets: int) -> DataFrame:
    """SWP-1 with the basket's final return as the objective: per parameter set the signals of all assets form an equal-share
    basket (as ``portfolio.signal_basket``: bars where all assets have a return and a signal, 1 where none is bought); CSR and
    the equal-weight CMR are products over its bars.

    The rates of change that decide a bar's signals are made on the bars, one per distinct (period, delay); the assets of a
    bar time meet in one row, and every parameter set's return of that row goes straight into a partial product."""
    g = Grid(grid, cfg)
    b = ensure_indexed(bars).select("symbol", "bar_ts", RN, BLK, "close")
    pairs = sorted({(p, d) for _, p, _, d in g.sets})

    def change(p: int, d: int):
        def f(w):
            now, then = F.lag("close", d + 1).over(w), F.lag("close", d + 1 + p).over(w)
            return F.when(then.isNull(), None).when(then == 0, F.lit(0.0)).otherwise(F.lit(100.0) * (now / then - 1))
        return f

    b = rolling(b, {"DR": lambda w: div(F.col("close"), F.lag("close").over(w)), "_roc": lambda w: F.array(*[change(p, d)(w) for p, d in pairs])}, back=g.back)
    meet = b.filter(F.col("DR").isNotNull()).groupBy("bar_ts").agg(F.collect_list(F.struct(RN, "DR", "_roc")).alias("_a")).filter(F.size("_a") >= n_assets)
    sets = F.array(*[F.struct(F.lit(i).alias("param_id"), F.lit(pairs.index((p, d))).alias("at"), F.lit(t).alias("threshold"), F.lit(g.start(p, d)).alias("first")) for i, p, t, d in g.sets])
    x = meet.withColumn("_p", F.explode(sets)).withColumn("_a", F.filter("_a", lambda a: a[RN] >= F.col("_p.first"))).filter(F.size("_a") == n_assets)
    scores = F.transform("_a", lambda a: F.struct(a["DR"].alias("DR"), F.coalesce(F.get(a["_roc"], F.col("_p.at")) > F.col("_p.threshold"), F.lit(False)).alias("buy")))
    x = x.select(F.col("_p.param_id").alias("param_id"), scores.alias("_s"))
    total = F.aggregate("_s", F.lit(0.0), lambda t, s: t + s["DR"])
    picked = F.aggregate("_s", F.lit(0.0), lambda t, s: t + F.when(s["buy"], s["DR"]).otherwise(0.0))
    buys = F.size(F.filter("_s", lambda s: s["buy"]))
    x = x.select("param_id", F.when(buys > 0, picked / buys).otherwise(F.lit(1.0)).alias("_sr"), (total / n_assets).alias("_dr"))
    r = x.groupBy("param_id").agg(product(F.col("_sr")).alias("CSR"), product(F.col("_dr")).alias("CMR"), F.count(F.lit(1)).alias("n_bars"))
    return r.withColumn("loss", -F.col("CSR"))
