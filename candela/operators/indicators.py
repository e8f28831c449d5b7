"""Unbounded-frame operators (SCN): cumulative sums/products, forward fill, Wilder indicators, EWMA.

Wilder smoothing (RSI, ATR, ADX) and EWMA are affine recurrences ``y_t = a*y_{t-1} + c_t``; they run
on ``series.affine_scan`` (blocked, parallel over symbol x sub-block). Definitions follow Wilder (1978)
as in the public TA-Lib functions: RSI and ATR first value at bar n (seed = mean of the first n
inputs), ADX first value at bar 2n-1, zero tests exact (quirk Q23).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.functions.scalar import col, div, lag
from candela.operators.features import ensure_indexed, rolling
from candela.operators.series import KEYS, affine_map_scan, affine_scan, at_pos, from_pos, running


def ffill(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """SCN-3: forward fill (last non-NULL value so far)."""
    df = ensure_indexed(df, keys)
    return running(df, [(c, "last", c) for c in cols], keys)


def cum_sum(df: DataFrame, c: str, out: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """SCN-2."""
    return running(ensure_indexed(df, keys), [(c, "sum", out)], keys)


def cum_product(df: DataFrame, c: str, out: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """SCN-1: running product; NULL inputs are skipped (the leading NULL of DR stays NULL, Q6)."""
    return running(ensure_indexed(df, keys), [(c, "product", out)], keys)


def grow(df: DataFrame, r: str, cash: float, out: str = "account", keys: Sequence[str] = KEYS) -> DataFrame:
    """SCN-4: account value cash * prod(1 + r)."""
    df = running(ensure_indexed(df, keys), [(F.lit(1.0) + F.col(r), "product", "_g")], keys)
    return df.withColumn(out, F.lit(float(cash)) * F.col("_g")).drop("_g")


def _wilder_specs(u: str, n: int, out: str, coef: float) -> tuple:
    """Scan spec for a Wilder recurrence whose seed value sits in column ``_seed_<out>`` on the seed
    row (flag ``_at_<out>``) and which runs on rows flagged ``_after_<out>``."""
    c = (F.when(F.col(f"_at_{out}"), F.col(f"_seed_{out}"))
         .when(F.col(f"_after_{out}"), F.lit(coef) * F.col(u)).otherwise(F.lit(0.0)))
    return (c, (n - 1) / n, out)


def _seed_cols(u: str, out: str, seed_pos: int, width: int, agg) -> dict:
    """Flags and seed for a recurrence seeded at 0-based position ``seed_pos`` with ``agg`` over the
    ``width`` rows ending there (halo ``seed_pos + 1``)."""
    return {
        f"_at_{out}": lambda w: at_pos(w, seed_pos),
        f"_after_{out}": lambda w: from_pos(w, seed_pos + 1),
        f"_seed_{out}": lambda w: F.when(F.col(f"_at_{out}"), agg(col(u)).over(w.rowsBetween(-(width - 1), 0))),
    }


def _mask(df: DataFrame, out: str) -> DataFrame:
    return (df.withColumn(out, F.when(F.col(f"_at_{out}") | F.col(f"_after_{out}"), F.col(out)))
            .drop(f"_at_{out}", f"_after_{out}", f"_seed_{out}"))


def rsi(df: DataFrame, n: int = 14, c: str = "close", out: str = "RSI", keys: Sequence[str] = KEYS) -> DataFrame:
    """SCN-5: RSI(n) = 100*G/(G+L) with Wilder-smoothed gains and losses (0 when G+L = 0)."""
    df = ensure_indexed(df, keys)
    cols = {"_d": lambda w: col(c) - lag(c, 1, w),
            "_g": lambda w: F.greatest(F.col("_d"), F.lit(0.0)),
            "_l": lambda w: F.greatest(-F.col("_d"), F.lit(0.0))}
    cols.update(_seed_cols("_g", "_G", n, n, F.avg))
    cols.update(_seed_cols("_l", "_L", n, n, F.avg))
    df = rolling(df, cols, back=n + 1, keys=keys)
    df = affine_scan(df, [_wilder_specs("_g", n, "_G", 1.0 / n), _wilder_specs("_l", n, "_L", 1.0 / n)], keys)
    df = _mask(_mask(df, "_G"), "_L")
    s = F.col("_G") + F.col("_L")
    df = df.withColumn(out, F.when(s == 0, F.lit(0.0)).otherwise(F.lit(100.0) * F.col("_G") / s))
    return df.drop("_d", "_g", "_l", "_G", "_L")


def _true_range(w, high="high", low="low", close="close") -> Column:
    pc = lag(close, 1, w)
    return F.greatest(col(high) - col(low), F.abs(col(high) - pc), F.abs(col(low) - pc))


def atr(df: DataFrame, n: int = 14, out: str = "ATR", keys: Sequence[str] = KEYS) -> DataFrame:
    """SCN-6: ATR(n) = Wilder mean of the true range (TR from bar 1; first value at bar n)."""
    df = ensure_indexed(df, keys)
    cols = {"_tr": _true_range}
    cols.update(_seed_cols("_tr", out, n, n, F.avg))
    df = rolling(df, cols, back=n + 1, keys=keys)
    df = affine_scan(df, [_wilder_specs("_tr", n, out, 1.0 / n)], keys)
    return _mask(df, out).drop("_tr")


def adx(df: DataFrame, n: int = 14, out: str = "ADX", keys: Sequence[str] = KEYS) -> DataFrame:
    """SCN-7: ADX(n).

    +DM/-DM/TR are summed over bars 1..n-1 and then smoothed ``S = S - S/n + x``; DI = 100*DM/TR;
    DX = 100*|DI+ - DI-|/(DI+ + DI-). ADX at bar 2n-1 is the mean of DX over bars n..2n-1 (an
    undefined DX counts 0); later ADX = (ADX*(n-1) + DX)/n, and a bar with undefined DX (TR = 0 or
    DI+ + DI- = 0) keeps the previous ADX: the identity among the affine maps of the scan.
    """
    return adx_many(df, {n: out}, keys)


def adx_many(df: DataFrame, outs: dict[int, str], keys: Sequence[str] = KEYS) -> DataFrame:
    """SCN-7 for several periods (``outs``: period -> column): all share two halo stages and two scans that carry one
    state per period."""
    keys = list(keys)
    if not outs or min(outs) < 2:
        raise ValueError("adx needs n >= 2")
    df = ensure_indexed(df, keys)
    cols = {
        "_dp": lambda w: F.col("high") - lag("high", 1, w),
        "_dm": lambda w: lag("low", 1, w) - F.col("low"),
        "_mdm": lambda w: F.when((F.col("_dm") > 0) & (F.col("_dp") < F.col("_dm")), F.col("_dm")).otherwise(F.lit(0.0)),
        "_pdm": lambda w: F.when((F.col("_mdm") == 0) & (F.col("_dp") > 0) & (F.col("_dp") > F.col("_dm")),
                                 F.col("_dp")).otherwise(F.lit(0.0)),
        "_tr": _true_range,
    }
    sums = [("_pdm", "_SP"), ("_mdm", "_SM"), ("_tr", "_ST")]
    for n, out in outs.items():
        for src, dst in sums:
            cols.update(_seed_cols(src, f"{dst}{n}", n - 1, n - 1, F.sum))
        cols.update({f"_fdx{n}": _from(n), f"_at_{out}": _at(2 * n - 1), f"_after_{out}": _from(2 * n)})
    far = max(outs)
    df = rolling(df, cols, back=2 * far + 1, keys=keys)
    df = affine_scan(df, [_wilder_specs(s, n, f"{d}{n}", 1.0) for n in outs for s, d in sums], keys)
    for n in outs:
        di_p, di_m = (F.lit(100.0) * div(F.col(f"{d}{n}"), F.col(f"_ST{n}")) for d in ("_SP", "_SM"))
        defined = (F.col(f"_ST{n}") != 0) & ((di_p + di_m) != 0)
        dx = F.when(defined, F.lit(100.0) * F.abs(di_p - di_m) / (di_p + di_m)).otherwise(F.lit(0.0))
        df = df.withColumns({f"_dx{n}": F.when(F.col(f"_fdx{n}"), dx), f"_def{n}": F.coalesce(defined, F.lit(False))})
    df = rolling(df, {f"_seed_{out}": _seed(f"_at_{out}", f"_dx{n}", n) for n, out in outs.items()}, back=far - 1, keys=keys)
    specs = []
    for n, out in outs.items():
        contrib, a, _ = _wilder_specs(f"_dx{n}", n, out, 1.0 / n)
        specs.append((F.when(F.col(f"_at_{out}") | F.col(f"_def{n}"), contrib), a, F.col(f"_after_{out}") & F.col(f"_def{n}"), out))
    df = affine_map_scan(df, specs, keys)
    for out in outs.values():
        df = _mask(df, out)
    return df.drop("_dp", "_dm", "_pdm", "_mdm", "_tr", *[f"{c}{n}" for n in outs for c in ("_SP", "_SM", "_ST", "_dx", "_def", "_fdx")],
                   *[f"_{k}_{d}{n}" for n in outs for k in ("at", "after", "seed") for _, d in sums])


def _from(k: int):
    return lambda w: from_pos(w, k)


def _at(k: int):
    return lambda w: at_pos(w, k)


def _seed(at: str, dx: str, n: int):
    return lambda w: F.when(F.col(at), F.avg(dx).over(w.rowsBetween(-(n - 1), 0)))


def ewma(df: DataFrame, c: str, span: float, out: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """SCN-8: exponentially weighted mean with normalised weights (pandas ``adjust=True``):
    sum w^(t-k) x_k / sum w^(t-k) over non-missing x, w = 1 - 2/(span+1)."""
    df = ensure_indexed(df, keys)
    w = 1.0 - 2.0 / (span + 1.0)
    df = affine_scan(df, [(F.col(c), w, "_num"),
                          (F.when(F.col(c).isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0)), w, "_den")], keys)
    return df.withColumn(out, div(F.col("_num"), F.col("_den"))).drop("_num", "_den")
