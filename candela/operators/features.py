"""Per-bar projections (PRJ), filters (FLT) and finite-frame window features (WIN).

Every windowed feature runs inside ``halo_stage``: a window over ``(symbol, block)`` plus the halo
rows it needs, so a hot symbol is spread over many tasks. Whole-series aggregates (first value,
maximum, mean) are ``groupBy`` aggregates joined back, never a window over a whole symbol.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.functions.scalar import col, div, encode_cyclical, full, lag, lead, pivot_points
from candela.operators.series import KEYS, RN, dropna_dense, halo_stage, index_series

ColumnFn = Callable[[Window], Column]


def ensure_indexed(df: DataFrame, keys: Sequence[str] = KEYS, order: str = "bar_ts") -> DataFrame:
    return df if RN in df.columns else index_series(df, keys, order)


def rolling(df: DataFrame, columns: dict[str, ColumnFn] | list[tuple[str, ColumnFn]], back: int, fwd: int = 0,
            keys: Sequence[str] = KEYS) -> DataFrame:
    """Add columns defined over the per-block window ``w`` in one halo stage (one shuffle).

    Later entries may use (or redefine) earlier ones; ``back``/``fwd`` bound the total reach of the chain.
    """
    df = ensure_indexed(df, keys)
    steps = list(columns.items()) if isinstance(columns, dict) else list(columns)

    def build(x, w):
        for name, fn in steps:
            x = x.withColumn(name, fn(w))
        return x

    return halo_stage(df, build, back, fwd, keys)


def whole_series(df: DataFrame, aggs: dict[str, Column], keys: Sequence[str] = KEYS) -> DataFrame:
    """Attach per-symbol aggregates (partial aggregation, then a join on the key)."""
    stats = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return df.join(stats, on=list(keys), how="left")


# --- expression builders (used by operators, the feature bank and the P&L plan) ----------------

def e_gross_return(c="close") -> ColumnFn:
    return lambda w: div(col(c), lag(c, 1, w))


def e_sma(c, n) -> ColumnFn:
    return lambda w: full(F.avg, c, w, n)


def e_ratio_to(c, agg, src, n) -> ColumnFn:
    return lambda w: div(col(c), full(agg, src, w, n))


def e_std_samp(c, n) -> ColumnFn:
    return lambda w: full(F.stddev_samp, c, w, n)


def e_williams_r(n, high="high", low="low", close="close") -> ColumnFn:
    """TA-Lib WILLR: -100*(HH-close)/(HH-LL), 0 when HH == LL; first value at bar n-1."""
    def f(w):
        hh, ll = full(F.max, high, w, n), full(F.min, low, w, n)
        return F.when(hh.isNull() | ll.isNull(), F.lit(None).cast("double")) \
            .when(hh == ll, F.lit(0.0)).otherwise(F.lit(-100.0) * (hh - col(close)) / (hh - ll))
    return f


def e_roc(n, c="close") -> ColumnFn:
    """TA-Lib ROC: 100*(close/close[-n]-1); 0 when the earlier close is 0."""
    def f(w):
        prev = lag(c, n, w)
        return F.when(prev.isNull(), F.lit(None).cast("double")).when(prev == 0, F.lit(0.0)) \
            .otherwise(F.lit(100.0) * (col(c) / prev - 1))
    return f


# --- PRJ ----------------------------------------------------------------------------------------

def gross_return(df: DataFrame, c="close", out="DR") -> DataFrame:
    """PRJ-1: DR = close / close[-1]."""
    return rolling(df, {out: e_gross_return(c)}, back=1)


def pct_change(df: DataFrame, c="close", out="pct", future_out: str | None = None) -> DataFrame:
    """PRJ-2: x/x[-1]-1; with ``future_out`` also the forward change x[+1]/x - 1 (NULL on the last bar).
    Gaps should be forward-filled first (``indicators.ffill``)."""
    cols = {out: lambda w: div(col(c), lag(c, 1, w)) - 1}
    if future_out:
        cols[future_out] = lambda w: div(lead(c, 1, w), col(c)) - 1
    return rolling(df, cols, back=1, fwd=1 if future_out else 0)


def log_return(df: DataFrame, c="close", out="log_ret") -> DataFrame:
    """PRJ-3."""
    return rolling(df, {out: lambda w: F.ln(div(col(c), lag(c, 1, w)))}, back=1)


def diff0(df: DataFrame, c="close", out="diff") -> DataFrame:
    """PRJ-4: close - close[-1], 0 on the first bar."""
    return rolling(df, {out: lambda w: F.coalesce(col(c) - lag(c, 1, w), F.lit(0.0))}, back=1)


def lag_features(df: DataFrame, c="close", k: int = 5, prefix="lag", as_array: str | None = None) -> DataFrame:
    """PRJ-5: lag_1..lag_k and optionally an ARRAY<DOUBLE> of them (oldest first)."""
    cols = {f"{prefix}_{i}": (lambda i: lambda w: lag(c, i, w))(i) for i in range(1, k + 1)}
    out = rolling(df, cols, back=k)
    if as_array:
        out = out.withColumn(as_array, F.array(*[F.col(f"{prefix}_{i}") for i in range(k, 0, -1)]))
    return out


def lagged_return_frame(df: DataFrame, lags: int = 5, c="close", v="volume") -> DataFrame:
    """PRJ-6: percent returns of today and of lags 1..k, Volume, Direction = sign(Today).
    Quirk Q17: |Today| < 1e-4 becomes +1e-4 (even when negative). Rows with a missing value dropped."""
    def pct(i):
        return lambda w: F.lit(100.0) * (div(lag(c, i, w), lag(c, i + 1, w)) - 1)
    cols = {"Today": lambda w: F.lit(100.0) * (div(col(c), lag(c, 1, w)) - 1)}
    for i in range(1, lags + 1):
        cols[f"Lag{i}"] = pct(i)
    out = rolling(df, cols, back=lags + 1)
    out = out.withColumn("Today", F.when(F.abs("Today") < 1e-4, F.lit(1e-4)).otherwise(F.col("Today")))
    out = out.withColumn("Volume", F.col(v)).withColumn("Direction", F.signum("Today"))
    return out.dropna(subset=["Today", *[f"Lag{i}" for i in range(1, lags + 1)]])


def next_bar_target(df: DataFrame, src="DR", out="target") -> DataFrame:
    """PRJ-7: the next bar's value as target; the last bar (no target) is excluded."""
    return rolling(df, {out: lambda w: lead(src, 1, w)}, back=0, fwd=1).filter(F.col(out).isNotNull())


def price_rise(c: str | Column = "DR") -> Column:
    """PRJ-8: 1 when DR > 1 else 0 (missing DR -> 0)."""
    return F.when(col(c) > 1, F.lit(1)).otherwise(F.lit(0))


def with_cyclical(df: DataFrame, c: str, max_val: float) -> DataFrame:
    """PRJ-9."""
    s, co = encode_cyclical(c, max_val)
    return df.withColumn(f"{c}_sin", s).withColumn(f"{c}_cos", co)


def with_pivots(df: DataFrame) -> DataFrame:
    """PRJ-11."""
    for k, v in pivot_points().items():
        df = df.withColumn(k, v)
    return df


def weekday_dummies(df: DataFrame, ts="bar_ts", prefix="weekday") -> DataFrame:
    """PRJ-13: dummies for weekday 1..6 (0 = Monday is the dropped level)."""
    wd = F.weekday(F.col(ts))
    for i in range(1, 7):
        df = df.withColumn(f"{prefix}_{i}", (wd == i).cast("int"))
    return df


def normalize_curve(df: DataFrame, c="close", keys: Sequence[str] = KEYS) -> DataFrame:
    """PRJ-14: value / first value and value / maximum, per symbol (aggregate + join)."""
    df = ensure_indexed(df, keys)
    out = whole_series(df, {"_first": F.min_by(col(c), F.col(RN)), "_max": F.max(col(c)),
                            "_min": F.min(col(c))}, keys)
    return (out.withColumn(f"{c}_rel_first", div(col(c), F.col("_first")))
            .withColumn(f"{c}_rel_max", div(col(c), F.col("_max")))
            .withColumn(f"{c}_minmax", div(col(c) - F.col("_min"), F.col("_max") - F.col("_min")))
            .drop("_first", "_max", "_min"))


def nan_to_zero(c: str | Column) -> Column:
    """PRJ-15: missing (NULL or NaN) -> 0."""
    x = col(c)
    return F.coalesce(F.nanvl(x, F.lit(0.0)), F.lit(0.0))


def date_parts(df: DataFrame, ts="bar_ts") -> DataFrame:
    """PRJ-17."""
    t = F.col(ts)
    return (df.withColumn("year_month", F.date_format(t, "yyyy-MM"))
            .withColumn("month_num", F.date_format(t, "MM")).withColumn("month", F.month(t))
            .withColumn("weekday", F.weekday(t)))


def month_end(c: str | Column) -> Column:
    """PRJ-18: month-end of a month-start date."""
    return F.last_day(col(c))


def daily_change(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """PRJ-19: close - open, and each of close/open/high/low as % deviation from its range mean."""
    out = whole_series(df, {f"_m_{c}": F.avg(c) for c in ("open", "high", "low", "close")}, keys)
    out = out.withColumn("daily_change", F.col("close") - F.col("open"))
    for c in ("open", "high", "low", "close"):
        out = out.withColumn(f"{c}_pct_of_mean", F.lit(100.0) * div(F.col(c) - F.col(f"_m_{c}"), F.col(f"_m_{c}")))
    return out.drop(*[f"_m_{c}" for c in ("open", "high", "low", "close")])


# --- FLT ----------------------------------------------------------------------------------------

def drop_warmup(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT-1: drop rows where any of ``cols`` is missing (positions stay dense, see dropna_dense)."""
    return dropna_dense(df, cols)


def positive_volume(df: DataFrame, v="volume") -> DataFrame:
    """FLT-2."""
    return df.filter(F.col(v) > 0)


def trim_range(df: DataFrame, start: str | None = None, end: str | None = None, ts="bar_ts") -> DataFrame:
    """FLT-3: inclusive date range; a missing bound defaults to the data's own min/max (no filter)."""
    cond = F.lit(True)
    if start:
        cond = cond & (F.col(ts) >= F.to_timestamp(F.lit(start)).cast("timestamp_ntz"))
    if end:
        cond = cond & (F.col(ts) <= F.to_timestamp(F.lit(end)).cast("timestamp_ntz"))
    return df.filter(cond)


def remove_weekends(df: DataFrame, ts="bar_ts", compat: bool = False) -> DataFrame:
    """FLT-4: drop Saturday and Sunday. ``compat`` reproduces quirk Q13 (only Saturday dropped)."""
    wd = F.weekday(F.col(ts))
    return df.filter(wd != 5) if compat else df.filter(wd < 5)


def chrono_split(df: DataFrame, train_pct: float = 0.8, test_pct: float = 0.2, test_bars: int = 0,
                 keys: Sequence[str] = KEYS) -> DataFrame:
    """FLT-5: flags ``is_train`` (first floor(n*train_pct) bars) and ``is_test`` (last test_bars, or
    last floor(n*test_pct)); the two may overlap (Q25); a test size of 0 selects nothing."""
    df = ensure_indexed(df, keys)
    out = whole_series(df, {"_n": F.count(F.lit(1)), "_r0": F.min(RN)}, keys)
    pos = F.col(RN) - F.col("_r0")
    n_train = F.floor(F.col("_n") * F.lit(train_pct))
    n_test = F.lit(test_bars) if test_bars > 0 else F.floor(F.col("_n") * F.lit(test_pct))
    return (out.withColumn("is_train", pos < n_train)
            .withColumn("is_test", pos >= F.col("_n") - n_test).drop("_n", "_r0"))


def date_split(df: DataFrame, cutoff: str, years: int = 0, ts="bar_ts") -> DataFrame:
    """FLT-6: ``is_train`` before the cut-off (within ``years`` before it when > 0), ``is_test`` from it."""
    cut = F.to_timestamp(F.lit(cutoff)).cast("timestamp_ntz")
    train = F.col(ts) < cut
    if years > 0:
        train = train & (F.col(ts) >= F.add_months(cut, -12 * years).cast("timestamp_ntz"))
    return df.withColumn("is_train", train).withColumn("is_test", F.col(ts) >= cut)


# --- WIN ----------------------------------------------------------------------------------------

def rel_volume(df, n=30, out="VOL"):
    """WIN-1: volume / SMA(volume, n)."""
    return rolling(df, {out: e_ratio_to("volume", F.avg, "volume", n)}, back=n - 1)


def high_ratio(df, n=50, out="HH"):
    """WIN-2: high / rolling max(high, n)."""
    return rolling(df, {out: e_ratio_to("high", F.max, "high", n)}, back=n - 1)


def low_ratio(df, n=50, out="LL"):
    """WIN-3: low / rolling min(low, n)."""
    return rolling(df, {out: e_ratio_to("low", F.min, "low", n)}, back=n - 1)


def ma_ratio(df, n=50):
    """WIN-4: MA = close/SMA(n), MA2 = close/SMA(2n)."""
    return rolling(df, {"MA": e_ratio_to("close", F.avg, "close", n),
                        "MA2": e_ratio_to("close", F.avg, "close", 2 * n)}, back=2 * n - 1)


def sma_family(df, n=20, m=50):
    """WIN-5: SMA raw, SMA / close, and the spread of two SMAs."""
    return rolling(df, {f"SMA{n}": e_sma("close", n), f"SMA{m}": e_sma("close", m),
                        f"SMA{n}_rel": lambda w: div(full(F.avg, "close", w, n), F.col("close")),
                        "SMA_spread": lambda w: full(F.avg, "close", w, n) - full(F.avg, "close", w, m)},
                   back=max(n, m) - 1)


def rel_std(df, n=7, out="STD"):
    """WIN-6: rolling sample std of close / close."""
    return rolling(df, {out: lambda w: div(full(F.stddev_samp, "close", w, n), F.col("close"))}, back=n - 1)


def ma_change(df, n=50):
    """WIN-7: DMA = MA / MA[-1], MAR = MA / MA2."""
    return rolling(df, {"MA": e_ratio_to("close", F.avg, "close", n),
                        "MA2": e_ratio_to("close", F.avg, "close", 2 * n),
                        "DMA": lambda w: div(F.col("MA"), F.lag("MA", 1).over(w)),
                        "MAR": lambda w: div(F.col("MA"), F.col("MA2"))}, back=2 * n)


def avg_return(df, n=20, out="ADR"):
    """WIN-8: DR and its rolling mean."""
    return rolling(df, {"DR": e_gross_return(), out: e_sma("DR", n)}, back=n)


def williams_r(df, n=7, out="WR"):
    """WIN-9."""
    return rolling(df, {out: e_williams_r(n)}, back=n - 1)


def roc(df, n=10, out="ROC"):
    """WIN-10."""
    return rolling(df, {out: e_roc(n)}, back=n)


def volume_change(df, n=5):
    """WIN-12: volume % change and its n-bar SMA."""
    return rolling(df, {"vol_change": lambda w: div(F.col("volume"), lag("volume", 1, w)) - 1,
                        "vol_change_sma": e_sma("vol_change", n)}, back=n)


def detrend(df, n=100, out="detrended"):
    """WIN-13: close - rolling mean(n)."""
    return rolling(df, {out: lambda w: F.col("close") - full(F.avg, "close", w, n)}, back=n - 1)


def prior_channel(df, n=5):
    """WIN-15: max/min/mean of the previous n closes (current bar excluded)."""
    def prior(agg):
        def f(w):
            fr = w.rowsBetween(-n, -1)
            return F.when(F.count("close").over(fr) >= n, agg("close").over(fr))
        return f
    return rolling(df, {"ch_high": prior(F.max), "ch_low": prior(F.min), "ch_mean": prior(F.avg)}, back=n)


def bar_end(df, interval_minutes: int = 1440, out="date_to"):
    """WIN-18: next bar's timestamp; the last bar gets bar_ts + interval."""
    return rolling(df, {out: lambda w: F.coalesce(
        lead("bar_ts", 1, w), F.col("bar_ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(interval_minutes)))},
        back=0, fwd=1)


# --- long frames by doubling ----------------------------------------------------------------------

# parts of a summary by aggregate; a part is NULL as soon as one of its rows has no value, which is what a full frame asks
_PARTS = {"avg": ("mean",), "stddev_samp": ("mean", "m2"), "max": ("max",), "min": ("min",)}


def _both(part: str, a: dict[str, Column], b: dict[str, Column], na: int, nb: int) -> Column:
    """A part of the summary of two adjacent stretches of ``na`` and ``nb`` rows. Squared deviations merge about the means,
    so nothing cancels."""
    x, y = a[part], b[part]
    if part == "mean":
        return x + (y - x) * (nb / (na + nb))
    if part == "m2":
        d = b["mean"] - a["mean"]
        return x + y + d * d * (na * nb / (na + nb))
    return F.when(x.isNotNull() & y.isNotNull(), F.greatest(x, y) if part == "max" else F.least(x, y))


def doubling(x: DataFrame, w: Window, wants: Sequence[tuple[str, str, int, str]]) -> DataFrame:
    """Rolling aggregates ``(agg, column, n, out)`` over the last n rows (NULL unless all n values are there), with work per row
    that grows with log2 of the frames.

    Level k holds, at each row, the summary of the 2**k rows that end there: level k - 1 joined with itself 2**(k-1) rows
    back, one ``lag`` a part. A frame of n rows is put together from the levels of the bits of n, each lagged by the rows
    taken before. Each level is one window operator over the same partition and order. A halo of max(n) rows is needed.
    """
    parts: dict[tuple[str, int], set[str]] = {}
    for agg, c, n, _ in wants:
        parts.setdefault((c, n), set()).update(_PARTS[agg])
    tables = {(c, p): max(n for (k, n), q in parts.items() if k == c and p in q) for (c, _), ps in parts.items() for p in ps}
    start = {"mean": lambda c: c, "m2": lambda c: F.when(c.isNotNull(), 0.0), "max": lambda c: c, "min": lambda c: c}
    x = x.withColumns({f"_t_{c}_{p}": start[p](F.col(c).cast("double")) for c, p in tables})
    taken, size = dict.fromkeys(parts, 0), 1
    while size <= max(tables.values()):
        lags: dict[str, Column] = {}
        level: dict[str, Column] = {}

        def back(c: str, p: str, k: int, lags=lags) -> Column:
            if not k:
                return F.col(f"_t_{c}_{p}")
            lags[f"_l_{c}_{p}_{k}"] = F.lag(f"_t_{c}_{p}", k).over(w)
            return F.col(f"_l_{c}_{p}_{k}")

        for (c, n), ps in parts.items():
            if n & size:
                at = taken[c, n]
                old = {p: F.col(f"_f_{c}_{n}_{p}") for p in ps}
                new = {p: back(c, p, at) for p in ps}
                level.update({f"_f_{c}_{n}_{p}": _both(p, old, new, at, size) if at else new[p] for p in ps})
                taken[c, n] += size
        grow = [(c, p) for (c, p), n in tables.items() if n >= 2 * size]
        for c in {c for c, _ in grow}:
            ps = [p for k, p in grow if k == c]
            now, then = ({p: back(c, p, k) for p in ps} for k in (0, size))
            level.update({f"_t_{c}_{p}": _both(p, now, then, size, size) for p in ps})
        x = x.withColumns(lags).withColumns(level).drop(*lags)
        size *= 2
    read = {"avg": "mean", "max": "max", "min": "min"}
    x = x.withColumns({out: F.sqrt(F.col(f"_f_{c}_{n}_m2") / (n - 1)) if agg == "stddev_samp" and n > 1 else F.lit(None).cast("double")
                       if agg == "stddev_samp" else F.col(f"_f_{c}_{n}_{read[agg]}") for agg, c, n, out in wants})
    return x.drop(*[f"_t_{c}_{p}" for c, p in tables], *[f"_f_{c}_{n}_{p}" for (c, n), ps in parts.items() for p in ps])


def feature_bank(df, periods: Sequence[int] = (14, 30, 50, 100, 200)) -> DataFrame:
    """WIN-11: for each period n: ma (SMA/close), vol, hh, ll, std, wr - one halo stage for all
    finite-frame columns (RSI per period is added by ``indicators.rsi``). The rolling aggregates of all periods come
    from one set of doubling tables (hh, ll and wr share the rolling max/min) and the features are plain
    projections of those."""
    wants = [w for n in periods for w in (("avg", "close", n, f"_sma{n}"), ("avg", "volume", n, f"_vma{n}"), ("max", "high", n, f"_hhv{n}"),
                                          ("min", "low", n, f"_llv{n}"), ("stddev_samp", "close", n, f"_sd{n}"))]

    def build(x, w):
        return doubling(x.withColumn("pct_1d", div(F.col("close"), lag("close", 1, w)) - 1), w, wants)

    out = halo_stage(ensure_indexed(df), build, max(periods))
    for n in periods:
        hh, ll = F.col(f"_hhv{n}"), F.col(f"_llv{n}")
        out = out.withColumns({
            f"ma{n}": div(F.col(f"_sma{n}"), F.col("close")),
            f"vol{n}": div(F.col("volume"), F.col(f"_vma{n}")),
            f"hh{n}": div(F.col("high"), hh),
            f"ll{n}": div(F.col("low"), ll),
            f"std{n}": div(F.col(f"_sd{n}"), F.col("close")),
            f"wr{n}": F.when(hh.isNull() | ll.isNull(), F.lit(None).cast("double")).when(hh == ll, F.lit(0.0))
            .otherwise(F.lit(-100.0) * (hh - F.col("close")) / (hh - ll)),
        })
    return out.drop(*[w[3] for w in wants])


def base_features(df, sma_period=50, vol_period=30, hh_period=50, ll_period=50, std_period=7, wil_period=7):
    """The finite-frame part of the model feature frame: VOL HH LL DR MA MA2 STD WR DMA MAR. The long frames come from
    doubling tables."""
    back = max(2 * sma_period, vol_period, hh_period, ll_period, std_period, wil_period)
    wants = [("avg", "volume", vol_period, "_vma"), ("max", "high", hh_period, "_hhv"), ("min", "low", ll_period, "_llv"),
             ("avg", "close", sma_period, "_sma"), ("avg", "close", 2 * sma_period, "_sma2")]

    def build(x, w):
        x = doubling(x, w, wants).withColumns({
            "VOL": div(F.col("volume"), F.col("_vma")), "HH": div(F.col("high"), F.col("_hhv")), "LL": div(F.col("low"), F.col("_llv")),
            "DR": e_gross_return()(w), "MA": div(F.col("close"), F.col("_sma")), "MA2": div(F.col("close"), F.col("_sma2")),
            "STD": div(full(F.stddev_samp, "close", w, std_period), F.col("close")), "WR": e_williams_r(wil_period)(w)})
        return x.withColumns({"DMA": div(F.col("MA"), F.lag("MA", 1).over(w)), "MAR": div(F.col("MA"), F.col("MA2"))}).drop(*[v[3] for v in wants])

    return halo_stage(ensure_indexed(df), build, back + 1)


def calendar_days(bars: DataFrame, ts: str = "bar_ts") -> DataFrame:
    """Calendar side table (one row per bar day) with a degree column 0..359 (day number mod 360);
    stands in for the per-day body-position table the reference computes (JON-2, PRJ-9)."""
    days = bars.select(F.to_date(ts).alias("day")).distinct()
    return days.withColumn("deg", (F.datediff(F.col("day"), F.lit("1970-01-01")) % 360).cast("long"))


def seasonal_decompose(df: DataFrame, period: int = 30, c: str = "close", keys: Sequence[str] = KEYS) -> DataFrame:
    """WIN-14: additive decomposition. Trend = centred moving average (for an even period the two end
    points weigh one half); seasonal = mean detrended value per phase (position mod period), centred
    to mean zero; resid = x - trend - seasonal."""
    df = ensure_indexed(df, keys)
    h = period // 2

    def trend(w):
        if period % 2:
            fr = w.rowsBetween(-h, h)
            return F.when(F.count(c).over(fr) == period, F.avg(c).over(fr))
        inner = F.sum(c).over(w.rowsBetween(-(h - 1), h - 1))
        ends = lag(c, h, w) + lead(c, h, w)
        return F.when(lag(c, h, w).isNotNull() & lead(c, h, w).isNotNull(),
                      (inner + F.lit(0.5) * ends) / F.lit(float(period)))

    d = rolling(df, {"trend": trend}, back=h, fwd=h, keys=keys)
    d = whole_series(d, {"_r0": F.min(RN)}, keys).withColumn("phase", ((F.col(RN) - F.col("_r0")) % period).cast("int"))
    ph = d.groupBy(*keys, "phase").agg(F.avg(F.col(c) - F.col("trend")).alias("_pm"))
    ph = whole_series(ph, {"_pmm": F.avg("_pm")}, keys).select(*keys, "phase", (F.col("_pm") - F.col("_pmm")).alias("seasonal"))
    d = d.join(ph, [*keys, "phase"], "left")
    return d.withColumn("resid", F.col(c) - F.col("trend") - F.col("seasonal")).drop("_r0")
