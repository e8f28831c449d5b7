"""Calendar utilities, resampling, validation and top-k (TS-1..4, V-1, TOP-1..3, SRT-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.functions.scalar import lag, lead
from candela.operators.features import ensure_indexed, rolling
from candela.operators.series import RN, index_series, running


def missing_dates(bars: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """TS-1: calendar days between a symbol's first bar and its last bar (last excluded) that have no
    bar. The day range is generated per gap between consecutive bars (next bar via a one-row halo),
    so no symbol-wide array is built."""
    d = rolling(ensure_indexed(bars), {"_next": lambda w: lead("bar_ts", 1, w)}, back=0, fwd=1)
    d = d.filter(F.col("_next").isNotNull())
    gap = F.sequence(F.date_add(F.to_date("bar_ts"), 1), F.date_sub(F.to_date("_next"), 1))
    d = d.filter(F.datediff(F.to_date("_next"), F.to_date("bar_ts")) > 1)
    return d.select(*keys, F.explode(gap).alias("missing_date"))


def business_month_start(c: str = "bar_ts"):
    """First weekday (Mon-Fri) of the month of ``c``."""
    m0 = F.trunc(F.col(c), "month")
    wd = F.weekday(m0)  # 0 = Monday
    return F.when(wd == 5, F.date_add(m0, 2)).when(wd == 6, F.date_add(m0, 1)).otherwise(m0)


def month_bins_first(df: DataFrame, value: str, keys: Sequence[str] = ("symbol",), ts: str = "bar_ts") -> DataFrame:
    """TS-2: bins that start on each business-month start (a date before its month's first weekday
    belongs to the previous bin); value = first observation in the bin."""
    bms_this = business_month_start(ts)
    prev_month = F.add_months(F.trunc(F.col(ts), "month"), -1)
    pm0 = prev_month
    pwd = F.weekday(pm0)
    bms_prev = F.when(pwd == 5, F.date_add(pm0, 2)).when(pwd == 6, F.date_add(pm0, 1)).otherwise(pm0)
    b = F.when(F.to_date(ts) < bms_this, bms_prev).otherwise(bms_this)
    return (df.filter(F.col(value).isNotNull()).groupBy(*keys, b.alias("month_start"))
            .agg(F.min_by(F.col(value), F.col(ts)).alias(value)))


def upsample_interpolate(df: DataFrame, value: str, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """TS-3: daily rows between consecutive observations with linear interpolation (pandas
    ``resample('D')`` + ``interpolate()``). Each observation emits the days up to the next one."""
    d = rolling(ensure_indexed(df, keys), {"_nt": lambda w: lead("bar_ts", 1, w), "_nv": lambda w: lead(value, 1, w)},
                back=0, fwd=1, keys=keys)
    d0 = F.to_date("bar_ts")
    span = F.datediff(F.to_date("_nt"), d0)
    days = F.when(F.col("_nt").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), span - 1))
    e = d.select(*keys, "bar_ts", value, "_nt", "_nv", span.alias("_span"), F.explode(days).alias("_k"))
    v = F.when(F.col("_k") == 0, F.col(value)).otherwise(
        F.col(value) + (F.col("_nv") - F.col(value)) * F.col("_k") / F.col("_span"))
    return e.select(*keys, F.date_add(d0, F.col("_k").cast("int")).alias("day"), v.alias(value))


def shift_monthly(monthly: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("symbol",), order: str = "month_start") -> DataFrame:
    """TS-4: a monthly feature shifted one period forward (first month NULL)."""
    m = index_series(monthly.withColumn("_ts", F.col(order).cast("timestamp")), keys, "_ts")
    m = rolling(m, {f"{c}_prev": (lambda c: lambda w: lag(c, 1, w))(c) for c in cols}, back=1, keys=keys)
    return m.drop("_ts", RN, "_blk")


def validate_bars(bars: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """V-1: per symbol: bars, duplicate keys, high/low inconsistent with open/close, non-positive prices."""
    dup = bars.groupBy(*keys, "bar_ts").agg(F.count(F.lit(1)).alias("_c")).groupBy(*keys).agg(
        F.sum(F.col("_c") - 1).alias("duplicate_keys"))
    chk = bars.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_bars"),
        F.sum(((F.col("low") > F.least("open", "close")) | (F.col("high") < F.greatest("open", "close"))).cast("long"))
        .alias("bad_range"),
        F.sum((F.least("open", "high", "low", "close") <= 0).cast("long")).alias("non_positive"))
    return chk.join(dup, list(keys), "left")


def running_best(results: DataFrame, objective: str, trial: str = "param_id", keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """TOP-1: trials that improve the best objective seen so far (in trial order); lower is better."""
    r = index_series(results.withColumn("_ts", F.timestamp_seconds(F.col(trial).cast("long"))), keys, "_ts")
    r = running(r, [(objective, "min", "_best")], keys)
    r = rolling(r, {"_prev_best": lambda w: lag("_best", 1, w)}, back=1, keys=keys)
    return r.filter(F.col("_prev_best").isNull() | (F.col(objective) < F.col("_prev_best"))).drop("_ts", "_best", "_prev_best", RN, "_blk")


def top_k(df: DataFrame, k: int, order_col: str, keys: Sequence[str] = ("symbol",), descending: bool = True,
          tie: str | None = None) -> DataFrame:
    """TOP-1/2/3: the ``k`` best rows per key (row_number filter; planned as a per-task group limit
    before the exchange, so each task keeps at most k rows per key)."""
    o = F.col(order_col).desc() if descending else F.col(order_col).asc()
    w = Window.partitionBy(*keys).orderBy(o, *([F.col(tie)] if tie else []))
    return df.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)


def trend_changes(bars: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Change-point table for TOP-2: per month, the slope of ln(close) on the day number and its change
    from the previous month."""
    m = bars.groupBy(*keys, F.trunc("bar_ts", "month").alias("month_start")).agg(
        F.regr_slope(F.ln("close"), F.datediff(F.to_date("bar_ts"), F.lit("1970-01-01")).cast("double")).alias("slope"))
    m = shift_monthly(m.filter(F.col("slope").isNotNull()), ["slope"], keys)
    return m.withColumn("delta", F.col("slope") - F.col("slope_prev")).filter(F.col("delta").isNotNull())


def sort_bars(bars: DataFrame) -> DataFrame:
    """SRT-1: output order by symbol and time (windows carry their own order, so only outputs sort)."""
    return bars.orderBy("symbol", "bar_ts")


def ar_order_scores(pacf: DataFrame, acf0: DataFrame) -> DataFrame:
    """TOP-3 score table: Yule-Walker AR(p) innovation variance sigma2_p = var * prod(1 - pacf_k^2)
    and AIC/BIC for every order p (``pacf``: symbol, lag, pacf; ``acf0``: symbol, n, var)."""
    p = index_series(pacf.withColumn("_ts", F.timestamp_seconds(F.col("lag").cast("long"))), ["symbol"], "_ts")
    p = running(p, [(F.ln(F.lit(1.0) - F.col("pacf") * F.col("pacf")), "sum", "_lsum")], ["symbol"])
    p = p.join(acf0, "symbol")
    ln_s2 = F.ln(F.col("var")) + F.col("_lsum")
    return p.select("symbol", F.col("lag").alias("p"),
                    (F.col("n") * ln_s2 + 2 * (F.col("lag") + 1)).alias("aic"),
                    (F.col("n") * ln_s2 + (F.col("lag") + 1) * F.ln(F.col("n").cast("double"))).alias("bic"))

