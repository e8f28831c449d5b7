"""Registered queries for §2.2 (PRJ, FLT), §2.4 (WIN) and §2.5 (SCN)."""

from __future__ import annotations

from pyspark.sql import functions as F

from candela.operators import features as FE
from candela.operators import indicators as IN
from candela.plans import sqlparts as S
from candela.plans.catalog import DAILY, HOURLY, register, rounded
from candela.sources.fixtures import bars_daily, bars_hourly

W = "WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts)"
K = ["symbol", "bar_ts"]


def sel(cols, dbl=None, digits=6):
    dbl = set(dbl or [])
    return ", ".join(f"round({c}, {digits}) AS {c}" if c in dbl else c for c in cols)


def out(df, cols):
    return rounded(df.select(*cols))


# --- PRJ ----------------------------------------------------------------------------------------

@register("prj01_gross_return", HOURLY + f"\nSELECT symbol, bar_ts, round(close / nullif(lag(close) OVER w, 0), 6) AS DR FROM bars {W}")
def q_prj01(spark, sf):
    return out(FE.gross_return(bars_hourly(spark, sf)), K + ["DR"])


@register("prj02_pct_change", HOURLY + f"""
SELECT symbol, bar_ts, round(close / nullif(lag(close) OVER w, 0) - 1, 6) AS pct,
       round(lead(close) OVER w / nullif(close, 0) - 1, 6) AS fut_pct FROM bars {W}""")
def q_prj02(spark, sf):
    return out(FE.pct_change(bars_hourly(spark, sf), "close", "pct", "fut_pct"), K + ["pct", "fut_pct"])


@register("prj03_log_return", HOURLY + f"\nSELECT symbol, bar_ts, round(ln(close / nullif(lag(close) OVER w, 0)), 6) AS log_ret FROM bars {W}")
def q_prj03(spark, sf):
    return out(FE.log_return(bars_hourly(spark, sf)), K + ["log_ret"])


@register("prj04_diff0", HOURLY + f"\nSELECT symbol, bar_ts, round(coalesce(close - lag(close) OVER w, 0.0), 6) AS diff FROM bars {W}")
def q_prj04(spark, sf):
    return out(FE.diff0(bars_hourly(spark, sf)), K + ["diff"])


@register("prj05_lag_features", HOURLY + f"""
SELECT symbol, bar_ts, round(lag(close, 1) OVER w, 6) AS lag_1, round(lag(close, 2) OVER w, 6) AS lag_2,
       round(lag(close, 3) OVER w, 6) AS lag_3, CAST(len(list_filter([lag(close, 3) OVER w, lag(close, 2) OVER w,
       lag(close, 1) OVER w], lambda x: x IS NOT NULL)) AS INT) AS n_present FROM bars {W}""")
def q_prj05(spark, sf):
    d = FE.lag_features(bars_hourly(spark, sf), "close", 3, "lag", as_array="window")
    d = d.withColumn("n_present", F.size(F.filter("window", lambda x: x.isNotNull())))
    return out(d, K + ["lag_1", "lag_2", "lag_3", "n_present"])


_LAGGED = ", ".join(f"100.0 * (lag(close, {i}) OVER w / nullif(lag(close, {i + 1}) OVER w, 0) - 1) AS Lag{i}" for i in range(1, 6))


@register("prj06_lagged_return_frame", HOURLY + f""",
t AS (SELECT symbol, bar_ts, volume AS Volume, 100.0 * (close / nullif(lag(close) OVER w, 0) - 1) AS Today0, {_LAGGED}
      FROM bars {W}),
u AS (SELECT *, CASE WHEN abs(Today0) < 0.0001 THEN 0.0001 ELSE Today0 END AS Today FROM t
      WHERE Today0 IS NOT NULL AND Lag1 IS NOT NULL AND Lag2 IS NOT NULL AND Lag3 IS NOT NULL AND Lag4 IS NOT NULL
        AND Lag5 IS NOT NULL)
SELECT symbol, bar_ts, {sel(['Volume', 'Today', 'Lag1', 'Lag2', 'Lag3', 'Lag4', 'Lag5'], ['Volume', 'Today', 'Lag1', 'Lag2', 'Lag3', 'Lag4', 'Lag5'])},
       CAST(sign(Today) AS DOUBLE) AS Direction FROM u""")
def q_prj06(spark, sf):
    d = FE.lagged_return_frame(bars_hourly(spark, sf), 5)
    return out(d, K + ["Volume", "Today", "Lag1", "Lag2", "Lag3", "Lag4", "Lag5", "Direction"])


@register("prj07_next_bar_target", HOURLY + f""",
t AS (SELECT symbol, bar_ts, close / nullif(lag(close) OVER w, 0) AS DR FROM bars {W}),
u AS (SELECT symbol, bar_ts, DR, lead(DR) OVER w AS target FROM t {W})
SELECT symbol, bar_ts, round(DR, 6) AS DR, round(target, 6) AS target FROM u WHERE target IS NOT NULL""")
def q_prj07(spark, sf):
    d = FE.next_bar_target(FE.gross_return(bars_hourly(spark, sf)), "DR", "target")
    return out(d, K + ["DR", "target"])


@register("prj08_price_rise", HOURLY + f""",
t AS (SELECT symbol, bar_ts, close / nullif(lag(close) OVER w, 0) AS DR FROM bars {W})
SELECT symbol, bar_ts, CASE WHEN DR > 1 THEN 1 ELSE 0 END AS Price_Rise FROM t""")
def q_prj08(spark, sf):
    d = FE.gross_return(bars_hourly(spark, sf)).withColumn("Price_Rise", FE.price_rise("DR"))
    return out(d, K + ["Price_Rise"])


@register("prj09_encode_cyclical", DAILY + """,
c AS (SELECT DISTINCT bar_ts, CAST(CAST(bar_ts AS DATE) - DATE '1970-01-01' AS BIGINT) % 360 AS deg FROM bars)
SELECT bar_ts, deg, round(sin(2 * pi() * deg / 359.0), 6) AS deg_sin, round(cos(2 * pi() * deg / 359.0), 6) AS deg_cos FROM c""")
def q_prj09(spark, sf):
    cal = FE.calendar_days(bars_daily(spark, sf)).withColumn("bar_ts", F.col("day").cast("timestamp_ntz"))
    return out(FE.with_cyclical(cal, "deg", 359), ["bar_ts", "deg", "deg_sin", "deg_cos"])


@register("prj10_truncate", HOURLY + """
SELECT symbol, bar_ts, round(CASE WHEN (close - open) * 100.0 >= 0 THEN floor((close - open) * 100.0)
                                  ELSE ceil((close - open) * 100.0) END / 100.0, 6) AS body_trunc FROM bars""")
def q_prj10(spark, sf):
    from candela.functions.scalar import truncate
    d = bars_hourly(spark, sf).withColumn("body_trunc", truncate(F.col("close") - F.col("open"), 2))
    return out(d, K + ["body_trunc"])


_PIV = ["PP", "R1", "S1", "R2", "S2", "R3", "S3", "R4", "S4"]


@register("prj11_pivot_points", DAILY + f""",
p AS (SELECT symbol, bar_ts, high, low, (high + low + close) / 3 AS PP FROM bars),
q AS (SELECT symbol, bar_ts, PP, 2 * PP - low AS R1, 2 * PP - high AS S1, PP + high - low AS R2, PP - high + low AS S2,
             high + 2 * (PP - low) AS R3, low - 2 * (high - PP) AS S3, high + 3 * (PP - low) AS R4,
             low - 3 * (high - PP) AS S4 FROM p)
SELECT symbol, bar_ts, {sel(_PIV, _PIV)} FROM q""")
def q_prj11(spark, sf):
    return out(FE.with_pivots(bars_daily(spark, sf)), K + _PIV)


@register("prj13_weekday_dummies", DAILY + "\nSELECT symbol, bar_ts, " + ", ".join(
    f"CAST(isodow(bar_ts) - 1 = {i} AS INT) AS weekday_{i}" for i in range(1, 7)) + " FROM bars")
def q_prj13(spark, sf):
    return out(FE.weekday_dummies(bars_daily(spark, sf)), K + [f"weekday_{i}" for i in range(1, 7)])


@register("prj14_normalize_curve", HOURLY + f""",
t AS (SELECT *, first_value(close) OVER (PARTITION BY symbol ORDER BY bar_ts) AS f0, max(close) OVER (PARTITION BY symbol) AS mx,
             min(close) OVER (PARTITION BY symbol) AS mn FROM bars)
SELECT symbol, bar_ts, round(close / nullif(f0, 0), 6) AS close_rel_first, round(close / nullif(mx, 0), 6) AS close_rel_max,
       round((close - mn) / nullif(mx - mn, 0), 6) AS close_minmax FROM t""")
def q_prj14(spark, sf):
    return out(FE.normalize_curve(bars_hourly(spark, sf)), K + ["close_rel_first", "close_rel_max", "close_minmax"])


@register("prj15_nan_to_zero", HOURLY + f"\nSELECT symbol, bar_ts, round(coalesce(close / nullif(lag(close, 24) OVER w, 0) - 1, 0.0), 6) AS ret_24 FROM bars {W}")
def q_prj15(spark, sf):
    d = FE.rolling(bars_hourly(spark, sf), {"r": lambda w: F.try_divide(F.col("close"), F.lag("close", 24).over(w)) - 1}, back=24)
    return out(d.withColumn("ret_24", FE.nan_to_zero("r")), K + ["ret_24"])


@register("prj17_date_parts", DAILY + """
SELECT symbol, bar_ts, strftime(bar_ts, '%Y-%m') AS year_month, strftime(bar_ts, '%m') AS month_num,
       CAST(month(bar_ts) AS INT) AS month, CAST(isodow(bar_ts) - 1 AS INT) AS weekday FROM bars""")
def q_prj17(spark, sf):
    return out(FE.date_parts(bars_daily(spark, sf)), K + ["year_month", "month_num", "month", "weekday"])


@register("prj18_month_end", DAILY + """
SELECT DISTINCT symbol, CAST(date_trunc('month', bar_ts) AS DATE) AS month_start,
       last_day(CAST(date_trunc('month', bar_ts) AS DATE)) AS month_end FROM bars""")
def q_prj18(spark, sf):
    d = bars_daily(spark, sf).select("symbol", F.trunc("bar_ts", "month").alias("month_start")).distinct()
    return d.withColumn("month_end", FE.month_end("month_start"))


_DC = ["daily_change", "open_pct_of_mean", "high_pct_of_mean", "low_pct_of_mean", "close_pct_of_mean"]


@register("prj19_daily_change", DAILY + """,
t AS (SELECT *, avg(open) OVER (PARTITION BY symbol) AS mo, avg(high) OVER (PARTITION BY symbol) AS mh,
             avg(low) OVER (PARTITION BY symbol) AS ml, avg(close) OVER (PARTITION BY symbol) AS mc FROM bars)
SELECT symbol, bar_ts, round(close - open, 6) AS daily_change, round(100.0 * (open - mo) / mo, 6) AS open_pct_of_mean,
       round(100.0 * (high - mh) / mh, 6) AS high_pct_of_mean, round(100.0 * (low - ml) / ml, 6) AS low_pct_of_mean,
       round(100.0 * (close - mc) / mc, 6) AS close_pct_of_mean FROM t""")
def q_prj19(spark, sf):
    return out(FE.daily_change(bars_daily(spark, sf)), K + _DC)


# --- FLT ----------------------------------------------------------------------------------------

@register("flt01_drop_warmup", HOURLY + f""",
t AS (SELECT symbol, bar_ts, close / nullif({S.full_avg('close', 50)}, 0) AS MA FROM bars {W})
SELECT symbol, bar_ts, round(MA, 6) AS MA FROM t WHERE MA IS NOT NULL""")
def q_flt01(spark, sf):
    d = FE.rolling(bars_hourly(spark, sf), {"MA": FE.e_ratio_to("close", F.avg, "close", 50)}, back=49)
    return out(FE.drop_warmup(d, ["MA"]), K + ["MA"])


@register("flt02_positive_volume", HOURLY + "\nSELECT symbol, bar_ts, round(volume, 6) AS volume FROM bars WHERE volume > 0")
def q_flt02(spark, sf):
    return out(FE.positive_volume(bars_hourly(spark, sf)), K + ["volume"])


@register("flt03_trim_range", DAILY + """
SELECT symbol, bar_ts, round(close, 6) AS close FROM bars
WHERE bar_ts >= TIMESTAMP '1997-03-01 00:00:00' AND bar_ts <= TIMESTAMP '1998-06-30 00:00:00'""")
def q_flt03(spark, sf):
    return out(FE.trim_range(bars_daily(spark, sf), "1997-03-01", "1998-06-30"), K + ["close"])


@register("flt04_remove_weekends", DAILY + "\nSELECT symbol, bar_ts, round(close, 6) AS close FROM bars WHERE isodow(bar_ts) <= 5")
def q_flt04(spark, sf):
    return out(FE.remove_weekends(bars_daily(spark, sf)), K + ["close"])


@register("flt04_remove_weekends_compat", DAILY + "\nSELECT symbol, bar_ts, round(close, 6) AS close FROM bars WHERE isodow(bar_ts) <> 6")
def q_flt04c(spark, sf):
    return out(FE.remove_weekends(bars_daily(spark, sf), compat=True), K + ["close"])


@register("flt05_chrono_split", HOURLY + """,
t AS (SELECT symbol, bar_ts, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) - 1 AS p, count(*) OVER (PARTITION BY symbol) AS n FROM bars)
SELECT symbol, bar_ts, p < floor(n * 0.8) AS is_train, p >= n - floor(n * 0.3) AS is_test FROM t""")
def q_flt05(spark, sf):
    return out(FE.chrono_split(bars_hourly(spark, sf), 0.8, 0.3), K + ["is_train", "is_test"])


@register("flt06_date_split", DAILY + """
SELECT symbol, bar_ts, bar_ts < TIMESTAMP '2000-01-01' AND bar_ts >= TIMESTAMP '1998-01-01' AS is_train,
       bar_ts >= TIMESTAMP '2000-01-01' AS is_test FROM bars""")
def q_flt06(spark, sf):
    return out(FE.date_split(bars_daily(spark, sf), "2000-01-01", years=2), K + ["is_train", "is_test"])


# --- WIN ----------------------------------------------------------------------------------------

def _ratio(c, agg, src, n):
    return f"{c} / nullif({S.full_agg(agg, src, n)}, 0)"


_BASE = ["VOL", "HH", "LL", "DR", "MA", "MA2", "STD", "WR", "DMA", "MAR"]
_WR7 = (f"CASE WHEN {S.full_agg('max', 'high', 7)} IS NULL OR {S.full_agg('min', 'low', 7)} IS NULL THEN NULL "
        f"WHEN {S.full_agg('max', 'high', 7)} = {S.full_agg('min', 'low', 7)} THEN 0.0 "
        f"ELSE -100.0 * ({S.full_agg('max', 'high', 7)} - close) / ({S.full_agg('max', 'high', 7)} - {S.full_agg('min', 'low', 7)}) END")


@register("win01_09_base_features", HOURLY + f""",
t AS (SELECT symbol, bar_ts, {_ratio('volume', 'avg', 'volume', 30)} AS VOL, {_ratio('high', 'max', 'high', 50)} AS HH,
             {_ratio('low', 'min', 'low', 50)} AS LL, close / nullif(lag(close) OVER w, 0) AS DR,
             {_ratio('close', 'avg', 'close', 50)} AS MA, {_ratio('close', 'avg', 'close', 100)} AS MA2,
             {S.full_agg('stddev_samp', 'close', 7)} / nullif(close, 0) AS STD, {_WR7} AS WR FROM bars {W}),
u AS (SELECT *, MA / nullif(lag(MA) OVER w, 0) AS DMA, MA / nullif(MA2, 0) AS MAR FROM t {W})
SELECT symbol, bar_ts, {sel(_BASE, _BASE)} FROM u""")
def q_win_base(spark, sf):
    return out(FE.base_features(bars_hourly(spark, sf)), K + _BASE)


_SMA = ["SMA20", "SMA50", "SMA20_rel", "SMA_spread"]


@register("win05_sma_family", DAILY + f""",
t AS (SELECT symbol, bar_ts, close, {S.full_avg('close', 20)} AS SMA20, {S.full_avg('close', 50)} AS SMA50 FROM bars {W})
SELECT symbol, bar_ts, round(SMA20, 6) AS SMA20, round(SMA50, 6) AS SMA50, round(SMA20 / nullif(close, 0), 6) AS SMA20_rel,
       round(SMA20 - SMA50, 6) AS SMA_spread FROM t""")
def q_win05(spark, sf):
    return out(FE.sma_family(bars_daily(spark, sf), 20, 50), K + _SMA)


@register("win08_avg_return", DAILY + f""",
t AS (SELECT symbol, bar_ts, close / nullif(lag(close) OVER w, 0) AS DR FROM bars {W})
SELECT symbol, bar_ts, round({S.full_avg('DR', 20)}, 6) AS ADR FROM t {W}""")
def q_win08(spark, sf):
    return out(FE.avg_return(bars_daily(spark, sf), 20), K + ["ADR"])


@register("win10_roc", HOURLY + f"""
SELECT symbol, bar_ts, round(CASE WHEN lag(close, 10) OVER w IS NULL THEN NULL WHEN lag(close, 10) OVER w = 0 THEN 0.0
       ELSE 100.0 * (close / lag(close, 10) OVER w - 1) END, 6) AS ROC FROM bars {W}""")
def q_win10(spark, sf):
    return out(FE.roc(bars_hourly(spark, sf), 10), K + ["ROC"])


_FB_P = (14, 30, 50, 100, 200)


def _fb_sql():
    cols = ["close / nullif(lag(close) OVER w, 0) - 1 AS pct_1d"]
    names = ["pct_1d"]
    for n in _FB_P:
        wr = (f"CASE WHEN {S.full_agg('max', 'high', n)} IS NULL OR {S.full_agg('min', 'low', n)} IS NULL THEN NULL "
              f"WHEN {S.full_agg('max', 'high', n)} = {S.full_agg('min', 'low', n)} THEN 0.0 "
              f"ELSE -100.0 * ({S.full_agg('max', 'high', n)} - close) / ({S.full_agg('max', 'high', n)} - {S.full_agg('min', 'low', n)}) END")
        cols += [f"{S.full_avg('close', n)} / nullif(close, 0) AS ma{n}", f"{_ratio('volume', 'avg', 'volume', n)} AS vol{n}",
                 f"{_ratio('high', 'max', 'high', n)} AS hh{n}", f"{_ratio('low', 'min', 'low', n)} AS ll{n}",
                 f"{S.full_agg('stddev_samp', 'close', n)} / nullif(close, 0) AS std{n}", f"{wr} AS wr{n}"]
        names += [f"ma{n}", f"vol{n}", f"hh{n}", f"ll{n}", f"std{n}", f"wr{n}"]
    return cols, names


_FBC, _FBN = _fb_sql()


@register("win11_feature_bank", DAILY + f""",
t AS (SELECT symbol, bar_ts, {', '.join(_FBC)} FROM bars {W})
SELECT symbol, bar_ts, {sel(_FBN, _FBN)} FROM t""")
def q_win11(spark, sf):
    return out(FE.feature_bank(bars_daily(spark, sf), _FB_P), K + _FBN)


@register("win12_volume_change", DAILY + f""",
t AS (SELECT symbol, bar_ts, volume / nullif(lag(volume) OVER w, 0) - 1 AS vol_change FROM bars {W})
SELECT symbol, bar_ts, round(vol_change, 6) AS vol_change, round({S.full_avg('vol_change', 5)}, 6) AS vol_change_sma FROM t {W}""")
def q_win12(spark, sf):
    return out(FE.volume_change(bars_daily(spark, sf), 5), K + ["vol_change", "vol_change_sma"])


@register("win13_detrend", DAILY + f"\nSELECT symbol, bar_ts, round(close - {S.full_avg('close', 100)}, 6) AS detrended FROM bars {W}")
def q_win13(spark, sf):
    return out(FE.detrend(bars_daily(spark, sf), 100), K + ["detrended"])


_PC = ("CASE WHEN count(close) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) >= 5 "
       "THEN {agg}(close) OVER (w ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) END")


@register("win15_prior_channel", HOURLY + f"""
SELECT symbol, bar_ts, round({_PC.format(agg='max')}, 6) AS ch_high, round({_PC.format(agg='min')}, 6) AS ch_low,
       round({_PC.format(agg='avg')}, 6) AS ch_mean FROM bars {W}""")
def q_win15(spark, sf):
    return out(FE.prior_channel(bars_hourly(spark, sf), 5), K + ["ch_high", "ch_low", "ch_mean"])


@register("win18_bar_end", HOURLY + f"\nSELECT symbol, bar_ts, coalesce(lead(bar_ts) OVER w, bar_ts + INTERVAL 60 MINUTE) AS date_to FROM bars {W}")
def q_win18(spark, sf):
    return out(FE.bar_end(bars_hourly(spark, sf), 60), K + ["date_to"])


@register("win14_seasonal_decompose", DAILY + f""",
t AS (SELECT symbol, bar_ts, close, row_number() OVER w - 1 AS p,
             CASE WHEN lag(close, 15) OVER w IS NOT NULL AND lead(close, 15) OVER w IS NOT NULL THEN
               (sum(close) OVER (w ROWS BETWEEN 14 PRECEDING AND 14 FOLLOWING)
                + 0.5 * (lag(close, 15) OVER w + lead(close, 15) OVER w)) / 30.0 END AS trend FROM bars {W}),
ph AS (SELECT symbol, p % 30 AS phase, avg(close - trend) AS pm FROM t GROUP BY 1, 2),
ph2 AS (SELECT symbol, phase, pm - avg(pm) OVER (PARTITION BY symbol) AS seasonal FROM ph)
SELECT t.symbol, t.bar_ts, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal, round(close - trend - seasonal, 6) AS resid
FROM t JOIN ph2 ON ph2.symbol = t.symbol AND ph2.phase = t.p % 30""")
def q_win14(spark, sf):
    return out(FE.seasonal_decompose(bars_daily(spark, sf), 30), K + ["trend", "seasonal", "resid"])


# --- SCN ----------------------------------------------------------------------------------------

@register("scn01_cum_product", HOURLY + f""",
t AS (SELECT symbol, bar_ts, close / nullif(lag(close) OVER w, 0) AS DR FROM bars {W})
SELECT symbol, bar_ts, {S.sig_sql('product(DR) OVER (w ROWS UNBOUNDED PRECEDING)')} AS CMR FROM t {W}""")
def q_scn01(spark, sf):
    return out(IN.cum_product(FE.gross_return(bars_hourly(spark, sf)), "DR", "CMR"), K + ["CMR"])


@register("scn02_cum_sum", HOURLY + f""",
t AS (SELECT symbol, bar_ts, ln(close / nullif(lag(close) OVER w, 0)) AS lr FROM bars {W})
SELECT symbol, bar_ts, round(sum(lr) OVER (w ROWS UNBOUNDED PRECEDING), 6) AS cum_log_ret FROM t {W}""")
def q_scn02(spark, sf):
    return out(IN.cum_sum(FE.log_return(bars_hourly(spark, sf), out="lr"), "lr", "cum_log_ret"), K + ["cum_log_ret"])


@register("scn03_ffill", HOURLY + f""",
t AS (SELECT symbol, bar_ts, CASE WHEN hour(bar_ts) % 5 <> 0 THEN close END AS gappy FROM bars)
SELECT symbol, bar_ts, round(last_value(gappy IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING), 6) AS gappy FROM t {W}""")
def q_scn03(spark, sf):
    d = bars_hourly(spark, sf).withColumn("gappy", F.when(F.hour("bar_ts") % 5 != 0, F.col("close")))
    return out(IN.ffill(d, ["gappy"]), K + ["gappy"])


@register("scn04_grow", HOURLY + f""",
t AS (SELECT symbol, bar_ts, close / nullif(lag(close) OVER w, 0) - 1 AS r FROM bars {W})
SELECT symbol, bar_ts, {S.sig_sql('1000.0 * product(1 + r) OVER (w ROWS UNBOUNDED PRECEDING)')} AS account FROM t {W}""")
def q_scn04(spark, sf):
    d = FE.rolling(bars_hourly(spark, sf), {"r": lambda w: F.try_divide(F.col("close"), F.lag("close").over(w)) - 1}, back=1)
    return out(IN.grow(d, "r", 1000.0, "account"), K + ["account"])


def _pos(src="bars"):
    return f"b AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) - 1 AS pos FROM {src})"


@register("scn05_rsi", HOURLY + ",\n" + _pos() + "," + S.rsi_ctes("b", 14, "RSI", "r14")
          + "\nSELECT symbol, bar_ts, round(RSI, 6) AS RSI FROM r14")
def q_scn05(spark, sf):
    return out(IN.rsi(bars_hourly(spark, sf), 14), K + ["RSI"])


@register("scn06_atr", DAILY + ",\n" + _pos() + "," + S.atr_ctes("b", 14, "ATR", "a14")
          + "\nSELECT symbol, bar_ts, round(ATR, 6) AS ATR FROM a14")
def q_scn06(spark, sf):
    return out(IN.atr(bars_daily(spark, sf), 14), K + ["ATR"])


@register("scn07_adx", HOURLY + ",\n" + _pos() + "," + S.adx_ctes("b", 14, "ADX", "x14")
          + "\nSELECT symbol, bar_ts, round(ADX, 6) AS ADX FROM x14")
def q_scn07(spark, sf):
    return out(IN.adx(bars_hourly(spark, sf), 14), K + ["ADX"])


@register("scn08_ewma", HOURLY + f""",
t AS (SELECT symbol, bar_ts, row_number() OVER w - 1 AS pos, close / nullif(lag(close) OVER w, 0) - 1 AS r FROM bars {W}),
j AS (SELECT a.symbol, a.bar_ts, sum(pow(1 - 2 / 31.0, a.pos - b.pos) * b.r) AS num,
             sum(CASE WHEN b.r IS NOT NULL THEN pow(1 - 2 / 31.0, a.pos - b.pos) ELSE 0.0 END) AS den
      FROM t a JOIN t b ON a.symbol = b.symbol AND b.pos <= a.pos GROUP BY 1, 2)
SELECT symbol, bar_ts, round(num / nullif(den, 0), 6) AS ewma_r FROM j""")
def q_scn08(spark, sf):
    d = FE.rolling(bars_hourly(spark, sf), {"r": lambda w: F.try_divide(F.col("close"), F.lag("close").over(w)) - 1}, back=1)
    return out(IN.ewma(d, "r", 30, "ewma_r"), K + ["ewma_r"])
