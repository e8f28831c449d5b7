"""Registered queries for §2.1 (SRC), §2.10 (TS, V, TOP, SRT) and the remaining window/join items."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from candela.config import PRESETS
from candela.operators import features as FE
from candela.operators import joins as JN
from candela.operators import timeseries as TS
from candela.operators.series import RN
from candela.plans import sqlparts as S
from candela.plans.catalog import DAILY, HOURLY, register, rounded, rsql
from candela.plans.strategies import roc_backtest
from candela.session import ensure_checkpoint_dir
from candela.sources import bar_store as ST
from candela.sources import bars as SB
from candela.sources.fixtures import bars_daily, bars_hourly

W = "WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts)"
K = ["symbol", "bar_ts"]
BARS7 = ["symbol", "bar_ts", "open", "high", "low", "close", "volume"]
ROC = PRESETS["eth_usd_roc"]


def out(df, cols):
    return rounded(df.select(*cols))


def scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for files a query lands and reads back."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/landed/{name}-{uuid.uuid4().hex}"


_BARS_SQL = HOURLY + "\n" + rsql(BARS7, ["open", "high", "low", "close", "volume"], "bars")


# --- SRC ----------------------------------------------------------------------------------------

@register("src01_feed_a_records", _BARS_SQL)
def q_src01(spark, sf):
    """Bars landed as feed-A JSON documents (one document per symbol and day, epoch seconds,
    ``volumefrom``), read back with an explicit schema and normalised."""
    path = scratch(spark, "feed_a")
    b = bars_hourly(spark, sf)
    rec = F.struct(F.unix_seconds(F.col("bar_ts").cast("timestamp")).alias("time"), "open", "high", "low", "close",
                   F.col("volume").alias("volumefrom"), F.lit(0.0).alias("volumeto"))
    (b.groupBy("symbol", F.to_date("bar_ts").alias("day")).agg(F.collect_list(rec).alias("Data"))
     .write.partitionBy("symbol").json(path))
    bars = SB.read_feed_a(spark, path)
    return out(bars, BARS7)


@register("src02_feed_b_arrays", _BARS_SQL)
def q_src02(spark, sf):
    """Bars landed as feed-B documents (positional arrays of text), read back and coerced."""
    path = scratch(spark, "feed_b")
    b = bars_hourly(spark, sf)
    arr = F.array(*[c.cast("string") for c in (F.unix_seconds(F.col("bar_ts").cast("timestamp")), F.col("open"),
                                                F.col("high"), F.col("low"), F.col("close"), F.lit("0"),
                                                F.col("volume"), F.lit("1"))])
    (b.groupBy("symbol", F.to_date("bar_ts").alias("day")).agg(F.collect_list(arr).alias("rows"))
     .select("symbol", F.struct(F.col("rows").alias("PAIR")).alias("result")).write.partitionBy("symbol").json(path))
    bars = SB.read_feed_b(spark, path, "PAIR")
    return out(bars, BARS7)


_CSV_SQL = DAILY + "\nSELECT symbol AS ticker, bar_ts AS date, round(open, 6) AS open, round(low, 6) AS low, round(high, 6) AS high, round(close, 6) AS close FROM bars"


@register("src08_price_csv", _CSV_SQL)
def q_src08(spark, sf):
    """Daily bars landed as CSV text with a 6-line preamble and a 9-line footer, read back with
    chosen columns, names and date parsing."""
    path = scratch(spark, "csv")
    b = bars_daily(spark, sf)
    lines = b.select(F.concat_ws(",", "symbol", F.date_format("bar_ts", "yyyy-MM-dd"), F.lit("00:00"),
                                 *[F.col(c).cast("string") for c in ("open", "low", "high", "close")]).alias("value"))
    pre = spark.createDataFrame([(f"# preamble line {i}",) for i in range(6)] + [("ticker,date,time,open,low,high,close",)]
                                + [(f"footer {i},,,,,,",) for i in range(9)], "value string")
    lines.unionByName(pre).write.text(path)
    df = SB.read_price_csv(spark, path, ["ticker", "date", "time", "open", "low", "high", "close"], date_col="date")
    df = df.select("ticker", F.col("date").alias("date"), "open", "low", "high", "close")
    return rounded(df)


@register("src04_tail_bars", HOURLY + """,
t AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts DESC) AS r FROM bars)
SELECT symbol, bar_ts, round(close, 6) AS close FROM t WHERE r <= 100""")
def q_src04(spark, sf):
    return out(SB.tail_bars(bars_hourly(spark, sf), 100), K + ["close"])


@register("src05_check_min_rows", DAILY + "\nSELECT symbol, count(*) AS n_bars, count(*) > 1500 AS complete FROM bars GROUP BY symbol")
def q_src05(spark, sf):
    return SB.check_min_rows(bars_daily(spark, sf), 1500)


@register("src06_freshness", HOURLY + """
SELECT symbol, max(bar_ts) AS last_bar, CAST(max(bar_ts) AS DATE) = DATE '2024-01-30' AS fresh FROM bars GROUP BY symbol""")
def q_src06(spark, sf):
    return SB.freshness(bars_hourly(spark, sf), "2024-01-30")


@register("src07_bar_cache", HOURLY + "\n" + rsql(BARS7, ["open", "high", "low", "close", "volume"], "bars")
          + " WHERE symbol IN ('click', 'view')")
def q_src07(spark, sf):
    """Bars cached as Parquet partitioned by symbol; reload prunes to two symbols."""
    path = scratch(spark, "cache")
    SB.save_bars(bars_hourly(spark, sf), path)
    return out(SB.load_bars(spark, path, ["click", "view"]), BARS7)


@register("src07_amended_bars", HOURLY + """,
c AS (SELECT *, symbol = 'click' AND CAST(bar_ts AS DATE) = DATE '2024-01-10' AS first,
             symbol IN ('click', 'view') AND CAST(bar_ts AS DATE) IN (DATE '2024-01-10', DATE '2024-01-20') AS second FROM bars),
n AS (SELECT symbol, bar_ts, open, CASE WHEN first THEN high * 1.1 ELSE high END AS high, low, CASE WHEN first THEN close * 1.1 ELSE close END AS close,
             CASE WHEN second THEN volume + 1 ELSE volume END AS volume FROM c WHERE NOT (second AND hour(bar_ts) = 5)
      UNION ALL SELECT 'new', TIMESTAMP '2024-01-10 00:00:00', 1.0, 3.0, 0.5, 2.0, 10.0)
""" + rsql(BARS7, ["open", "high", "low", "close", "volume"], "n"))
def q_src07_amended(spark, sf):
    """SRC-7 after two amendments: a corrected day, then added, removed and corrected bars on top of it."""
    path = scratch(spark, "store")
    bars = bars_hourly(spark, sf)
    ST.create(bars, path, "day")
    day = F.to_date("bar_ts")
    ST.amend(bars.filter((F.col("symbol") == "click") & (day == F.lit("2024-01-10").cast("date"))).withColumns({"high": F.col("high") * 1.1, "close": F.col("close") * 1.1}), path, "day")
    again = ST.load(spark, path).filter(F.col("symbol").isin("click", "view") & day.isin(F.lit("2024-01-10").cast("date"), F.lit("2024-01-20").cast("date")))
    again = again.withColumns({"volume": F.col("volume") + 1, "close": F.when(F.hour("bar_ts") != 5, F.col("close"))})
    new = spark.range(1).select(F.lit("new").alias("symbol"), F.lit("2024-01-10").cast("timestamp_ntz").alias("bar_ts"),
                                *[F.lit(v).alias(c) for c, v in (("open", 1.0), ("high", 3.0), ("low", 0.5), ("close", 2.0), ("volume", 10.0))])
    ST.amend(again.unionByName(new), path, "day")
    return out(ST.load(spark, path), BARS7)


def _src09_sql() -> str:
    from candela.plans.q_analytics import _TR, TRADES_SQL
    return (HOURLY + "," + S.roc_signal_ctes("bars", ROC) + "," + S.pnl_ctes("td", ROC) + TRADES_SQL + "\n"
            + rsql(_TR, ["open", "close", "high", "low", "mr", "sr", "CMR", "CSR"], "trades"))


@register("src09_write_results", _src09_sql())
def q_src09(spark, sf):
    """Result tables (P&L, trades) written as Parquet and read back."""
    from candela.operators.aggregates import gen_trades
    path = scratch(spark, "results")
    pnl = roc_backtest(bars_hourly(spark, sf), ROC)
    SB.write_results({"pnl": pnl.drop(RN, "_blk"), "trades": gen_trades(pnl)}, path)
    return rounded(spark.read.parquet(f"{path}/trades"))


# --- TS / V / TOP / SRT ---------------------------------------------------------------------------

@register("ts01_missing_dates", DAILY + f""",
t AS (SELECT symbol, CAST(bar_ts AS DATE) AS d, CAST(lead(bar_ts) OVER w AS DATE) AS nd FROM bars {W})
SELECT symbol, CAST(unnest(generate_series(d + 1, nd - 1, INTERVAL 1 DAY)) AS DATE) AS missing_date FROM t
WHERE nd IS NOT NULL AND nd - d > 1""")
def q_ts01(spark, sf):
    return TS.missing_dates(bars_daily(spark, sf))


_BMS = """CASE WHEN isodow(date_trunc('month', {x})) = 6 THEN CAST(date_trunc('month', {x}) AS DATE) + 2
               WHEN isodow(date_trunc('month', {x})) = 7 THEN CAST(date_trunc('month', {x}) AS DATE) + 1
               ELSE CAST(date_trunc('month', {x}) AS DATE) END"""


@register("ts02_month_bins_first", DAILY + f""",
t AS (SELECT symbol, bar_ts, close, CASE WHEN CAST(bar_ts AS DATE) < {_BMS.format(x='bar_ts')}
                                         THEN {_BMS.format(x="(bar_ts - INTERVAL 1 MONTH)")}
                                         ELSE {_BMS.format(x='bar_ts')} END AS month_start FROM bars)
SELECT symbol, month_start, round(arg_min(close, bar_ts), 6) AS close FROM t GROUP BY 1, 2""")
def q_ts02(spark, sf):
    return rounded(TS.month_bins_first(bars_daily(spark, sf), "close"))


@register("ts03_upsample_interpolate", DAILY + f""",
t AS (SELECT symbol, CAST(bar_ts AS DATE) AS d, close, CAST(lead(bar_ts) OVER w AS DATE) AS nd, lead(close) OVER w AS nc FROM bars {W}),
u AS (SELECT symbol, d, close, nd, nc, unnest(CASE WHEN nd IS NULL THEN [0] ELSE range(0, nd - d) END) AS k FROM t)
SELECT symbol, CAST(d + CAST(k AS INT) AS DATE) AS day, round(CASE WHEN k = 0 THEN close ELSE close + (nc - close) * k / (nd - d) END, 6) AS close
FROM u""")
def q_ts03(spark, sf):
    return rounded(TS.upsample_interpolate(bars_daily(spark, sf), "close"))


@register("ts04_shift_monthly", DAILY + """,
m AS (SELECT symbol, CAST(date_trunc('month', bar_ts) AS DATE) AS month_start, avg(close) AS avg_close FROM bars GROUP BY 1, 2)
SELECT symbol, month_start, round(avg_close, 6) AS avg_close,
       round(lag(avg_close) OVER (PARTITION BY symbol ORDER BY month_start), 6) AS avg_close_prev FROM m""")
def q_ts04(spark, sf):
    m = bars_daily(spark, sf).groupBy("symbol", F.trunc("bar_ts", "month").alias("month_start")).agg(F.avg("close").alias("avg_close"))
    return rounded(TS.shift_monthly(m, ["avg_close"]))


@register("v01_validate_bars", HOURLY + """,
d AS (SELECT symbol, sum(c - 1) AS duplicate_keys FROM (SELECT symbol, bar_ts, count(*) AS c FROM bars GROUP BY 1, 2) GROUP BY 1)
SELECT symbol, count(*) AS n_bars,
       CAST(sum(CASE WHEN low > least(open, close) OR high < greatest(open, close) THEN 1 ELSE 0 END) AS BIGINT) AS bad_range,
       CAST(sum(CASE WHEN least(open, high, low, close) <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS non_positive,
       CAST(max(d.duplicate_keys) AS BIGINT) AS duplicate_keys
FROM bars JOIN d USING (symbol) GROUP BY symbol""")
def q_v01(spark, sf):
    return TS.validate_bars(bars_hourly(spark, sf))


@register("top02_trend_changes", DAILY + """,
m AS (SELECT symbol, CAST(date_trunc('month', bar_ts) AS DATE) AS month_start,
             regr_slope(ln(close), CAST(CAST(bar_ts AS DATE) - DATE '1970-01-01' AS DOUBLE)) AS slope FROM bars GROUP BY 1, 2),
n AS (SELECT *, slope - lag(slope) OVER (PARTITION BY symbol ORDER BY month_start) AS delta FROM m WHERE slope IS NOT NULL AND NOT isnan(slope)),
r AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY round(abs(delta), 6) DESC, month_start) AS rank FROM n WHERE delta IS NOT NULL)
SELECT symbol, month_start, round(slope, 6) AS slope, round(delta, 6) AS delta, rank FROM r WHERE rank <= 10""")
def q_top02(spark, sf):
    from candela.functions.scalar import half_up
    t = TS.trend_changes(bars_daily(spark, sf)).withColumn("_abs", half_up(F.abs("delta"), 6))
    t = TS.top_k(t, 10, "_abs", tie="month_start")
    return rounded(t.select("symbol", "month_start", "slope", "delta", "rank"))


def _top03_sql() -> str:
    from candela.plans.q_analytics import _pacf_ctes
    return _pacf_ctes() + """,
a0 AS (SELECT symbol, count(lr) AS n, var_pop(lr) AS var FROM t WHERE lr IS NOT NULL GROUP BY symbol),
cs AS (SELECT symbol, lag AS p, sum(ln(1.0 - pacf * pacf)) OVER (PARTITION BY symbol ORDER BY lag ROWS UNBOUNDED PRECEDING) AS lsum
       FROM pacf),
sc AS (SELECT cs.symbol, cs.p, n * (ln(var) + lsum) + 2 * (p + 1) AS aic, n * (ln(var) + lsum) + (p + 1) * ln(CAST(n AS DOUBLE)) AS bic
       FROM cs JOIN a0 USING (symbol)),
rk AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY aic, p) AS rank FROM sc)
SELECT symbol, p, round(aic, 6) AS aic, round(bic, 6) AS bic, rank FROM rk WHERE rank <= 10"""


@register("top03_ar_order_scores", _top03_sql())
def q_top03(spark, sf):
    """TOP-3: AR orders 1..10 ranked by AIC, from the PACF of log returns."""
    from candela.operators.aggregates import acf, pacf
    lr = FE.log_return(bars_hourly(spark, sf), out="lr")
    a0 = lr.filter(F.col("lr").isNotNull()).groupBy("symbol").agg(F.count("lr").alias("n"), F.var_pop("lr").alias("var"))
    scores = TS.ar_order_scores(pacf(acf(lr, "lr", 10)), a0)
    return rounded(TS.top_k(scores, 10, "aic", descending=False, tie="p"))


@register("srt01_sort_bars", HOURLY + "\n" + rsql(BARS7, ["open", "high", "low", "close", "volume"], "bars") + " ORDER BY symbol, bar_ts")
def q_srt01(spark, sf):
    return out(TS.sort_bars(bars_hourly(spark, sf)), BARS7)


PNL_H = HOURLY + "," + S.roc_signal_ctes("bars", ROC) + "," + S.pnl_ctes("td", ROC)


@register("win19_trailing_return", PNL_H + """,
t AS (SELECT symbol, SR, row_number() OVER (PARTITION BY symbol ORDER BY pos DESC) AS r FROM pnl)
SELECT symbol, """ + S.sig_sql("coalesce(product(SR), 1.0)") + """ AS trailing_return FROM t WHERE r <= 300 GROUP BY symbol""")
def q_win19(spark, sf):
    pnl = roc_backtest(bars_hourly(spark, sf), ROC, keep_adx=False)
    tail = SB.tail_bars(pnl, 300)
    return rounded(tail.groupBy("symbol").agg(F.coalesce(F.product("SR"), F.lit(1.0)).alias("trailing_return")))


@register("jon09_external_series", DAILY + f""",
ext AS (SELECT symbol, date_trunc('week', bar_ts) AS bar_ts, avg(volume) AS trend FROM bars GROUP BY 1, 2),
t AS (SELECT symbol, CAST(bar_ts AS DATE) AS d, trend, CAST(lead(bar_ts) OVER w AS DATE) AS nd, lead(trend) OVER w AS nt FROM ext {W}),
u AS (SELECT symbol, d, trend, nd, nt, unnest(CASE WHEN nd IS NULL THEN [0] ELSE range(0, nd - d) END) AS k FROM t),
daily AS (SELECT symbol, CAST(d + CAST(k AS INT) AS DATE) AS day,
                 CASE WHEN k = 0 THEN trend ELSE trend + (nt - trend) * k / (nd - d) END AS trend FROM u),
j AS (SELECT b.symbol, b.bar_ts, b.close, daily.trend FROM bars b JOIN daily ON daily.symbol = b.symbol AND daily.day = CAST(b.bar_ts AS DATE))
SELECT symbol, bar_ts, round(close / max(close) OVER (PARTITION BY symbol), 6) AS close_norm,
       round(trend / max(trend) OVER (PARTITION BY symbol), 6) AS trend_norm FROM j""")
def q_jon09(spark, sf):
    bars = bars_daily(spark, sf)
    ext = bars.groupBy("symbol", F.date_trunc("week", "bar_ts").cast("timestamp_ntz").alias("bar_ts")).agg(F.avg("volume").alias("trend"))
    daily = TS.upsample_interpolate(ext, "trend")
    j = JN.join_external_series(bars, daily, "close", "trend")
    return out(j, K + ["close_norm", "trend_norm"])
