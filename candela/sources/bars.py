"""Bar sources and sinks (SRC-1..10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAR_COLS = ["symbol", "bar_ts", "open", "high", "low", "close", "volume"]

PERIOD_UNITS = {"week": "week", "day": "day", "hour": "hour", "minute": "minute"}


def ticks_to_bars(ticks: DataFrame, period: str = "hour", symbol: str = "symbol", ts: str = "ts",
                  price: str = "price", volume: str = "volume", order: list[str] | None = None) -> DataFrame:
    """SRC-10: OHLCV bars per symbol and period.

    One hash aggregate: partial aggregation runs before the exchange, so a hot symbol costs one
    partial row per map task and bar. ``order`` breaks ties of ``ts`` for open/close (default ``ts``).
    """
    unit = PERIOD_UNITS[period]
    ticks = ticks.filter(F.col(price).isNotNull() & F.col(ts).isNotNull())  # a tick without a price makes no bar
    bar_ts = F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz")
    key = F.struct(*[F.col(c) for c in (order or [ts])])
    return (ticks.groupBy(F.col(symbol).alias("symbol"), bar_ts.alias("bar_ts"))
            .agg(F.min_by(F.col(price), key).alias("open"), F.max(price).alias("high"),
                 F.min(price).alias("low"), F.max_by(F.col(price), key).alias("close"),
                 F.sum(volume).cast("double").alias("volume")))


# --- raw feeds ---------------------------------------------------------------------------------

# Feed A: JSON object with a list of records; ``volumefrom`` is the traded volume.
FEED_A_SCHEMA = T.StructType([
    T.StructField("Data", T.ArrayType(T.StructType([
        T.StructField("time", T.LongType()), T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()), T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()), T.StructField("volumefrom", T.DoubleType()),
        T.StructField("volumeto", T.DoubleType())]))),
])

# Feed B: JSON object ``result`` -> pair -> positional arrays; values may arrive as text.
FEED_B_FIELDS = ["time", "open", "high", "low", "close", "vwap", "volume", "count"]


def epoch_to_bar_ts(col: str = "time"):
    """SRC-3: epoch seconds to a naive UTC timestamp."""
    return F.timestamp_seconds(F.col(col).cast("long")).cast("timestamp_ntz")


def _symbol(symbol: str | None, symbol_col: str | None):
    return F.col(symbol_col) if symbol_col else F.lit(symbol)


def bars_from_records(raw: DataFrame, symbol: str | None = None, symbol_col: str | None = None) -> DataFrame:
    """SRC-1: feed A records -> bars (``volumefrom`` renamed to ``volume``; other fields dropped).
    The symbol is a literal or a column of the landed documents."""
    rec = raw.select(_symbol(symbol, symbol_col).alias("symbol"), F.explode("Data").alias("r")).select("symbol", "r.*")
    return rec.select("symbol", epoch_to_bar_ts("time").alias("bar_ts"),
                      "open", "high", "low", "close", F.col("volumefrom").alias("volume"))


def bars_from_arrays(raw: DataFrame, pair: str, symbol: str | None = None, symbol_col: str | None = None) -> DataFrame:
    """SRC-2: feed B positional arrays -> bars; vwap and count dropped, text coerced to numbers."""
    arr = raw.select(_symbol(symbol, symbol_col).alias("symbol"), F.explode(F.col(f"result.`{pair}`")).alias("a"))
    num = {name: F.expr(f"try_cast(element_at(a, {i + 1}) AS DOUBLE)") for i, name in enumerate(FEED_B_FIELDS)}
    return arr.select("symbol",
                      F.timestamp_seconds(num["time"].cast("long")).cast("timestamp_ntz").alias("bar_ts"),
                      num["open"].alias("open"), num["high"].alias("high"), num["low"].alias("low"),
                      num["close"].alias("close"), num["volume"].alias("volume"))


def read_feed_a(spark: SparkSession, path: str, symbol: str | None = None, multiline: bool = False) -> DataFrame:
    """Feed A files: one JSON document per line (or one per file with ``multiline``); a ``symbol``
    partition column of the landed folder is used when no literal symbol is given."""
    raw = spark.read.schema(T.StructType(FEED_A_SCHEMA.fields + [T.StructField("symbol", T.StringType())])) \
        .option("multiLine", str(multiline).lower()).json(path)
    return bars_from_records(raw, symbol, None if symbol else "symbol")


def read_feed_b(spark: SparkSession, path: str, pair: str, symbol: str | None = None, multiline: bool = False) -> DataFrame:
    schema = T.StructType([T.StructField("result", T.StructType([
        T.StructField(pair, T.ArrayType(T.ArrayType(T.StringType())))])), T.StructField("symbol", T.StringType())])
    raw = spark.read.schema(schema).option("multiLine", str(multiline).lower()).json(path)
    return bars_from_arrays(raw, pair, symbol, None if symbol else "symbol")


def read_price_csv(spark: SparkSession, path: str, columns: list[str], names: list[str] | None = None,
                   date_col: str = "date", date_format: str = "yyyy-MM-dd", symbol: str | None = None,
                   text_cols: tuple = ("ticker", "symbol", "time")) -> DataFrame:
    """SRC-8: price CSV with preamble/footer lines. All fields are read as text; a row is kept only
    when its date parses and every numeric column casts, which removes header, preamble and footer
    lines without counting them. ``text_cols`` stay text and are not required."""
    raw = spark.read.option("header", "false").option("mode", "PERMISSIVE").csv(path)
    names = names or columns
    cols = raw.columns
    picked = [F.col(cols[i]) for i in range(len(columns))]
    out = raw.select(*[c.alias(n) for c, n in zip(picked, columns)])
    parsed = []
    for src, dst in zip(columns, names):
        if src == date_col:
            parsed.append(F.try_to_timestamp(F.trim(F.col(src)), F.lit(date_format)).cast("timestamp_ntz").alias(dst))
        elif src in text_cols:
            parsed.append(F.col(src).alias(dst))
        else:
            parsed.append(F.expr(f"try_cast(trim(`{src}`) AS DOUBLE)").alias(dst))
    res = out.select(*parsed)
    res = res.dropna(subset=[n for s, n in zip(columns, names) if s not in text_cols])
    if symbol is not None:
        res = res.withColumn("symbol", F.lit(symbol))
    return res


# --- guards and limits -------------------------------------------------------------------------

def tail_bars(bars: DataFrame, n: int, keys=("symbol",), order: str = "bar_ts") -> DataFrame:
    """SRC-4: last ``n`` bars per symbol. A top-n window filter (planned as WindowGroupLimit, so each
    task keeps at most n rows per symbol before the exchange)."""
    if n <= 0:
        return bars
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return bars.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def check_min_rows(bars: DataFrame, min_rows: int = 100, keys=("symbol",)) -> DataFrame:
    """SRC-5: symbols whose load is incomplete (no more than ``min_rows`` bars)."""
    return (bars.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_bars"))
            .withColumn("complete", F.col("n_bars") > F.lit(min_rows)))


def freshness(bars: DataFrame, as_of: str, keys=("symbol",), order: str = "bar_ts") -> DataFrame:
    """SRC-6: last bar per symbol and whether it falls on the ``as_of`` day."""
    day = F.to_date(F.lit(as_of))
    return (bars.groupBy(*keys).agg(F.max(order).alias("last_bar"))
            .withColumn("fresh", F.to_date("last_bar") == day))


def save_bars(bars: DataFrame, path: str) -> None:
    """SRC-7: cache of bars as Parquet partitioned by symbol (partition pruning on reload)."""
    bars.write.mode("overwrite").partitionBy("symbol").parquet(path)


def load_bars(spark: SparkSession, path: str, symbols: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if symbols:
        df = df.filter(F.col("symbol").isin(symbols))
    return df.select(*BAR_COLS)


def write_results(tables: dict[str, DataFrame], root: str, fmt: str = "parquet") -> None:
    """SRC-9: write result tables (stats, monthly stats, trades, P&L, features)."""
    for name, df in tables.items():
        w = df.write.mode("overwrite")
        if fmt == "csv":
            w.option("header", "true").csv(f"{root}/{name}")
        else:
            w.parquet(f"{root}/{name}")
