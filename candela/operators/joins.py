"""Series joins (JON-1..10).

Joins are equi-joins on (symbol, bar_ts), bar_ts or the day and left to the planner (AQE picks
broadcast for sides under ``spark.sql.autoBroadcastJoinThreshold`` at runtime); none is forced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.functions.scalar import div, named
from candela.operators.features import ensure_indexed
from candela.operators.series import RN, running

def join_series(a: DataFrame, b: DataFrame, suffix: str = "_btc", on: Sequence[str] = ("bar_ts",),
                cols: Sequence[str] = ("open", "high", "low", "close", "volume")) -> DataFrame:
    """JON-1: left join of a second series on bar time; its columns get ``suffix``."""
    bs = b.select(*on, *[F.col(c).alias(f"{c}{suffix}") for c in cols])
    return a.join(bs, list(on), "left")


def price_ratio(df: DataFrame, a: str = "close", b: str = "close_btc", out: str = "ratio") -> DataFrame:
    """PRJ-12: close / close of the joined series."""
    return df.withColumn(out, div(F.col(a), F.col(b)))


def join_calendar(bars: DataFrame, calendar: DataFrame, ts: str = "bar_ts") -> DataFrame:
    """JON-2: ``calendar`` (one row per ``day``) left-joined to bars on the day, rows without a bar dropped
    (inner in effect). The planner broadcasts the calendar if it is small enough."""
    return bars.withColumn("_day", F.to_date(F.col(ts))).join(calendar.withColumnRenamed("day", "_day"), "_day").drop("_day")


def basket_join(a: DataFrame, b: DataFrame, cols: Sequence[str], suffixes: tuple[str, str] = ("_a", "_b")) -> DataFrame:
    """JON-4: left join of two assets on bar time with suffixes."""
    left = a.select("bar_ts", *[F.col(c).alias(f"{c}{suffixes[0]}") for c in cols])
    right = b.select("bar_ts", *[F.col(c).alias(f"{c}{suffixes[1]}") for c in cols])
    return left.join(right, "bar_ts", "left")


def compare_runs(r: DataFrame, e: DataFrame, keys: Sequence[str] = ("symbol", "bar_ts")) -> DataFrame:
    """JON-5: inner join of two strategy runs; cumulative products of each SR and of the market DR."""
    j = (r.select(*keys, F.col("SR").alias("SR_r"), F.col("DR").alias("DR_r"), F.col("signal").alias("signal_r"))
         .join(e.select(*keys, F.col("SR").alias("SR_e"), F.col("signal").alias("signal_e")), list(keys)))
    j = ensure_indexed(j.drop(RN) if RN in j.columns else j)
    return running(j, [("SR_r", "product", "CSR_r"), ("SR_e", "product", "CSR_e"), ("DR_r", "product", "CMR")])


def align_assets(df: DataFrame, symbols: Sequence[str], value: str = "close") -> DataFrame:
    """JON-6: one column per asset by bar time; bars where any asset is missing are dropped."""
    wide = df.filter(F.col("symbol").isin(list(symbols))).groupBy("bar_ts").pivot("symbol", list(symbols)).agg(F.first(value))
    there = F.lit(True)
    for s in symbols:
        there = there & named(s).isNotNull()
    return wide.filter(there)


def aligned_vectors(df: DataFrame, symbols: Sequence[str], value: str = "close", out: str = "c") -> DataFrame:
    """JON-6 as one array per bar time, in the order of ``symbols``; bars where any asset is missing are dropped."""
    names = F.array(*[F.lit(s) for s in symbols])
    rows = df.filter(F.col("symbol").isin(list(symbols)) & F.col(value).isNotNull()).groupBy("bar_ts").agg(
        F.map_from_entries(F.collect_list(F.struct("symbol", value))).alias("_m")).filter(F.size("_m") == len(symbols))
    return rows.select("bar_ts", F.transform(names, lambda s: F.element_at("_m", s)).alias(out))


FAN_BITS = 6  # a node of the search tree over positions has 2**6 children


def _price_tree(b: DataFrame, price: str, levels: int) -> list[DataFrame]:
    """Highest and lowest price of runs of bars: level k has one row per (symbol, node) with its up to 64 children
    in order, each a run of 64**k bars."""
    rows, tree = b.select("symbol", F.col(RN).alias("i"), F.col(price).alias("hi"), F.col(price).alias("lo")), []
    for _ in range(levels):
        nodes = rows.groupBy("symbol", F.shiftright("i", FAN_BITS).alias("node")).agg(
            F.sort_array(F.collect_list(F.struct("i", "hi", "lo"))).alias("kids"), F.max("hi").alias("hi"), F.min("lo").alias("lo"))
        tree.append(nodes.select(F.col("symbol").alias("_s"), F.col("node").alias("_node"), "kids"))
        rows = nodes.select("symbol", F.col("node").alias("i"), "hi", "lo")
    return tree


def _first_crossing(entries: DataFrame, b: DataFrame, price: str) -> DataFrame:
    """Add ``_found``: position of the first bar after ``entry_rn`` beyond a bound, NULL if none is.

    Climb: among the later siblings of the entry's bar, then of its run of 64 bars, then of 64**2, ... the first
    that holds a crossing; then descend to the bar. Every step is an equi-join on (symbol, node), two per level,
    so an entry meets O(64 log n) children however far its exit lies."""
    last = b.agg(F.max(RN)).first()[0] or 0
    levels = max(1, -(-int(last).bit_length() // FAN_BITS))
    tree = _price_tree(b, price, levels)

    def first(beyond):
        def hit(x):
            out = (x["hi"] > F.col("upper")) | (x["lo"] < F.col("lower"))
            return out if beyond is None else (x["i"] > beyond) & out
        return F.get(F.filter("kids", hit), 0)["i"]

    e = entries.withColumn("_found", F.lit(None).cast("long")).withColumn("_level", F.lit(None).cast("int"))
    keep = e.columns[:-2]
    for k in range(levels):
        own, up = F.shiftright("entry_rn", FAN_BITS * k), F.shiftright("entry_rn", FAN_BITS * (k + 1))
        j = e.join(tree[k], (F.col("symbol") == F.col("_s")) & (F.col("_node") == up), "left").withColumn("_new", first(own))
        e = j.select(*keep, F.coalesce("_found", "_new").alias("_found"),
                     F.coalesce("_level", F.when(F.col("_new").isNotNull(), F.lit(k))).alias("_level"))
    for k in range(levels - 1, 0, -1):
        here = F.coalesce(F.col("_level") == k, F.lit(False))
        # entries that are done meet their own run, so that no key gathers them
        node = F.when(here, F.col("_found")).otherwise(F.shiftright("entry_rn", FAN_BITS * k))
        j = e.join(tree[k - 1], (F.col("symbol") == F.col("_s")) & (F.col("_node") == node), "left")
        e = j.select(*keep, F.when(here, first(None)).otherwise(F.col("_found")).alias("_found"),
                     F.when(here, F.lit(k - 1)).otherwise(F.col("_level")).alias("_level"))
    return e.drop("_level")


def _open_bracket(entries: DataFrame, b: DataFrame, price: str, ids: list[str]) -> DataFrame:
    e = _first_crossing(entries.select(*ids).distinct(), b, price)
    e = e.join(b.groupBy("symbol").agg(F.max(RN).alias("_last")), "symbol").withColumn("_exit", F.coalesce("_found", "_last"))
    at = b.select(F.col("symbol").alias("_s"), F.col(RN).alias("_r"), F.col(price).alias("exit_price"))
    j = e.join(at, (F.col("symbol") == F.col("_s")) & (F.col("_exit") == F.col("_r")))
    return j.select(*ids, (F.col("_exit") - F.col("entry_rn")).alias("bars_held"), "exit_price")


def bracket_exit(entries: DataFrame, bars: DataFrame, timeout: int | None = None, price: str = "close") -> DataFrame:
    """JON-10: for each entry (symbol, entry_ts, upper, lower): the first bar after the bar at ``entry_ts``
    (within ``timeout`` bars) whose price is strictly above ``upper`` or strictly below ``lower``; otherwise
    the last bar of the time-out window (or of the series). Returns the *bar* price at exit (Q16) and
    the bars held; ``entry_rn`` is the entry's position among ``bars``
    (entries may also give it instead of ``entry_ts``; positions of another frame are not positions here). A NULL bound is
    never crossed; equal entries come out once. With a time-out the range join is bounded by it: entries expand to offsets
    0..timeout and meet bars by an equi-join on (symbol, rn). Without one, the exit is searched in a tree of runs of bars
    with their highest and lowest price (``_first_crossing``)."""
    b = ensure_indexed(bars)
    by_time = "entry_ts" in entries.columns
    if by_time:
        entries = entries.join(b.select("symbol", F.col("bar_ts").alias("entry_ts"), F.col(RN).alias("entry_rn")), ["symbol", "entry_ts"])
    ids = ["symbol", *["entry_ts"] * by_time, "entry_rn", "upper", "lower"]
    if timeout is None:
        return _open_bracket(entries, b, price, ids)
    b = b.select(F.col("symbol").alias("_s"), F.col(RN).alias("_r"), F.col(price).alias("_px"))
    e = entries.withColumn("_off", F.explode(F.sequence(F.lit(0), F.lit(int(timeout)))))
    j = e.join(b, (F.col("symbol") == F.col("_s")) & (F.col("_r") == F.col("entry_rn") + F.col("_off"))).drop("_s")
    hit = (F.col("_off") > 0) & ((F.col("_px") > F.col("upper")) | (F.col("_px") < F.col("lower")))
    agg = j.groupBy(*ids).agg(
        F.min(F.when(hit, F.col("_off"))).alias("_first_hit"), F.min_by("_px", F.when(hit, F.col("_off"))).alias("_hit_px"),
        F.max("_off").alias("_last"), F.max_by("_px", "_off").alias("_last_px"))
    return agg.select(*ids, F.coalesce("_first_hit", "_last").alias("bars_held"),
                      F.when(F.col("_first_hit").isNotNull(), F.col("_hit_px")).otherwise(F.col("_last_px")).alias("exit_price"))


def join_external_series(bars: DataFrame, daily: DataFrame, value: str = "close", ext: str = "trend") -> DataFrame:
    """JON-9: an external daily series (``daily``: symbol, day, ext) joined to bars on the day, both
    normalised by their maximum per symbol (aggregate + join, no whole-symbol window)."""
    j = bars.withColumn("day", F.to_date("bar_ts")).join(daily, ["symbol", "day"]).drop("day")
    mx = j.groupBy("symbol").agg(F.max(value).alias("_mv"), F.max(ext).alias("_me"))
    return (j.join(mx, "symbol").withColumn(f"{value}_norm", div(F.col(value), F.col("_mv")))
            .withColumn(f"{ext}_norm", div(F.col(ext), F.col("_me"))).drop("_mv", "_me"))
