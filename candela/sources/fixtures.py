"""Canonical inputs built from the driver's test tables (see FIXTURES.md part B).

These only reshape rows into the bar schema; every analytic step runs in the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.sources.bars import ticks_to_bars


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> hourly bars: symbol = event_type, price = volume = value, ticks ordered by ts."""
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), "ts", F.col("value").alias("price"), F.col("value").alias("volume"))
    return ticks_to_bars(ev, "hour")


def bars_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem join part -> daily bars: symbol = brand, price = extendedprice / quantity,
    volume = quantity; ticks of a day ordered by (orderkey, price)."""
    return _brand_bars(spark, sf_dir, "day", ["l_orderkey", "price"])


def bars_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``bars_daily`` by week, ticks ordered by (day, orderkey, price): also at small scales most weeks have a bar of
    every brand."""
    return _brand_bars(spark, sf_dir, "week", ["ts", "l_orderkey", "price"])


def _brand_bars(spark: SparkSession, sf_dir: str, period: str, order: list[str]) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_quantity", "l_extendedprice",
                                                 "l_shipdate")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    ticks = li.join(pt, li.l_partkey == pt.p_partkey).select(
        F.col("p_brand").alias("symbol"), F.col("l_shipdate").alias("ts"), "l_orderkey",
        F.try_divide("l_extendedprice", "l_quantity").alias("price"), F.col("l_quantity").alias("volume"))
    return ticks_to_bars(ticks, period, order=order)


# DuckDB forms of the same fixtures, used as CTEs by the oracle SQL.
BARS_HOURLY_SQL = """
bars AS (
  SELECT event_type AS symbol, date_trunc('hour', ts) AS bar_ts,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close, CAST(sum(value) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2)"""

BARS_DAILY_SQL = """
ticks AS (
  SELECT p_brand AS symbol, l_shipdate AS ts, l_orderkey,
         l_extendedprice / nullif(l_quantity, 0) AS price, l_quantity AS volume
  FROM lineitem JOIN part ON l_partkey = p_partkey),
bars AS (
  SELECT symbol, date_trunc('day', ts) AS bar_ts,
         first(price ORDER BY l_orderkey, price) AS open, max(price) AS high, min(price) AS low,
         first(price ORDER BY l_orderkey DESC, price DESC) AS close, CAST(sum(volume) AS DOUBLE) AS volume
  FROM ticks GROUP BY 1, 2)"""


BARS_WEEKLY_SQL = BARS_DAILY_SQL.replace("date_trunc('day', ts)", "date_trunc('week', ts)").replace(
    "ORDER BY l_orderkey, price", "ORDER BY ts, l_orderkey, price").replace("ORDER BY l_orderkey DESC", "ORDER BY ts DESC, l_orderkey DESC")
