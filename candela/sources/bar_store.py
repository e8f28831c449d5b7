"""Bars that may be amended (SRC-7): a versioned store by (symbol, period).

Feeds correct their history. An amendment rewrites only the partitions that its bars fall into, as a new version beside the
old ones, and then publishes a manifest: the version that holds each partition. Readers resolve the newest manifest, or an
older one by number, and read just the folders it names, so they never see half an amendment and can go back. A
manifest is one file, renamed into place when its job commits: without it the data of a failed attempt is no part of any
version, and a retry writes over it.

Layout: ``<root>/data/version=V/symbol=S/period=P`` and ``<root>/manifest/version=V``. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.sources.bars import BAR_COLS

UNITS = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}
DATA = "bar_ts timestamp_ntz, open double, high double, low double, close double, volume double, symbol string, period string, version long"
MANIFEST = "symbol string, period string, rows long, held long, version long"


def _period(unit: str):
    return F.date_format("bar_ts", UNITS[unit])


def _write(rows: DataFrame, root: str, version: int) -> None:
    """Data of one version: a task per partition, so that each holds one file."""
    (rows.select(*BAR_COLS, "period").repartition("symbol", "period").sortWithinPartitions("symbol", "period", "bar_ts")
     .write.mode("overwrite").partitionBy("symbol", "period").parquet(f"{root}/data/version={version}"))


def _data(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(DATA).parquet(f"{root}/data")


def _publish(manifest: DataFrame, root: str, version: int) -> None:
    manifest.select("symbol", "period", "rows", "held").coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/version={version}")


def _counted(spark: SparkSession, root: str, version: int) -> DataFrame:
    rows = _data(spark, root).filter(F.col("version") == version)
    return rows.groupBy("symbol", "period").agg(F.count(F.lit(1)).alias("rows")).withColumn("held", F.lit(version).cast("long"))


def latest_version(spark: SparkSession, root: str) -> int:
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest").agg(F.max("version")).first()[0]


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """symbol, period, rows, held: the version whose folder holds the partition."""
    v = latest_version(spark, root) if version is None else version
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest").filter(F.col("version") == v).drop("version")


def create(bars: DataFrame, root: str, unit: str = "month") -> None:
    """Version 0 of a store. ``(symbol, bar_ts)`` must be unique."""
    spark = bars.sparkSession
    _write(bars.withColumn("period", _period(unit)), root, 0)
    _publish(_counted(spark, root, 0), root, 0)


def _resolved(spark: SparkSession, root: str, parts: DataFrame) -> DataFrame:
    """Rows of the partitions that ``parts`` (rows of a manifest) names. All join columns are folder names, so the join prunes
    the scan to those folders."""
    p = parts.select(F.col("symbol").alias("_s"), F.col("period").alias("_p"), F.col("held").alias("_v"))
    d = _data(spark, root)
    return d.join(p, (F.col("version") == F.col("_v")) & F.col("symbol").eqNullSafe(F.col("_s")) & F.col("period").eqNullSafe(F.col("_p")), "left_semi")


def amend(changes: DataFrame, root: str, unit: str = "month") -> int:
    """Upsert ``changes`` by (symbol, bar_ts); a change whose ``close`` is NULL removes its bar. Returns the new version. Only
    the changes' partitions are read and written; of changes to one bar the one that comes last in (open, high, low, close,
    volume) wins."""
    spark = changes.sparkSession
    old = latest_version(spark, root)
    new = old + 1
    rows = changes.select(*BAR_COLS).withColumn("period", _period(unit))
    touched = rows.select("symbol", "period").distinct()
    now = manifest(spark, root, old)
    same = now["symbol"].eqNullSafe(touched["symbol"]) & now["period"].eqNullSafe(touched["period"])
    before = _resolved(spark, root, now.join(touched, same, "left_semi")).select(*BAR_COLS, "period").withColumn("_v", F.lit(0))
    both = before.unionByName(rows.withColumn("_v", F.lit(1)))
    bar = F.struct("open", "high", "low", "close", "volume")
    merged = both.groupBy("symbol", "period", "bar_ts").agg(F.max_by(bar, F.struct("_v", bar)).alias("b")).select("symbol", "period", "bar_ts", "b.*")
    _write(merged.filter(F.col("close").isNotNull()), root, new)
    _publish(now.join(touched, same, "left_anti").unionByName(_counted(spark, root, new)), root, new)
    return new


def load(spark: SparkSession, root: str, version: int | None = None, symbols: list[str] | None = None) -> DataFrame:
    """The bars of a version (the newest by default)."""
    parts = manifest(spark, root, version)
    if symbols:
        parts = parts.filter(F.col("symbol").isin(symbols))
    return _resolved(spark, root, parts).select(*BAR_COLS)
