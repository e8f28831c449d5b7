"""Structured Streaming: bars from a tick stream (STR-1) and the latest signal per symbol on each
new bar (STR-2).

Bars are an event-time tumbling-window aggregation with a watermark (late ticks within the
watermark update their bar; state older than the watermark is dropped). The sink is a
``foreachBatch`` writer that overwrites the folder of its own batch id, so a retried batch after an
executor or driver loss rewrites the same files (idempotent); readers take the newest version of
each bar. Signals are a keyed stateful operator over the same ticks (``signal_state``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.config import StrategyConfig

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def tick_stream(spark: SparkSession, path: str, schema: T.StructType = EVENTS_SCHEMA, max_files: int = 100) -> DataFrame:
    """Events files as a stream of ticks (symbol, ts TIMESTAMP, price, volume)."""
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)
    return raw.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"),
                      F.col("value").alias("price"), F.col("value").alias("volume"))


def streaming_bars(ticks: DataFrame, period: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """STR-1: OHLCV bars per symbol and tumbling event-time window."""
    key = F.struct("ts")
    return (ticks.withWatermark("ts", watermark)
            .groupBy("symbol", F.window("ts", period).alias("w"))
            .agg(F.min_by("price", key).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
                 F.max_by("price", key).alias("close"), F.sum("volume").cast("double").alias("volume"))
            .select("symbol", F.col("w.start").cast("timestamp_ntz").alias("bar_ts"), "open", "high", "low", "close",
                    "volume"))


def _versioned_writer(out: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}"))
    return write


def run_bar_stream(spark: SparkSession, source: str, out: str, checkpoint: str, period: str = "1 hour",
                   watermark: str = "2 hours") -> None:
    """Drain ``source`` (trigger availableNow) into versioned bar files under ``out`` (update mode)."""
    q = (streaming_bars(tick_stream(spark, source), period, watermark).writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint).foreachBatch(_versioned_writer(out))
         .trigger(availableNow=True).start())
    q.awaitTermination()


def latest_bars(spark: SparkSession, out: str) -> DataFrame:
    """Newest version of every bar written by ``run_bar_stream``."""
    v = spark.read.parquet(out)
    return (v.groupBy("symbol", "bar_ts").agg(F.max_by(F.struct("open", "high", "low", "close", "volume"), "batch_id").alias("b"))
            .select("symbol", "bar_ts", "b.*"))


def run_signal_stream(spark: SparkSession, source: str, bars_out: str | None, signals_out: str, checkpoint: str,
                      cfg: StrategyConfig, period: str = "1 hour", watermark: str = "2 hours") -> None:
    """STR-2: drain ``source`` into the latest ROC signal per symbol, one version per micro-batch and changed symbol.

    Ticks are reduced to partial closes per symbol and bar inside each input partition, so that a hot symbol sends a few rows
    per partition and bar to its state (``SignalState``). A retried batch rewrites its own folder. With ``bars_out`` the
    bars are stored as well (``run_bar_stream``). Ticks more than ``watermark`` behind the newest bar of their symbol are
    dropped."""
    from candela.streaming.signal_state import PARTIAL, RESULT, SignalState, partial_closes

    if bars_out is not None:
        run_bar_stream(spark, source, bars_out, f"{checkpoint}_bars", period, watermark)
    width, late = (int(spark.sql(f"SELECT CAST(INTERVAL '{x}' AS INTERVAL DAY TO SECOND) AS i").first().i.total_seconds()) for x in (period, watermark))
    ticks = tick_stream(spark, source).select("symbol", F.unix_micros("ts").alias("at"), "price")
    parts = ticks.mapInPandas(partial_closes(width * 1_000_000), PARTIAL)
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        signals = parts.groupBy("symbol").transformWithStateInPandas(SignalState(cfg, width * 1_000_000, late * 1_000_000), RESULT, "Update", "None")
        out = signals.select("symbol", F.timestamp_micros("bar").cast("timestamp_ntz").alias("bar_ts"), "y_pred_val", "signal")
        q = (out.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(_versioned_writer(signals_out))
             .trigger(availableNow=True).start())
    finally:
        spark.conf.set(key, old) if old is not None else spark.conf.unset(key)
    q.awaitTermination()


def latest_signals(spark: SparkSession, signals_out: str) -> DataFrame:
    s = spark.read.parquet(signals_out)
    return s.groupBy("symbol").agg(F.max_by(F.struct("bar_ts", "y_pred_val", "signal"), "batch_id").alias("l")).select("symbol", "l.*")
