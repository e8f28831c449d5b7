"""Streaming bars equal batch bars when ticks arrive over several micro-batches."""

import tempfile

from pyspark.sql import functions as F

from candela.sources.fixtures import bars_hourly
from candela.streaming import bars as ST
from tests.conftest import SF0001


def test_stream_in_several_batches_equals_batch(spark):
    root = tempfile.mkdtemp(prefix="candela-stream-")
    land = f"{root}/land"
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    # land the events as four files in time order (one file per week), each becomes a micro-batch
    for i, (lo, hi) in enumerate([("2024-01-01", "2024-01-08"), ("2024-01-08", "2024-01-15"),
                                  ("2024-01-15", "2024-01-22"), ("2024-01-22", "2024-02-01")]):
        part = ev.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
        part.coalesce(1).write.mode("overwrite").parquet(f"{land}/chunk={i}")
    q = (ST.streaming_bars(ST.tick_stream(spark, f"{land}/*/*.parquet", max_files=1)).writeStream.outputMode("update")
         .option("checkpointLocation", f"{root}/state").foreachBatch(ST._versioned_writer(f"{root}/out"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = ST.latest_bars(spark, f"{root}/out")
    assert spark.read.parquet(f"{root}/out").select("batch_id").distinct().count() >= 4
    exp = bars_hourly(spark, SF0001)
    cols = ["symbol", "bar_ts", "open", "high", "low", "close", F.round("volume", 6).alias("volume")]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, exp.select(*cols).collect()))


def test_signal_stream_with_bounded_tail_matches_batch(spark):
    from candela.config import PRESETS
    from candela.operators.series import RN
    from candela.operators.signals import roc_signal
    cfg = PRESETS["eth_usd_roc"]
    root = tempfile.mkdtemp(prefix="candela-sigstream-")
    land = f"{root}/land"
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    for i, (lo, hi) in enumerate([("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")]):
        part = ev.filter((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
        part.coalesce(1).write.mode("overwrite").parquet(f"{land}/chunk={i}")
    ST.run_signal_stream(spark, f"{land}/*/*.parquet", f"{root}/bars", f"{root}/sig", f"{root}/state", cfg)
    got = {r.symbol: (r.bar_ts, r.signal) for r in ST.latest_signals(spark, f"{root}/sig").collect()}
    td = roc_signal(bars_hourly(spark, SF0001), cfg)
    exp = {r.symbol: (r.l.bar_ts, r.l.signal) for r in
           td.groupBy("symbol").agg(F.max_by(F.struct("bar_ts", "signal"), RN).alias("l")).collect()}
    assert got == exp


def test_signal_carried_over_ignored_buckets_in_the_stream(spark):
    """Four micro-batches; bucket 0 (Sell) is ignored, so a Buy is held for longer than the tail."""
    import datetime as dt

    from candela.config import PRESETS
    from candela.operators.signals import roc_signal
    from candela.streaming.bars import EVENTS_SCHEMA
    cfg = PRESETS["eth_usd_roc"].with_(roc_period=3, roc_threshold=5.0, ignore_signals=(0,))
    root = tempfile.mkdtemp(prefix="candela-carry-")
    start = dt.datetime(2024, 1, 1)
    prices = [100.0 + (30.0 if 12 <= h < 15 else 0.0) for h in range(80)]
    rows = [(h, start + dt.timedelta(hours=h), 1, "up", p, "") for h, p in enumerate(prices)] + [
        (1000 + h, start + dt.timedelta(hours=h), 1, "flat", 50.0, "") for h in range(80)]
    for i in range(4):
        part = [r for r in rows if i * 20 <= (r[1] - start).total_seconds() / 3600 < (i + 1) * 20]
        spark.createDataFrame(part, EVENTS_SCHEMA).coalesce(1).write.parquet(f"{root}/land/chunk={i}")
    ticks = ST.tick_stream
    ST.tick_stream = lambda s, path: ticks(s, path, max_files=1)
    try:
        ST.run_signal_stream(spark, f"{root}/land/*/*.parquet", f"{root}/bars", f"{root}/sig", f"{root}/state", cfg)
    finally:
        ST.tick_stream = ticks
    assert spark.read.parquet(f"{root}/sig").select("batch_id").distinct().count() >= 4
    bars = ST.latest_bars(spark, f"{root}/bars")
    td = roc_signal(bars, cfg)
    want = {r.symbol: (r.l.bar_ts, r.l.signal) for r in td.groupBy("symbol").agg(F.max_by(F.struct("bar_ts", "signal"), "bar_ts").alias("l")).collect()}
    got = {r.symbol: (r.bar_ts, r.signal) for r in ST.latest_signals(spark, f"{root}/sig").collect()}
    assert got == want and got["up"][1] == "Buy" and got["flat"][1] is None


def _drain(spark, root, rows_per_file, cfg, watermark):
    from candela.streaming.bars import EVENTS_SCHEMA
    for i, part in enumerate(rows_per_file):
        spark.createDataFrame(part, EVENTS_SCHEMA).coalesce(1).write.parquet(f"{root}/land/chunk={i}")
    ticks = ST.tick_stream
    ST.tick_stream = lambda s, path: ticks(s, path, max_files=1)
    try:
        ST.run_signal_stream(spark, f"{root}/land/*/*.parquet", f"{root}/bars", f"{root}/sig", f"{root}/state", cfg, watermark=watermark)
    finally:
        ST.tick_stream = ticks
    return {r.symbol: (r.bar_ts, r.signal) for r in ST.latest_signals(spark, f"{root}/sig").collect()}


def test_late_ticks_older_than_the_look_back_equal_batch(spark):
    """Three ticks, 60 bars late, undo a rise whose Buy was carried over ignored buckets ever since; other late ticks make a
    bar that was missing, which shifts every later look-back."""
    import datetime as dt

    from candela.config import PRESETS
    from candela.operators.series import RN
    from candela.operators.signals import roc_signal
    cfg = PRESETS["eth_usd_roc"].with_(roc_period=3, roc_threshold=5.0, ignore_signals=(0,))
    start = dt.datetime(2024, 1, 1)
    at = lambda h, m=0: start + dt.timedelta(hours=h, minutes=m)
    rise = [100.0 + (30.0 if 12 <= h < 15 else 0.0) for h in range(80)]
    rows = [(h, at(h), 1, s, p, "") for s, shift in (("undone", 0), ("kept", 0)) for h, p in enumerate(rise)]
    gap = [(500 + h, at(h), 1, "gap", 100.0 + (h * 7 % 11), "") for h in range(80) if h != 20]
    files = [[r for r in rows + gap if i * 20 <= (r[1] - start).total_seconds() / 3600 < (i + 1) * 20] for i in range(4)]
    late = [(900 + h, at(h, 30), 1, "undone", 100.0, "") for h in (12, 13, 14)] + [(950, at(20), 1, "gap", 400.0, "")]
    root = tempfile.mkdtemp(prefix="candela-late-")
    got = _drain(spark, root, [*files, late, [(990, at(80), 1, "kept", 100.0, "")]], cfg, "300 hours")
    assert spark.read.parquet(f"{root}/sig").select("batch_id").distinct().count() >= 5
    td = roc_signal(ST.latest_bars(spark, f"{root}/bars"), cfg)
    want = {r.symbol: (r.l.bar_ts, r.l.signal) for r in td.groupBy("symbol").agg(F.max_by(F.struct("bar_ts", "signal"), RN).alias("l")).collect()}
    assert got == want
    assert got["undone"][1] is None and got["kept"][1] == "Buy"


def test_replay_after_any_order_of_arrival_equals_one_run():
    """The state alone: random corrections and insertions within the allowed lateness, small state, against all bars at once."""
    import random

    from candela.config import PRESETS
    from candela.streaming.signal_state import SignalState, replay, trimmed
    r = random.Random(2)
    for trial in range(40):
        cfg = PRESETS["eth_usd_roc"].with_(roc_period=r.choice([2, 5]), signal_delay=r.choice([0, 3]), roc_threshold=1.0,
                                           ignore_signals=r.choice([None, (0,), (1000,)]), hold_signals=r.choice([None, (1000,)]))
        state, late = SignalState(cfg, 1, 12), 12
        truth, bars, gone, before = {}, [], 0, [None, None, None, None]
        for step in range(120):
            newest = max(truth, default=0)
            t = newest + 1 if r.random() < 0.6 else max(1, newest - r.randrange(late))
            truth[t] = r.choice([0.0, 90.0, 100.0, 110.0, 125.0])
            known = {b[0]: b for b in bars}
            assert bars == [] or t >= bars[0][0] or not gone
            known[t] = [t, 0, truth[t], None, None, None]
            bars = [known[k] for k in sorted(known)]
            replay(bars, [b[0] for b in bars].index(t), gone, before[0], cfg)
            gone, before, bars = trimmed(bars, gone, before, state.keep_from(bars))
            whole = [[k, 0, truth[k], None, None, None] for k in sorted(truth)]
            replay(whole, 0, 0, None, cfg)
            last = next(((b[0], b[4], b[5]) for b in reversed(whole) if b[4] is not None), None)
            mine = next(((b[0], b[4], b[5]) for b in reversed(bars) if b[4] is not None), tuple(before[1:]) if before[1] is not None else None)
            assert mine == last and len(bars) <= late + cfg.roc_period + cfg.signal_delay + 6
