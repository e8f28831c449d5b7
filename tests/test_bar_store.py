"""Amended bars: versions, untouched partitions, failed attempts."""

import datetime as dt
import os
import tempfile

from candela.sources import bar_store as ST

SCHEMA = "symbol string, bar_ts timestamp_ntz, open double, high double, low double, close double, volume double"


def bar(symbol, month, day, close, year=2024):
    return (symbol, dt.datetime(year, month, day), 1.0, 2.0, 0.5, close, 10.0)


def files(root):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(f"{root}/data") for f in fs if f.endswith(".parquet"))


def table(df):
    return sorted((r.symbol or "", r.bar_ts, r.close) for r in df.collect())


def test_amendments(spark):
    root = tempfile.mkdtemp(prefix="candela-store-")
    first = [bar(s, m, d, 5.0) for s in ("a", "7", "x/y z") for m in (1, 2) for d in (1, 2)] + [bar(None, 1, 1, 6.0)]
    ST.create(spark.createDataFrame(first, SCHEMA).repartition(4), root)
    assert len(files(root)) == 7 and ST.latest_version(spark, root) == 0
    before = files(root)
    assert ST.amend(spark.createDataFrame([bar("a", 2, 2, 9.0), bar("a", 2, 3, 8.0), bar("new", 3, 1, 1.0)], SCHEMA), root) == 1
    assert [f for f in files(root) if f not in before] and set(before) < set(files(root)) and len(files(root)) == 9  # two partitions
    assert ST.amend(spark.createDataFrame([bar("a", 2, 2, None), bar(None, 1, 1, None), bar("7", 1, 1, 4.0), bar("7", 1, 1, 3.0)], SCHEMA), root) == 2
    want = {(s or "", t, c) for s, t, *_, c, _ in first}
    v1 = (want - {("a", dt.datetime(2024, 2, 2), 5.0)}) | {("a", dt.datetime(2024, 2, 2), 9.0), ("a", dt.datetime(2024, 2, 3), 8.0), ("new", dt.datetime(2024, 3, 1), 1.0)}
    v2 = (v1 - {("a", dt.datetime(2024, 2, 2), 9.0), ("", dt.datetime(2024, 1, 1), 6.0), ("7", dt.datetime(2024, 1, 1), 5.0)}) | {("7", dt.datetime(2024, 1, 1), 4.0)}
    assert table(ST.load(spark, root, 0)) == sorted(want) and table(ST.load(spark, root, 1)) == sorted(v1) and table(ST.load(spark, root)) == sorted(v2)
    held = {(r.symbol, r.period): (r.held, r.rows) for r in ST.manifest(spark, root).collect()}
    assert held["x/y z", "2024-01"] == (0, 2) and held["a", "2024-02"] == (2, 2) and held["new", "2024-03"] == (1, 1) and (None, "2024-01") not in held
    assert table(ST.load(spark, root, symbols=["7"])) == [r for r in sorted(v2) if r[0] == "7"]


def test_failed_attempt_is_not_read_and_is_written_over(spark):
    root = tempfile.mkdtemp(prefix="candela-store-")
    ST.create(spark.createDataFrame([bar("a", 1, 1, 5.0)], SCHEMA), root)
    ST._write(spark.createDataFrame([bar("a", 1, 1, 99.0), bar("b", 1, 1, 99.0)], SCHEMA).withColumn("period", ST._period("month")), root, 1)  # data without a manifest
    assert table(ST.load(spark, root)) == [("a", dt.datetime(2024, 1, 1), 5.0)]
    assert ST.amend(spark.createDataFrame([bar("a", 1, 2, 6.0)], SCHEMA), root) == 1
    assert table(ST.load(spark, root)) == [("a", dt.datetime(2024, 1, 1), 5.0), ("a", dt.datetime(2024, 1, 2), 6.0)]


def test_load_reads_the_named_folders_only(spark):
    root = tempfile.mkdtemp(prefix="candela-store-")
    ST.create(spark.createDataFrame([bar(s, m, 1, 5.0) for s in "abcdef" for m in range(1, 7)], SCHEMA), root)
    ST.amend(spark.createDataFrame([bar("a", 1, 1, 7.0)], SCHEMA), root)
    out = ST.load(spark, root, symbols=["a"])
    assert "dynamicpruning" in out._jdf.queryExecution().executedPlan().toString().lower()


def test_empty_amendment(spark):
    root = tempfile.mkdtemp(prefix="candela-store-")
    ST.create(spark.createDataFrame([bar("a", 1, 1, 5.0)], SCHEMA), root)
    assert ST.amend(spark.createDataFrame([], SCHEMA), root) == 1
    assert table(ST.load(spark, root)) == [("a", dt.datetime(2024, 1, 1), 5.0)]
