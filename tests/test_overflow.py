"""Compounding beyond the range of doubles: products come back into range when they do, infinities are published as they are."""

import datetime as dt
import math

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from candela.functions.scalar import product, publish, publish_frame
from candela.operators.series import running
from candela.plans.sqlparts import publish_sql
from tests.oracle_check import compare, duck

DAY, HOUR = dt.timedelta(days=1), dt.timedelta(hours=1)


def same_as_sql(spark, path, name):
    got = E.queries()[name](spark, str(path)).toPandas()
    ok, msg = compare(got, duck(str(path)).execute(E.oracle_sql()[name]).df())
    assert ok, msg
    return got


def test_values_without_digits_are_published_as_they_are(spark):
    vals = [math.inf, -math.inf, math.nan, 1.7e308, -1.7e308, 5e-324, 0.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, x double")
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest($v)::DOUBLE AS x, generate_subscripts($v, 1) - 1 AS i", {"v": vals})
    exp = [str(v) for _, v in con.execute(f"SELECT i, {publish_sql('x')} FROM t ORDER BY i").fetchall()]
    for got in (publish_frame(df, {"x": (6, 10)}), df.select("i", publish("x").alias("x"))):
        assert [str(r.x) for r in got.orderBy("i").collect()] == exp


def test_products_that_leave_the_range_come_back(small_blocks):
    """Up to 1e400 and back, then down to 1e-400 and back, then a zero; over many blocks."""
    f = [1e8] * 50 + [1e-8] * 99 + [1e8] * 49 + [-3.0, None, 2.0, 0.0, 1e300, 1e300]
    df = small_blocks.createDataFrame([("a", i, i // 16, x) for i, x in enumerate(f)], "symbol string, rn long, _blk long, x double")
    got = [r.p for r in running(df, [("x", "product", "p")]).orderBy("rn").collect()]
    log = 0
    for i, (x, p) in enumerate(zip(f[:198], got)):
        log += 8 if x > 1 else -8
        assert p == (math.inf if log > 308 else 0.0 if log < -323 else pytest.approx(float(f"1e{log}"), rel=1e-10)), i
    assert got[198:202] == [pytest.approx(-3.0)] * 2 + [pytest.approx(-6.0), 0.0] and got[202:] == [0.0, 0.0]
    whole = df.filter("rn < 200").repartition(3).agg(product(F.col("x")).alias("p")).first().p
    assert whole == pytest.approx(-3.0)


@pytest.fixture(scope="module")
def swings(tmp_path_factory):
    """Five event types whose values swing by 10,000, each in its own hours."""
    path = tmp_path_factory.mktemp("swings")
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + HOUR * h, f"e{s}", 1e4 if (h + s) % 2 else 1.0 + s) for h in range(240) for s in range(5)]
    pq.write_table(pa.table({"event_id": pa.array(range(len(rows)), pa.int64()), "ts": pa.array([r[0] for r in rows], pa.timestamp("us")),
                             "event_type": [r[1] for r in rows], "value": [r[2] for r in rows]}), path / "events.parquet")
    return path


def test_signal_basket_beyond_the_range(spark, swings):
    got = same_as_sql(spark, swings, "prt01_signal_basket")
    assert (got.CMR == math.inf).any() and (got.CMR < math.inf).any()


def test_basket_sweep_beyond_the_range(spark, swings):
    got = same_as_sql(spark, swings, "swp01_basket_sweep")
    assert len(got) == 36 and (got.CMR == math.inf).all()


def test_stops_and_shorts_beyond_the_range(spark, tmp_path):
    """Every other day a short trade loses a thousand times its stake: CSR grows in turns of sign."""
    t0, rows = dt.datetime(1995, 1, 1), []
    for d in range(300):
        for price in ((1.0, 1000.0) if d % 2 else (2000.0,)):
            rows.append((len(rows), t0 + DAY * d, price))
    pq.write_table(pa.table({"l_orderkey": pa.array([r[0] for r in rows], pa.int64()), "l_partkey": pa.array([1] * len(rows), pa.int64()),
                             "l_quantity": [1.0] * len(rows), "l_extendedprice": [r[2] for r in rows],
                             "l_shipdate": pa.array([r[1] for r in rows], pa.timestamp("us"))}), tmp_path / "lineitem.parquet")
    pq.write_table(pa.table({"p_partkey": pa.array([1], pa.int64()), "p_brand": ["Brand#11"]}), tmp_path / "part.parquet")
    got = same_as_sql(spark, tmp_path, "pnl01_12_stops_short_daily")
    assert (got.CSR == math.inf).any() and (got.CSR == -math.inf).any() and (got.CSR.abs() < math.inf).any()
