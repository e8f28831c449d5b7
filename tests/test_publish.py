"""Spark and DuckDB publish the same digits for the same doubles, including noisy decimal ties."""

import random

import duckdb

from candela.functions.scalar import publish_frame
from candela.plans.sqlparts import publish_sql


def test_publish_equal_across_engines(spark):
    rnd = random.Random(11)
    vals = [12830.3507135, -1592.2408455, -1592.2408455000002, 634868498.911919, 8.534493920301538e59, 1.0000005,
            0.0012345675, 1e-9, 999.9999999999999, 1000.0, 0.0]
    vals += [rnd.uniform(-1, 1) * 10 ** rnd.randint(-12, 60) for _ in range(2000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, x double")
    got = {r.i: r.x for r in publish_frame(df, {"x": (6, 10)}).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest($v)::DOUBLE AS x, generate_subscripts($v, 1) - 1 AS i", {"v": vals})
    exp = dict(con.execute(f"SELECT i, {publish_sql('x')} FROM t").fetchall())
    assert all(got[i] == exp[i] for i in range(len(vals)))
    assert got[1] == got[2] == -1592.240845                 # last-bit noise does not decide the tie
