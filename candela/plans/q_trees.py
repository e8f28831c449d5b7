"""Registered queries for trees (ML-5, TOP-4). The oracle SQL builds the same trees level by level from the definition."""

from __future__ import annotations

from pyspark.sql import functions as F

from candela.operators import trees as TR
from candela.plans.catalog import register, rounded, rsql
from candela.plans.q_ml_stream import LAG_SQL, _lagged

COLS = ["Lag1", "Lag2", "Lag3", "Lag4", "Lag5"]
TREES, DEPTHS, TRIES = (50, 100, 200), (3, 4, 5), (2, 4, 8)
SINGLE = (3, 5, 10)
ROUNDS = 4

_BINNED = LAG_SQL + f""",
tv AS (SELECT CAST(epoch(bar_ts) AS BIGINT) + 7 * ascii(symbol) AS k, [{', '.join(COLS)}] AS v, CAST(floor(Today * 1000000 + 0.5) AS BIGINT) AS y, is_train AS train FROM v),
st AS (SELECT f, v[f] AS x, row_number() OVER (PARTITION BY f ORDER BY v[f]) AS r, count(*) OVER (PARTITION BY f) AS n FROM tv, range(1, 6) t(f) WHERE train),
ed AS (SELECT f, list(x ORDER BY i) AS e FROM st, range(1, {TR.BINS}) u(i) WHERE r = floor(i / {TR.BINS} * (n - 1)) + 1 GROUP BY f),
el AS (SELECT list(e ORDER BY f) AS e FROM ed),
rw AS MATERIALIZED (SELECT row_number() OVER () AS rid, k, y, train, list_transform(range(1, 6), lambda f: len(list_filter(e[f], lambda z: z < v[f]))) AS x FROM tv, el)"""


def _levels(p: str, depth: int, start: str) -> str:
    """CTEs ``{p}0`` .. ``{p}{depth}`` (rid, tree, t, m, node, w): where each row is in each tree after so many splits; and
    ``{p}best{i}`` (tree, node, f, bin, gain): the splits of a level. ``start`` selects level 0; labels come from ``{p}y``."""
    out = [f"{p}0 AS MATERIALIZED ({start})"]
    for i in range(depth):
        out.append(f"""{p}h{i} AS (SELECT tree, any_value(t) AS t, any_value(m) AS m, node, f, x[f] AS bin, sum(w) AS n, sum(CAST(w * yy AS DOUBLE)) AS s
  FROM {p}{i} JOIN {p}y USING (rid) JOIN rw USING (rid), range(1, 6) q(f) WHERE rw.train AND w > 0 AND node >= {1 << i} GROUP BY tree, node, f, bin),
{p}c{i} AS (SELECT tree, t, m, node, f, bin, CAST(sum(n) OVER g AS DOUBLE) AS ln, sum(s) OVER g AS ls,
  CAST(sum(n) OVER (PARTITION BY tree, node, f) AS DOUBLE) AS n, sum(s) OVER (PARTITION BY tree, node, f) AS s FROM {p}h{i} WINDOW g AS (PARTITION BY tree, node, f ORDER BY bin)),
{p}g{i} AS (SELECT *, ls * ls / ln + (s - ls) * (s - ls) / (n - ln) - s * s / n AS gain,
  dense_rank() OVER (PARTITION BY tree, node ORDER BY (t * 31 + node * 17 + (f - 1) * 101) * 7919 % 1009 * 64 + f) AS mark FROM (
  SELECT * FROM {p}c{i}) WHERE true),
{p}best{i} AS MATERIALIZED (SELECT tree, node, arg_max(f, (gain, -f, -bin)) AS f, arg_max(bin, (gain, -f, -bin)) AS bin, max(gain) AS gain
  FROM {p}g{i} WHERE mark <= m AND n > ln AND gain > 0 GROUP BY tree, node),
{p}{i + 1} AS MATERIALIZED (SELECT rid, tree, t, m, CASE WHEN b.f IS NULL THEN a.node ELSE 2 * a.node + CAST(x[b.f] > b.bin AS INT) END AS node, w
  FROM {p}{i} a JOIN rw USING (rid) LEFT JOIN {p}best{i} b USING (tree, node))""")
    return ",\n".join(out)


def _means(p: str, depth: int) -> str:
    """Value of every row in every tree at a depth: the weighted mean label of its node's training rows."""
    return f"""{p}v{depth} AS (SELECT rid, a.tree, t, m, v FROM {p}{depth} a JOIN (SELECT tree, node, sum(CAST(w * yy AS DOUBLE)) / sum(w) AS v
  FROM {p}{depth} JOIN {p}y USING (rid) JOIN rw USING (rid) WHERE rw.train AND w > 0 GROUP BY tree, node) USING (tree, node))"""


def _r2(model: str, source: str) -> str:
    """R^2 of predictions (rid, v in units) by part."""
    part = "1 - sum(CASE WHEN {0} THEN pow((y - v) / 1000000, 2) END) / nullif(sum(CASE WHEN {0} THEN pow(y / 1000000, 2) END) - pow(sum(CASE WHEN {0} THEN y / 1000000 END), 2) / count(*) FILTER ({0}), 0)"
    return f"SELECT {model} AS model, {part.format('train')} AS r2_train, {part.format('NOT train')} AS r2_test FROM {source} JOIN rw USING (rid)"


_U = "((k % {p} + 1) * (2 * t + 1) * 7919 + t * 104729) % {p} / {p}".format(p=TR.PRIME)
_BOOT = " + ".join(f"CAST({_U} >= {d} AS INT)" for d in TR.DRAWS)


def _forest(tries, trees: int, depth: int) -> str:
    start = f"SELECT rid, {{m}} * 1000 + t AS tree, t, {{m}} AS m, 1 AS node, {_BOOT} AS w FROM rw, range(0, {trees}) z(t)"
    return "fy AS (SELECT rid, y AS yy FROM rw), " + _levels("f", depth, " UNION ALL ".join(start.format(m=m) for m in tries))


def _grid_sql() -> str:
    parts = [_BINNED, "dy AS (SELECT rid, y AS yy FROM rw)", _levels("d", max(SINGLE), "SELECT rid, 0 AS tree, 0 AS t, 5 AS m, 1 AS node, 1 AS w FROM rw"), _forest(TRIES, max(TREES), max(DEPTHS))]
    parts += [_means("d", k) for k in SINGLE] + [_means("f", k) for k in DEPTHS]
    single = [_r2(f"'DT_d{k}'", f"(SELECT rid, v FROM dv{k})") for k in SINGLE]
    forest = [f"SELECT 'RF_n{n}_d{k}_f' || CAST(m AS VARCHAR) AS model, m, rid, avg(v) AS v FROM fv{k} WHERE t < {n} GROUP BY m, rid" for n in TREES for k in DEPTHS]
    parts.append("fp AS (" + " UNION ALL ".join(forest) + ")")
    parts.append("sc AS (" + " UNION ALL ".join(single) + " UNION ALL " + _r2("model", "fp") + " GROUP BY model)")
    order = "list_position([" + ", ".join(f"'RF_n{n}_d{k}_f{m}'" for n in TREES for k in DEPTHS for m in TRIES) + "], model)"
    parts.append(f"bs AS (SELECT arg_max(model, (r2_test, -{order})) AS b FROM sc WHERE starts_with(model, 'RF_'))")
    parts.append("fin AS (SELECT model, r2_train, r2_test, model = b AS best_forest FROM sc, bs)")
    return ",\n".join(parts) + "\n" + rsql(["model", "r2_train", "r2_test", "best_forest"], ["r2_train", "r2_test"], "fin")


def _rows(spark, sf):
    return _lagged(spark, sf).withColumn("key", F.unix_seconds(F.col("bar_ts").cast("timestamp")) + 7 * F.ascii("symbol"))


@register("ml05_regressor_grid", _grid_sql())
def q_ml05(spark, sf):
    """ML-5: trees by depth and the forest grid (27 settings) of Today on five lags: R^2 on training and test rows."""
    return rounded(TR.tree_and_forest_grid(_rows(spark, sf), COLS, "Today", "key", depths=SINGLE, trees=TREES, forest_depths=DEPTHS, max_features=TRIES))


def _importance_sql() -> str:
    gains = " UNION ALL ".join(f"SELECT f, gain FROM fbest{i}" for i in range(3))
    names = ", ".join(f"({i + 1}, '{c}')" for i, c in enumerate(COLS))
    return ",\n".join([_BINNED, _forest((4,), 200, 3)]) + f""",
gs AS ({gains}),
im AS (SELECT feature, coalesce(sum(gain), 0) / (SELECT sum(gain) FROM gs) AS importance FROM (VALUES {names}) n(f, feature) LEFT JOIN gs USING (f) GROUP BY feature)
""" + rsql(["feature", "importance"], ["importance"], "im")


@register("top04_feature_importances", _importance_sql())
def q_top04(spark, sf):
    """TOP-4: importances of the lag features in a forest of 200 trees of depth 3, sorted."""
    return rounded(TR.importances(_rows(spark, sf), COLS, "Today", "key"))


def _boosted_sql() -> str:
    parts = [_BINNED, "b0y AS (SELECT rid, y - (SELECT CAST(floor(sum(y) / count(*) + 0.5) AS BIGINT) FROM rw WHERE train) AS yy FROM rw)"]
    for i in range(ROUNDS):
        p = f"b{i}"
        step = f"""(SELECT rid, floor(0.1 * v + 0.5) AS d FROM {p}v3)"""
        parts += [f"{p}xy AS (SELECT * FROM {p}y)", _levels(f"{p}x", 3, "SELECT rid, 0 AS tree, 0 AS t, 5 AS m, 1 AS node, 1 AS w FROM rw"), _means(f"{p}x", 3).replace(f"{p}xv3 AS", f"{p}v3 AS"),
                  f"b{i + 1}y AS MATERIALIZED (SELECT rid, CAST(yy - d AS BIGINT) AS yy FROM {p}y JOIN {step} USING (rid))"]
    fit = [f"SELECT {i} AS round, train, b{i}y.yy AS e, rw.y FROM b{i}y JOIN rw USING (rid)" for i in range(ROUNDS + 1)]
    part = "1 - avg(CASE WHEN {0} THEN pow(e / 1000000, 2) END) / nullif(var_pop(CASE WHEN {0} THEN y / 1000000 END), 0)"
    parts.append("bf AS (SELECT CAST(round AS INT) AS round, " + part.format("train") + " AS r2_train, " + part.format("NOT train") + " AS r2_test FROM (" + " UNION ALL ".join(fit) + ") GROUP BY round)")
    return ",\n".join(parts) + "\n" + rsql(["round", "r2_train", "r2_test"], ["r2_train", "r2_test"], "bf")


@register("ml05_boosted_trees", _boosted_sql())
def q_ml05_boosted(spark, sf):
    """ML-5: boosted trees of depth 3, R^2 after each of the first rounds."""
    return rounded(TR.boosted(_rows(spark, sf), COLS, "Today", "key", rounds=ROUNDS))
