"""k-nearest-neighbour regression over a partitioned space tree (ML-7).

The training points of every key (symbol) are split level by level: a node with more than ``leaf_rows`` points is cut along
its widest feature at quantiles from a mergeable sketch, into up to 16 parts. Rows find their child by comparing one
feature with the node's cuts, which arrive by an equi-join on the node. Leaves hold a bounded number of points.

A query searches its own leaf first. The distance of its k-th neighbour there, or the farthest corner of the smallest box
around it that holds k points, bounds what else can matter. The query then walks down the tree, one equi-join from node
to children a level, and only into boxes that reach into that distance; the leaves found are searched and the best k kept.
No step pairs all queries with all points.

Points with equal features beyond the first k (by row key) can never be neighbours and leave before the tree is built, so a
flat series with one point repeated a million times is a leaf of k rows. Distances are Euclidean over the given columns
(scale them first); equal distances go to the smaller row key. Rows with a missing feature are no points and get no
neighbours; training rows without a label are no points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.functions.scalar import div
from candela.session import materialize

FAN = 16
LEAF_ROWS = 256
SKETCH = 2000  # accuracy of the quantile sketch: rank error below 1 / SKETCH
BOX = ["_lo", "_hi"]


def space_tree(rows: DataFrame, cols: Sequence[str], keys: Sequence[str], leaf_rows: int, k: int, fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """``rows``: (keys, ``_x`` features, ``_pt`` whether the row is a point, ...). Returns the rows with ``_node``, the
    node they end in, and ``_lo``, ``_hi``, the smallest box on their path with at least ``k`` points; and the nodes (keys,
    ``_node``, ``_parent``, ``_n``, box, ``_split``)."""
    keys, d = list(keys), len(cols)
    empty = F.lit(None).cast("array<double>")
    active = rows.withColumn("_node", F.lit("")).withColumns({"_lo": empty, "_hi": empty})
    quantiles = F.array(*[F.lit(i / fan) for i in range(1, fan)])
    done = nodes = None
    while True:
        x = [F.element_at("_x", i + 1) for i in range(d)]
        aggs = [F.count(F.lit(1)).alias("_n"), F.array(*[F.min(c) for c in x]).alias("_blo"), F.array(*[F.max(c) for c in x]).alias("_bhi"),
                F.array(*[F.percentile_approx(c, quantiles, SKETCH) for c in x]).alias("_q")]
        seen = active.filter("_pt").groupBy(*keys, "_node").agg(*aggs)
        spread = F.transform("_bhi", lambda h, i: h - F.get("_blo", i))
        seen = seen.withColumn("_dim", F.array_position(spread, F.array_max(spread)).cast("int"))
        lo, hi = F.element_at("_blo", F.col("_dim")), F.element_at("_bhi", F.col("_dim"))
        parts = F.least(F.lit(fan), F.ceil(F.lit(2.0) * F.col("_n") / leaf_rows)).cast("int")
        picked = F.transform(F.sequence(F.lit(1), F.greatest(parts - 1, F.lit(1))),
                             lambda j: F.element_at(F.element_at("_q", F.col("_dim")), F.greatest(F.floor(j * fan / parts), F.lit(1)).cast("int")))
        cuts = F.array_sort(F.array_distinct(F.filter(picked, lambda t: t < hi)))
        middle = lo + (hi - lo) / 2
        cuts = F.when(F.size(cuts) > 0, cuts).otherwise(F.array(F.when(middle < hi, middle).otherwise(lo)))
        seen = seen.withColumn("_split", (F.col("_n") > leaf_rows) & (hi > lo))
        seen = materialize(seen.withColumn("_cuts", F.when(F.col("_split"), cuts)).drop("_q"))
        level = seen.select(*keys, "_node", F.expr("left(_node, length(_node) - 1)").alias("_parent"), "_n", F.col("_blo").alias("_lo"), F.col("_bhi").alias("_hi"), "_split")
        nodes = level if nodes is None else nodes.unionByName(level)
        told = active.join(seen.select(*keys, "_node", "_n", "_blo", "_bhi", "_dim", "_split", "_cuts"), [*keys, "_node"], "left")
        told = told.withColumns({c: F.when(F.col("_n") >= k, F.col(b)).otherwise(F.col(c)) for c, b in zip(BOX, ("_blo", "_bhi"))})
        own = F.element_at("_x", F.col("_dim"))
        told = told.withColumn("_child", F.when(F.col("_split"), F.concat("_node", F.lower(F.hex(F.size(F.filter("_cuts", lambda t: own > t)))))))
        told = told.drop("_n", "_blo", "_bhi", "_dim", "_split", "_cuts")
        if not seen.filter("_split").limit(1).count():
            last = told.drop("_child")
            return (last if done is None else done.unionByName(last)), nodes
        told = materialize(told)
        ended = told.filter(F.col("_child").isNull()).drop("_child")
        done = ended if done is None else done.unionByName(ended)
        active = told.filter(F.col("_child").isNotNull()).withColumn("_node", F.col("_child")).drop("_child")


def _sum_squares(parts: Column) -> Column:
    """Sum in the order of the features, so that bounds and distances round alike."""
    return F.aggregate(parts, F.lit(0.0), lambda a, v: a + v * v)


def _gap(x: str, lo: str, hi: str) -> Column:
    """Squared distance from a point to a box."""
    return _sum_squares(F.transform(x, lambda v, i: F.greatest(F.get(lo, i) - v, v - F.get(hi, i), F.lit(0.0))))


def _reach(x: str, lo: str, hi: str) -> Column:
    """Squared distance from a point to the farthest corner of a box."""
    return _sum_squares(F.transform(x, lambda v, i: F.greatest(F.abs(v - F.get(lo, i)), F.abs(F.get(hi, i) - v))))


def _nearest_in(points: str, k: int) -> Column:
    """The k nearest of a leaf's points: (d2, key, y), sorted."""
    found = F.transform(points, lambda p: F.struct(_sum_squares(F.transform("_x", lambda v, i: v - F.get(p["x"], i))).alias("d2"), p["key"].alias("key"), p["y"].alias("y")))
    return F.slice(F.array_sort(found), 1, k)


def nearest(df: DataFrame, cols: Sequence[str], label: str, k: int, train_col: str = "is_train", keys: Sequence[str] = ("symbol",),
            row_key: str = "bar_ts", leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``df`` with ``neighbours``: the k nearest training rows of the same key as an array of (d2, key, y), nearest first
    (fewer if there are fewer points; NULL if a feature is missing). ``(keys, row_key)`` must be unique."""
    if k < 1:
        raise ValueError("k must be positive")
    keys, leaf_rows = list(keys), max(leaf_rows, 2 * k)
    whole = F.lit(True)
    for c in cols:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    base = df.filter(whole).select(*keys, F.col(row_key).alias("_id"), F.array(*[F.col(c).cast("double") for c in cols]).alias("_x"),
                                   F.col(label).cast("double").alias("_y"), F.coalesce(F.col(train_col), F.lit(False)).alias("_t"))
    base = materialize(base)
    point = F.col("_t") & F.col("_y").isNotNull()
    first = base.filter(point).withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_x").orderBy("_id"))).filter(F.col("_r") <= k)
    rows = base.join(first.select(*keys, "_id", F.lit(True).alias("_pt")), [*keys, "_id"], "left").withColumn("_pt", F.coalesce("_pt", F.lit(False)))
    rows, nodes = space_tree(rows, cols, keys, leaf_rows, k)
    rows, nodes = materialize(rows), materialize(nodes)
    leaves = materialize(rows.filter("_pt").groupBy(*keys, "_node").agg(F.collect_list(F.struct(F.col("_x").alias("x"), F.col("_id").alias("key"), F.col("_y").alias("y"))).alias("_points")))

    # own leaf first: a bound for every query
    ask = rows.drop("_pt", "_t", "_y").join(leaves, [*keys, "_node"], "left").withColumn("_near", _nearest_in("_points", k)).drop("_points")
    here = F.when(F.size("_near") >= k, F.element_at("_near", k)["d2"])
    far = F.when(F.col("_lo").isNotNull(), _reach("_x", "_lo", "_hi"))
    ask = ask.withColumn("_tau", F.coalesce(F.least(here, far), F.lit(float("inf"))))
    ask = materialize(ask.drop(*BOX).withColumn("_near", F.filter("_near", lambda p: p["d2"] <= F.col("_tau"))))

    # down the tree, into boxes within the bound
    child = nodes.filter("_node <> ''").select(*keys, F.col("_parent").alias("_at"), F.col("_node").alias("_to"), *BOX, "_split")
    front = ask.select(*keys, "_id", "_x", "_tau", F.col("_node").alias("_home"), F.lit("").alias("_at"))
    front = front.join(nodes.filter("_node = '' AND _split").select(*keys), keys, "left_semi")
    hits = None
    for _ in range(nodes.agg(F.max(F.length("_node"))).first()[0] or 0):
        front = materialize(front.join(child, [*keys, "_at"]).filter(_gap("_x", "_lo", "_hi") <= F.col("_tau")).drop(*BOX, "_at"))
        leaf = front.filter(~F.col("_split") & (F.col("_to") != F.col("_home"))).select(*keys, "_id", "_x", "_tau", F.col("_to").alias("_node"))
        hits = leaf if hits is None else hits.unionByName(leaf)
        front = front.filter("_split").withColumn("_at", F.col("_to")).drop("_to", "_split")
    one = F.explode("_near").alias("p")
    best = ask.select(*keys, "_id", one)
    if hits is not None:
        more = hits.join(leaves, [*keys, "_node"]).withColumn("_near", F.filter(_nearest_in("_points", k), lambda p: p["d2"] <= F.col("_tau")))
        best = best.unionByName(more.select(*keys, "_id", one))
    along = Window.partitionBy(*keys, "_id").orderBy(F.col("p.d2"), F.col("p.key"))
    best = best.withColumn("_r", F.row_number().over(along)).filter(F.col("_r") <= k)
    best = best.groupBy(*keys, F.col("_id").alias(row_key)).agg(F.array_sort(F.collect_list("p")).alias("neighbours"))
    return df.join(best, [*keys, row_key], "left")


def mean_of(k: int) -> Column:
    """Mean label of the first k neighbours; NULL if there are fewer."""
    return F.when(F.size("neighbours") >= k, F.aggregate(F.slice("neighbours", 1, k), F.lit(0.0), lambda a, p: a + p["y"]) / k)


def knn_regression(df: DataFrame, cols: Sequence[str], label: str, k: int, out: str = "pred", train_col: str = "is_train", keys: Sequence[str] = ("symbol",),
                   row_key: str = "bar_ts", leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """ML-7: ``df`` (training and test rows) with the mean label of the k nearest training rows. A training row is its own
    nearest neighbour, as in a model that is asked for its training rows."""
    return nearest(df, cols, label, k, train_col, keys, row_key, leaf_rows).withColumn(out, mean_of(k)).drop("neighbours")


def knn_scores(df: DataFrame, cols: Sequence[str], label: str, ks: Sequence[int] = range(2, 13), train_col: str = "is_train",
               keys: Sequence[str] = ("symbol",), row_key: str = "bar_ts", leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """ML-7: R^2 on training and test rows per key and k, from one search for the largest k."""
    ks, keys = sorted(ks), list(keys)
    rows = materialize(df.select(*keys, row_key, train_col, label, *cols))
    near = nearest(rows, cols, label, ks[-1], train_col, keys, row_key, leaf_rows).filter(F.col(label).isNotNull())
    pred = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), mean_of(k).alias("pred")) for k in ks])).alias("_s")
    long = near.select(*keys, train_col, F.col(label).alias("_y"), pred).select(*keys, train_col, "_y", "_s.*")

    def r2(rows: Column) -> Column:
        return F.lit(1.0) - div(F.avg(F.when(rows, F.pow(F.col("_y") - F.col("pred"), 2))), F.var_pop(F.when(rows, F.col("_y"))))

    return long.groupBy(*keys, "k").agg(r2(F.col(train_col)).alias("r2_train"), r2(~F.col(train_col)).alias("r2_test"))
