"""Regression trees, forests and boosted trees on shared bins (ML-5, TOP-4).

Features become bin numbers once (equal-frequency edges of the training rows), labels integers (1e-6 steps), so that every
sum is exact and a run gives the same trees in any order of rows and tasks. All trees grow together, one pass over the rows a
level: each task sends its rows down the trees so far and adds them to histograms (tree, node, feature, bin) of counts and
sums, these are summed by key, and the best split of every node comes back. The rows never move. A tree of depth d is
the top of a deeper one and a small forest the beginning of a larger one, so one run serves a whole grid of settings.

A split's gain is the fall of the squared error, ties go to the smaller feature, then bin; a node is split if its gain is
positive. Forest trees weigh rows by a bootstrap count and see ``max_features`` features at a node, both from fixed
arithmetic on (row key, tree) and (tree, node, feature), so no generator's state has to be kept. What the driver holds is
the model: bounded by the settings (trees x 2 ** depth nodes), not by the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.operators.risk import equal_frequency_edges
from candela.session import materialize

BINS = 32
UNIT = 1_000_000
PRIME = 1_000_003
# a bootstrap draws each row about Poisson(1) times: the count by a uniform number's place among these shares
DRAWS = (0.367879, 0.735759, 0.919699, 0.981012)
CELLS = 1 << 22  # rows x trees handled at once


def binned(df: DataFrame, cols: Sequence[str], label: str, key: str, train_col: str = "is_train", bins: int = BINS) -> DataFrame:
    """Rows for the trees: ``key`` (a long that tells rows apart), ``x`` (bin numbers), ``y`` (label in units of 1e-6),
    ``train``. Bins by the edges of all training rows; rows with a missing feature or label are left out."""
    rows = df.dropna(subset=[*cols, label])
    edges = equal_frequency_edges(rows.filter(F.col(train_col)).withColumn("_all", F.lit("")), cols, bins, ["_all"])
    known = {r.feature: r.edges for r in edges.collect()}  # cols x bins numbers
    x = [_bin(c, known.get(c, [])) for c in cols]
    return materialize(rows.select(F.col(key).cast("long").alias("key"), F.array(*x).alias("x"),
                                   F.floor(F.col(label) * UNIT + 0.5).cast("long").alias("y"), F.col(train_col).alias("train")))


def _bin(c: str, edges: list[float]):
    return F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]).cast("array<double>"), lambda e: e < F.col(f"`{c}`")))


class Family:
    """Trees of one shape: per tree its number, the features it tries at a node, and whether it bootstraps."""

    def __init__(self, trees: Sequence[tuple[int, int, bool]], depth: int, features: int, bins: int = BINS):
        self.number, self.tries, self.boot = (np.array(c) for c in zip(*trees))
        self.depth, self.features, self.bins = depth, features, bins
        shape = (len(self.number), 2 << depth)
        self.feature, self.cut = np.full(shape, -1, np.int16), np.zeros(shape, np.int16)
        self.count, self.sum, self.gain = np.zeros(shape), np.zeros(shape), np.zeros(shape)

    def weights(self, key: np.ndarray) -> np.ndarray:
        """Rows x trees."""
        k, t = key[:, None] % PRIME, self.number[None].astype(np.int64)
        u = ((k + 1) * (2 * t + 1) * 7919 + t * 104729) % PRIME / PRIME
        return np.where(self.boot[None], np.searchsorted(np.array(DRAWS), u, "right"), 1)

    def tried(self, tree: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Nodes x features: the ``tries`` features with the smallest marks are tried."""
        mark = (self.number[tree][:, None] * 31 + node[:, None] * 17 + np.arange(self.features)[None] * 101) * 7919 % 1009 * 64 + np.arange(self.features)[None]
        return mark.argsort(1).argsort(1) < self.tries[tree][:, None]

    def descend(self, x: np.ndarray, depth: int) -> np.ndarray:
        """Node of every row in every tree after at most ``depth`` splits (root 1, children 2 i and 2 i + 1)."""
        node = np.ones((len(x), len(self.number)), np.int64)
        tree = np.arange(len(self.number))[None]
        for _ in range(depth):
            f = self.feature[tree, node]
            right = np.take_along_axis(x, np.maximum(f, 0).reshape(node.shape), 1) > self.cut[tree, node]
            node = np.where(f >= 0, 2 * node + right, node)
        return node


def _arrays(batch: pa.RecordBatch, features: int) -> tuple[np.ndarray, ...]:
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, features).astype(np.int64)
    return batch.column("key").to_numpy(), x, batch.column("y").to_numpy().astype(float), batch.column("train").to_numpy(zero_copy_only=False)


def _pieces(batches: Iterator[pa.RecordBatch], fam: Family) -> Iterator[tuple[np.ndarray, ...]]:
    step = max(1, CELLS // len(fam.number))
    for batch in batches:
        for a in range(0, batch.num_rows, step):
            yield _arrays(batch.slice(a, step), fam.features)


def _histograms(fam: Family, level: int):
    """For mapInArrow: counts and sums of the training rows per (tree, node of the level, feature, bin)."""
    nodes, width = 1 << level, fam.features * fam.bins

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = (np.zeros(len(fam.number) * nodes * width) for _ in range(2))
        for key, x, y, train in _pieces(batches, fam):
            key, x, y = key[train], x[train], y[train]
            node = fam.descend(x, level)
            w = np.where(node >= nodes, fam.weights(key), 0)
            row, tree = np.nonzero(w)
            at = (tree * nodes + node[row, tree] - nodes) * width
            weight = w[row, tree].astype(float)
            for f in range(fam.features):
                place = at + f * fam.bins + x[row, f]
                n += np.bincount(place, weight, len(n))
                s += np.bincount(place, weight * y[row], len(s))
        i = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (i // (nodes * width), i // width % nodes + nodes, i // fam.bins % fam.features, i % fam.bins, n[i], s[i])],
                                         names=["tree", "node", "f", "bin", "n", "s"])
    return run


def grow(rows: DataFrame, fam: Family) -> Family:
    """Fills the family's trees, one pass over ``rows`` a level."""
    for level in range(fam.depth):
        cells = rows.select("key", "x", "y", "train").mapInArrow(_histograms(fam, level), "tree long, node long, f long, bin long, n double, s double")
        cells = cells.groupBy("tree", "node", "f", "bin").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        whole = Window.partitionBy("tree", "node", "f")
        upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        c = cells.select("tree", "node", "f", "bin", F.sum("n").over(upto).alias("ln"), F.sum("s").over(upto).alias("ls"), F.sum("n").over(whole).alias("n"), F.sum("s").over(whole).alias("s"))
        rn, rs = F.col("n") - F.col("ln"), F.col("s") - F.col("ls")
        gain = F.col("ls") * F.col("ls") / F.col("ln") + F.when(rn > 0, rs * rs / F.greatest(rn, F.lit(1.0))).otherwise(0.0) - F.col("s") * F.col("s") / F.col("n")
        best = c.withColumn("gain", F.when(rn > 0, gain).otherwise(F.lit(float("-inf"))))
        # per feature the best cut; which features a node tries is the family's matter
        best = best.groupBy("tree", "node", "f").agg(F.max_by(F.struct("bin", "gain", "ln", "ls", "n", "s"), F.struct("gain", -F.col("bin"))).alias("b")).select("tree", "node", "f", "b.*")
        got = best.toPandas()  # trees x nodes x features rows
        if not len(got):
            break
        tree, node, f = (got[k].to_numpy().astype(int) for k in ("tree", "node", "f"))
        fam.count[tree, node], fam.sum[tree, node] = got["n"], got["s"]
        got = got[fam.tried(tree, node)[np.arange(len(got)), f] & (got["gain"] > 0)].sort_values(["gain", "f"], ascending=[False, True]).drop_duplicates(["tree", "node"])
        tree, node = got["tree"].to_numpy().astype(int), got["node"].to_numpy().astype(int)
        fam.feature[tree, node], fam.cut[tree, node], fam.gain[tree, node] = got["f"], got["bin"], got["gain"]
        fam.count[tree, 2 * node], fam.sum[tree, 2 * node] = got["ln"], got["ls"]
        fam.count[tree, 2 * node + 1], fam.sum[tree, 2 * node + 1] = got["n"] - got["ln"], got["s"] - got["ls"]
    return fam


def scores(rows: DataFrame, fam: Family, settings: Sequence[tuple[str, Sequence[int], int]]) -> DataFrame:
    """R^2 on training and test rows of each setting (model, trees by place in the family, depth): one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(settings), 2, 4))  # rows, label, label^2, error^2
        value = np.divide(fam.sum, fam.count, out=np.zeros_like(fam.sum), where=fam.count > 0)
        for _, x, y, train in _pieces(batches, fam):
            leaf = {d: value[np.arange(len(fam.number))[None], fam.descend(x, d)] for d in {d for *_, d in settings}}
            for i, (_, trees, depth) in enumerate(settings):
                error = (y - leaf[depth][:, list(trees)].mean(1)) / UNIT
                for j, part in enumerate((train, ~train)):
                    v = y[part] / UNIT
                    sums[i, j] += len(v), v.sum(), (v * v).sum(), (error[part] ** 2).sum()
        flat = sums.reshape(-1, 4)
        yield pa.RecordBatch.from_arrays([pa.array([m for m, *_ in settings for _ in range(2)]), pa.array([True, False] * len(settings))]
                                         + [pa.array(flat[:, c].copy()) for c in range(4)], names=["model", "train", "n", "y", "yy", "ee"])

    t = rows.select("key", "x", "y", "train").mapInArrow(run, "model string, train boolean, n double, y double, yy double, ee double")
    t = t.groupBy("model", "train").agg(*[F.sum(c).alias(c) for c in ("n", "y", "yy", "ee")])
    spread = F.col("yy") - F.col("y") * F.try_divide("y", "n")
    r2 = F.lit(1.0) - F.try_divide(F.col("ee"), F.when(spread > 0, spread))
    return t.groupBy("model").agg(F.max(F.when(F.col("train"), r2)).alias("r2_train"), F.max(F.when(~F.col("train"), r2)).alias("r2_test"))


def tree_and_forest_grid(df: DataFrame, cols: Sequence[str], label: str, key: str, train_col: str = "is_train", depths: Sequence[int] = (3, 5, 10),
                         trees: Sequence[int] = (50, 100, 200), forest_depths: Sequence[int] = (3, 4, 5), max_features: Sequence[int] = (2, 4, 8)) -> DataFrame:
    """ML-5: decision trees by depth and random forests by trees x depth x features tried at a split (at most all of them):
    R^2 on training and test rows, and which forest has the best test score (the first of the grid among equals)."""
    rows = binned(df, cols, label, key, train_col)
    single = grow(rows, Family([(0, len(cols), False)], max(depths), len(cols)))
    out = scores(rows, single, [(f"DT_d{d}", [0], d) for d in depths])
    most = max(trees)
    forest = grow(rows, Family([(t, min(m, len(cols)), True) for m in max_features for t in range(most)], max(forest_depths), len(cols)))
    grid = [(f"RF_n{n}_d{d}_f{m}", [i * most + t for t in range(n)], d) for n in trees for d in forest_depths for i, m in enumerate(max_features)]
    rows_ = [tuple(r) for r in out.unionByName(scores(rows, forest, grid)).collect()]  # one row per setting
    place = {g[0]: i for i, g in enumerate(grid)}
    best = max((r for r in rows_ if r[0] in place and r[2] is not None), key=lambda r: (r[2], -place[r[0]]), default=(None,))[0]
    return df.sparkSession.createDataFrame([(*r, r[0] == best) for r in rows_], "model string, r2_train double, r2_test double, best_forest boolean")


def importances(df: DataFrame, cols: Sequence[str], label: str, key: str, train_col: str = "is_train", trees: int = 200, depth: int = 3, max_features: int = 4) -> DataFrame:
    """TOP-4: a forest's feature importances: each feature's share of the gain of all splits, sorted."""
    rows = binned(df, cols, label, key, train_col)
    fam = grow(rows, Family([(t, min(max_features, len(cols)), True) for t in range(trees)], depth, len(cols)))
    total = [float(fam.gain[fam.feature == i].sum()) for i in range(len(cols))]
    whole = sum(total)
    return df.sparkSession.createDataFrame([(c, t / whole if whole else None) for c, t in zip(cols, total)], "feature string, importance double").orderBy(F.desc("importance"))


def boosted(df: DataFrame, cols: Sequence[str], label: str, key: str, train_col: str = "is_train", rounds: int = 20, depth: int = 3, rate: float = 0.1) -> DataFrame:
    """ML-5: gradient-boosted trees for squared error: each round's tree fits what the ones before left over; R^2 on training
    and test rows after every round. Steps are whole units of 1e-6, so the left-over labels stay exact."""
    rows = binned(df, cols, label, key, train_col)
    total = rows.filter("train").agg(F.sum("y"), F.count("y")).first()
    start = int(np.floor((total[0] or 0) / max(total[1], 1) + 0.5))
    models: list[Family] = []

    def left(rounds: Sequence[int]):
        """Labels left over after each of ``rounds``."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                key_, x, y, train = _arrays(batch, len(cols))
                gone = np.full(len(y), float(start))
                for i in range(max(rounds) + 1):
                    if i:
                        m = models[i - 1]
                        value = np.floor(rate * np.divide(m.sum, m.count, out=np.zeros_like(m.sum), where=m.count > 0) + 0.5)
                        gone = gone + value[0, m.descend(x, depth)[:, 0]]
                    if i in rounds:
                        yield pa.RecordBatch.from_arrays([pa.array(key_), batch.column("x"), pa.array((y - gone).astype(np.int64)), pa.array(y.astype(np.int64)), pa.array(train),
                                                          pa.array(np.full(len(y), i), pa.int32())], names=["key", "x", "y", "label", "train", "round"])
        return run

    schema = "key long, x array<int>, y long, label long, train boolean, round int"
    for i in range(rounds):
        models.append(grow(rows.mapInArrow(left([i]), schema), Family([(0, len(cols), False)], depth, len(cols))))
    t = rows.mapInArrow(left(range(rounds + 1)), schema)
    error = F.pow(F.col("y") / UNIT, 2)
    y = F.col("label") / UNIT

    def r2(part):
        return F.lit(1.0) - F.try_divide(F.avg(F.when(part, error)), F.when(F.var_pop(F.when(part, y)) > 0, F.var_pop(F.when(part, y))))

    return t.groupBy("round").agg(r2(F.col("train")).alias("r2_train"), r2(~F.col("train")).alias("r2_test"))
