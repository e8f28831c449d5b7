"""Risk and risk-adjusted return metrics per group (RSK-1..25).

Moments are single-pass aggregates. Value at risk needs an exact order statistic; it is computed
without sorting a whole group in one task: ties collapse in a partial ``groupBy(value)``,
approximate splitters (a mergeable sketch) cut each group into buckets, bucket totals locate the
rank, the search narrows to that bucket until few values are left, and only those are ordered. Drawdowns use the running peak (one pass) and
exact lag-tau minima over lags made in one halo stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.functions.scalar import div
from candela.operators.features import ensure_indexed, rolling
from candela.operators.series import BLK, RN, at_pos, running
from candela.session import SPLITS_KEY, materialize, setting

EPS = 1e-15


def moments(df: DataFrame, r: str = "r", m: str | None = "m", threshold: float = 0.0,
            keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """RSK-1..4 and the inputs of the ratios: n, mean, vol (population std), beta as coded
    (sample covariance / population std of the market, Q3) and the standard beta, LPM/HPM of order
    1..3 at ``threshold``."""
    x = F.col(r)
    lo = F.greatest(F.lit(threshold) - x, F.lit(0.0))
    hi = F.greatest(x - F.lit(threshold), F.lit(0.0))
    n = F.count(x)
    aggs = [n.alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("vol"),
            (F.sum(lo) / n).alias("lpm1"), (F.sum(lo * lo) / n).alias("lpm2"), (F.sum(F.pow(lo, 3)) / n).alias("lpm3"),
            (F.sum(hi) / n).alias("hpm1"), (F.sum(hi * hi) / n).alias("hpm2"), (F.sum(F.pow(hi, 3)) / n).alias("hpm3")]
    if m:
        y = F.col(m)
        aggs += [div(F.covar_samp(x, y), F.stddev_pop(y)).alias("beta"),
                 div(F.covar_samp(x, y), F.var_samp(y)).alias("beta_standard"),
                 F.avg(x - y).alias("_dmean"), F.stddev_pop(x - y).alias("_dvol"),
                 F.stddev_pop(y).alias("_mvol")]
    return df.filter(x.isNotNull()).groupBy(*keys).agg(*aggs)


MAX_ORDERED = 1 << 16


def kth_smallest(df: DataFrame, value: str, k: DataFrame, keys: Sequence[str] = ("symbol",), max_ordered: int = MAX_ORDERED) -> DataFrame:
    """Exact k-th smallest value (1-based, ``k`` table: keys + ``k``) and the sum of the k smallest,
    per key, without sorting a key in one task. Output: keys, k, kth, sum_k.

    Ties collapse first (a partial ``groupBy(value)``). While any key has more than ``max_ordered``
    distinct values left, a level cuts every key's values into ``spark.candela.rankSplits`` buckets with
    approximate splitters (a mergeable sketch), counts and sums the buckets, keeps the bucket that holds
    the rank and moves the rank into it. The few values left are ordered to read off the exact value.
    The bound decides how many levels run, never the answer; one number per level comes to the driver."""
    keys = list(keys)
    splits = max(2, setting(df.sparkSession, SPLITS_KEY, 64))
    qs = [i / splits for i in range(1, splits)]
    v = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_cnt"))
    v = materialize(v)
    state = k.select(*keys, F.col("k").alias("_k"), F.col("k"), F.lit(0.0).alias("_acc"))
    left = v.groupBy(*keys).agg(F.count(F.lit(1)).alias("_d")).agg(F.max("_d")).first()[0] or 0
    while left > max_ordered:
        cuts = v.groupBy(*keys).agg(F.percentile_approx("_v", qs, 10000).alias("_cuts"))
        vb = v.join(cuts, keys).withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts")
        vb = materialize(vb)
        buckets = vb.groupBy(*keys, "_b").agg(F.sum("_cnt").alias("_bc"), F.sum(F.col("_v") * F.col("_cnt")).alias("_bs"),
                                              F.count(F.lit(1)).alias("_d"))
        wb = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        buckets = (buckets.withColumn("_before", F.coalesce(F.sum("_bc").over(wb), F.lit(0)))
                   .withColumn("_before_sum", F.coalesce(F.sum("_bs").over(wb), F.lit(0.0))))
        target = (buckets.join(state, keys)
                  .filter((F.col("_before") < F.col("_k")) & (F.col("_k") <= F.col("_before") + F.col("_bc"))))
        target = materialize(target)
        state = target.select(*keys, (F.col("_k") - F.col("_before")).alias("_k"), "k",
                              (F.col("_acc") + F.col("_before_sum")).alias("_acc"))
        v = vb.join(target.select(*keys, "_b"), [*keys, "_b"]).select(*keys, "_v", "_cnt")
        now = target.agg(F.max("_d")).first()[0] or 0
        if now >= left:
            break  # the sketch cannot part values this close; the ordering below is still exact
        left = now
    inside = v.join(state, keys)
    wv = Window.partitionBy(*keys).orderBy("_v")
    inside = (inside.withColumn("_cum", F.sum("_cnt").over(wv.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("_cum_prev", F.col("_cum") - F.col("_cnt"))
              .withColumn("_csum", F.sum(F.col("_v") * F.col("_cnt")).over(wv.rowsBetween(Window.unboundedPreceding, -1))))
    hit = inside.filter((F.col("_cum_prev") < F.col("_k")) & (F.col("_k") <= F.col("_cum")))
    return hit.select(*keys, "k", F.col("_v").alias("kth"),
                      (F.col("_acc") + F.coalesce(F.col("_csum"), F.lit(0.0))
                       + (F.col("_k") - F.col("_cum_prev")) * F.col("_v")).alias("sum_k"))


def order_statistics(df: DataFrame, value: str, ranks: DataFrame, keys: Sequence[str] = ("symbol",), rank: str = "rank",
                     max_ordered: int = MAX_ORDERED) -> DataFrame:
    """Exact values at many ranks per key: ``ranks`` is (keys, ``rank`` an id, ``k`` 1-based); output (keys, ``rank``, k, kth).

    As ``kth_smallest``, with one table of distinct values for all ranks of a key: a level cuts the values of every node
    (a bucket of the level before) by a mergeable sketch, each rank moves on to the bucket that holds it, and
    only buckets that hold a rank are cut again. Values are never copied per rank."""
    keys = list(keys)
    splits = max(2, setting(df.sparkSession, SPLITS_KEY, 64))
    v = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_cnt"))
    v = materialize(v.withColumn("_node", F.lit("")))
    state = ranks.select(*keys, rank, "k", F.col("k").alias("_k"), F.lit("").alias("_node"))
    left = v.groupBy(*keys).agg(F.count(F.lit(1)).alias("_d")).agg(F.max("_d")).first()[0] or 0
    while left > max_ordered:
        cuts = v.groupBy(*keys, "_node").agg(F.percentile_approx("_v", [i / splits for i in range(1, splits)], 10000).alias("_cuts"))
        vb = materialize(v.join(cuts, [*keys, "_node"]).withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts"))
        buckets = vb.groupBy(*keys, "_node", "_b").agg(F.sum("_cnt").alias("_bc"), F.count(F.lit(1)).alias("_d"))
        before = F.sum("_bc").over(Window.partitionBy(*keys, "_node").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
        buckets = buckets.withColumn("_before", F.coalesce(before, F.lit(0)))
        child = F.concat_ws(".", "_node", F.col("_b").cast("string"))
        target = materialize(buckets.join(state, [*keys, "_node"]).filter((F.col("_before") < F.col("_k")) & (F.col("_k") <= F.col("_before") + F.col("_bc"))))
        state = target.select(*keys, rank, "k", (F.col("_k") - F.col("_before")).alias("_k"), child.alias("_node"))
        v = vb.join(target.select(*keys, "_node", "_b").distinct(), [*keys, "_node", "_b"]).select(*keys, "_v", "_cnt", child.alias("_node"))
        now = target.agg(F.max("_d")).first()[0] or 0
        if now >= left:
            break  # the sketch cannot part values this close; the ordering below is still exact
        left = now
    upto = F.sum("_cnt").over(Window.partitionBy(*keys, "_node").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    inside = v.withColumn("_cum", upto).join(state, [*keys, "_node"])
    return inside.filter((F.col("_cum") - F.col("_cnt") < F.col("_k")) & (F.col("_k") <= F.col("_cum"))).select(*keys, rank, "k", F.col("_v").alias("kth"))


def equal_frequency_edges(df: DataFrame, features: Sequence[str], bins: int, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Per key and feature the inner edges of ``bins`` equal-frequency bins as a sorted array: the exact values at ranks
    floor(i / bins * (n - 1)) + 1, i = 1 .. bins - 1. Output: keys, feature, edges."""
    keys = list(keys)
    stacked = df.select(*keys, F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").cast("double").alias("v")) for f in features])).alias("_x"))
    stacked = stacked.select(*keys, "_x.*").filter(F.col("v").isNotNull())
    n = stacked.groupBy(*keys, "feature").agg(F.count(F.lit(1)).alias("_n"))
    ks = n.withColumn("edge", F.explode(F.sequence(F.lit(1), F.lit(bins - 1)))).select(
        *keys, "feature", "edge", (F.floor(F.col("edge") / F.lit(bins) * (F.col("_n") - 1)) + 1).cast("long").alias("k"))
    found = order_statistics(stacked, "v", ks, [*keys, "feature"], "edge")
    return found.groupBy(*keys, "feature").agg(F.sort_array(F.collect_list("kth")).alias("edges"))


def var_cvar(df: DataFrame, r: str = "r", alpha: float = 0.05, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """RSK-5/6: VaR = |sorted[int(alpha*n)]|, CVaR = |mean of the int(alpha*n) smallest| (NULL when
    int(alpha*n) = 0, Q12)."""
    d = df.filter(F.col(r).isNotNull())
    k = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "k", (F.floor(F.col("_n") * F.lit(alpha)) + 1).cast("long"))
    ks = kth_smallest(d, r, k.select(*keys, "k"), keys)
    return ks.select(*keys, F.abs("kth").alias("var"),
                     F.when(F.col("k") > 1, F.abs((F.col("sum_k") - F.col("kth")) / (F.col("k") - 1))).alias("cvar"))


def price_path(df: DataFrame, r: str = "r", base: float = 100.0, compound: bool = False) -> DataFrame:
    """RSK-7: returns -> values. As coded, base*(1+r_i) (not compounded, Q9); ``compound`` gives
    base*prod(1+r). The base row sits at position 0, return i at position i+1."""
    d = ensure_indexed(df)
    if compound:
        d = running(d, [(F.lit(1.0) + F.col(r), "product", "_g")]).withColumn("value", F.lit(base) * F.col("_g")).drop("_g")
    else:
        d = d.withColumn("value", F.lit(base) * (F.lit(1.0) + F.col(r)))
    return d


def drawdown_at(values: DataFrame, taus: Sequence[int], keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """RSK-8: dd(tau) = |min over t of v_t / v_{t-tau} - 1| for each tau (v includes the base value
    100 before the first return; pairs after a value of zero have no ratio; a lag no pair has is left out). One halo
    stage brings every lag, one aggregate takes the minima."""
    keys, taus = list(keys), [int(t) for t in taus]
    v = ensure_indexed(values, keys)

    def before(t: int):
        return lambda w: F.when(at_pos(w, t - 1), F.lit(100.0)).otherwise(F.lag("value", t).over(w)) if t else F.col("value")

    x = rolling(v.select(*keys, RN, BLK, "value"), {f"_l{t}": before(t) for t in taus}, back=max(taus) + 1, keys=keys)
    g = x.groupBy(*keys).agg(*[F.struct(F.lit(t).alias("tau"), F.abs(F.min(div("value", f"_l{t}") - 1)).alias("dd"), F.count(f"_l{t}").alias("n")).alias(f"_d{t}") for t in taus])
    return g.select(*keys, F.explode(F.array(*[F.col(f"_d{t}") for t in taus])).alias("_d")).select(*keys, "_d.*").filter("n > 0").drop("n")


def max_drawdown(values: DataFrame, keys: Sequence[str] = ("symbol",), base: float = 100.0) -> DataFrame:
    """RSK-9: largest fall from a running peak (the path starts at ``base``),
    1 - min(v / running max v) (one block scan).
    (The reference's all-lag loop additionally reports a positive minimum ratio at long lags, Q10;
    that form needs every pair of bars and is not offered.)"""
    d = running(ensure_indexed(values), [("value", "max", "_peak")], keys)
    peak = F.greatest(F.col("_peak"), F.lit(base))
    return d.groupBy(*keys).agg(F.greatest(1 - F.min(F.col("value") / peak), F.lit(0.0)).alias("max_dd"))


def average_drawdown(values: DataFrame, periods: int = 5, keys: Sequence[str] = ("symbol",), base: float = 100.0) -> DataFrame:
    """RSK-10/11: ``avg_dd`` and ``avg_dd_sq``, the sums of the ``periods`` deepest drawdowns and of their squares
    over ``periods``. A drawdown is one episode below the running peak: it opens when the value leaves a peak (the
    path starts at ``base``), ends at the next higher peak, and its depth is 1 - lowest value / peak. One block scan,
    one aggregate per episode, then a top-k; groups without an episode have no row.
    (The reference averages minimum ratios over all pairs of bars, Q10 and Q11; that form is quadratic and not offered.)"""
    keys = list(keys)
    d = running(ensure_indexed(values), [("value", "max", "_peak")], keys)
    d = d.withColumn("_peak", F.greatest(F.col("_peak"), F.lit(base)))
    depth = 1 - F.min("value") / F.col("_peak")
    episodes = d.groupBy(*keys, "_peak").agg(depth.alias("_x")).filter(F.col("_x") > 0)
    w = Window.partitionBy(*keys).orderBy(F.col("_x").desc(), "_peak")
    deepest = episodes.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= periods)
    return deepest.groupBy(*keys).agg((F.sum("_x") / F.lit(float(periods))).alias("avg_dd"),
                                      (F.sum(F.col("_x") * F.col("_x")) / F.lit(float(periods))).alias("avg_dd_sq"))


def risk_table(df: DataFrame, r: str = "r", m: str = "m", rf: float = 0.06, alpha: float = 0.05, periods: int = 5,
               keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """RSK-12..25: every ratio of the metric set, with er = mean return (as in the reference's test)."""
    keys = list(keys)
    mo = moments(df, r, m, 0.0, keys)
    vc = var_cvar(df, r, alpha, keys)
    vals = price_path(df.filter(F.col(r).isNotNull()), r)
    mdd = max_drawdown(vals, keys)
    t = mo.join(vc, keys, "left").join(mdd, keys, "left").join(average_drawdown(vals, periods, keys), keys, "left")
    ex = F.col("mean") - F.lit(rf)
    return (t.withColumn("treynor", div(ex, F.col("beta")))
            .withColumn("sharpe", ex / (F.col("vol") + F.lit(EPS)))
            .withColumn("information", div(F.col("_dmean"), F.col("_dvol")))
            .withColumn("modigliani", ex * div(F.col("vol"), F.col("_mvol")) + F.lit(rf))
            .withColumn("excess_var", div(ex, F.col("var")))
            .withColumn("conditional_sharpe", div(ex, F.col("cvar")))
            .withColumn("omega", div(ex, F.col("lpm1")))
            .withColumn("sortino", ex / (F.sqrt("lpm2") + F.lit(EPS)))
            .withColumn("kappa3", div(ex, F.pow(F.col("lpm3"), F.lit(1.0 / 3.0))))
            .withColumn("gain_loss", div(F.col("hpm1"), F.col("lpm1")))
            .withColumn("upside_potential", div(F.col("hpm1"), F.sqrt("lpm2")))
            .withColumn("calmar", div(ex, F.col("max_dd")))
            .withColumn("sterling", div(ex, F.col("avg_dd")))
            .withColumn("burke", div(ex, F.sqrt("avg_dd_sq")))
            .drop("_dmean", "_dvol", "_mvol"))


def with_market(returns: DataFrame, r: str = "r") -> DataFrame:
    """Attach the equal-weight market return per bar (average of all symbols' returns at that bar)."""
    mkt = returns.filter(F.col(r).isNotNull()).groupBy("bar_ts").agg(F.avg(r).alias("m"))
    return returns.join(mkt, "bar_ts", "left")


def bar_returns(bars: DataFrame) -> DataFrame:
    """Returns fixture: r = DR - 1 per bar (first bar dropped)."""
    d = rolling(ensure_indexed(bars), {"r": lambda w: div(F.col("close"), F.lag("close", 1).over(w)) - 1}, back=1)
    return d.filter(F.col("r").isNotNull())
