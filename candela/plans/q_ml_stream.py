"""Registered queries for §2.12 (ML) and §2.13 (STR)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from candela.config import PRESETS
from candela.functions.scalar import half_up
from candela.operators import features as FE
from candela.operators import knn as KNN
from candela.operators import ml as ML
from candela.plans import sqlparts as S
from candela.plans.catalog import HOURLY, register, rounded, rsql
from candela.session import ensure_checkpoint_dir
from candela.sources.fixtures import BARS_HOURLY_SQL, bars_hourly
from candela.streaming import bars as ST

W = "WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts)"
K = ["symbol", "bar_ts"]
ROC = PRESETS["eth_usd_roc"]
CUT = "2024-01-20"
_FEATS = ["MA", "STD", "VOL", "WR"]


def _feat_sql():
    return HOURLY + f""",
t AS (SELECT symbol, bar_ts, close / nullif(lag(close) OVER w, 0) AS DR, close / nullif({S.full_avg('close', 50)}, 0) AS MA,
             {S.full_agg('stddev_samp', 'close', 7)} / nullif(close, 0) AS STD, volume / nullif({S.full_avg('volume', 30)}, 0) AS VOL,
             CASE WHEN {S.full_agg('max', 'high', 7)} IS NULL OR {S.full_agg('min', 'low', 7)} IS NULL THEN NULL
                  WHEN {S.full_agg('max', 'high', 7)} = {S.full_agg('min', 'low', 7)} THEN 0.0
                  ELSE -100.0 * ({S.full_agg('max', 'high', 7)} - close) / ({S.full_agg('max', 'high', 7)} - {S.full_agg('min', 'low', 7)}) END AS WR
      FROM bars {W}),
f AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) - 1 AS p, count(*) OVER (PARTITION BY symbol) AS n
      FROM t WHERE MA IS NOT NULL AND STD IS NOT NULL AND VOL IS NOT NULL AND WR IS NOT NULL AND DR IS NOT NULL),
g AS (SELECT *, p < floor(n * 0.8) AS is_train FROM f)"""


def _features(spark, sf):
    d = FE.drop_warmup(FE.base_features(bars_hourly(spark, sf)), [*_FEATS, "DR"])
    return FE.chrono_split(d, 0.8, 0.2)


@register("ml01_standard_scale", _feat_sql() + """,
st AS (SELECT symbol, """ + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _FEATS) + """ FROM g WHERE is_train GROUP BY symbol),
z AS (SELECT g.symbol, g.bar_ts, """ + ", ".join(f"({c} - m_{c}) / nullif(s_{c}, 0) AS {c}_z" for c in _FEATS) + """ FROM g JOIN st USING (symbol))
""" + rsql(K + [f"{c}_z" for c in _FEATS], [f"{c}_z" for c in _FEATS], "z"))
def q_ml01(spark, sf):
    return rounded(ML.standard_scale(_features(spark, sf), _FEATS).select(*K, *[f"{c}_z" for c in _FEATS]))


@register("ml02_minmax_scale", _feat_sql() + """,
st AS (SELECT symbol, min(DR) AS lo, max(DR) AS hi FROM g WHERE is_train GROUP BY symbol),
z AS (SELECT g.symbol, g.bar_ts, (DR - lo) / nullif(hi - lo, 0) AS DR_mm, (DR - lo) / nullif(hi - lo, 0) * (hi - lo) + lo AS DR_inv
      FROM g JOIN st USING (symbol))
""" + rsql(K + ["DR_mm", "DR_inv"], ["DR_mm", "DR_inv"], "z"))
def q_ml02(spark, sf):
    return rounded(ML.minmax_scale(_features(spark, sf), "DR").select(*K, "DR_mm", "DR_inv"))


def _lagged(spark, sf):
    d = FE.lagged_return_frame(bars_hourly(spark, sf), 5)
    return FE.date_split(d, CUT).withColumn("up", (F.col("Direction") > 0).cast("int"))


_LAGGED = ", ".join(f"100.0 * (lag(close, {i}) OVER w / nullif(lag(close, {i + 1}) OVER w, 0) - 1) AS Lag{i}" for i in range(1, 6))
LAG_SQL = HOURLY + f""",
t AS (SELECT symbol, bar_ts, 100.0 * (close / nullif(lag(close) OVER w, 0) - 1) AS Today0, {_LAGGED} FROM bars {W}),
u AS (SELECT *, CASE WHEN abs(Today0) < 0.0001 THEN 0.0001 ELSE Today0 END AS Today FROM t
      WHERE Today0 IS NOT NULL AND Lag1 IS NOT NULL AND Lag2 IS NOT NULL AND Lag3 IS NOT NULL AND Lag4 IS NOT NULL AND Lag5 IS NOT NULL),
v AS (SELECT *, CAST(sign(Today) AS DOUBLE) AS Direction, bar_ts < TIMESTAMP '{CUT}' AS is_train FROM u)"""


@register("ml03_06_classifier_bakeoff", None)
def q_ml03(spark, sf):
    """ML-3/ML-6 (rows check): seven MLlib classifiers on five lagged returns, up/down label."""
    return rounded(ML.classifier_bakeoff(_lagged(spark, sf), ["Lag1", "Lag2", "Lag3", "Lag4", "Lag5"], "up"))


@register("ml03_logistic_optimum", LAG_SQL + """,
o AS (SELECT count(*) AS n, CAST(sum(CAST(Direction > 0 AS INT)) AS BIGINT) AS n_up FROM v WHERE is_train)
SELECT n, n_up, CAST(n_up AS DOUBLE) AS expected_up, 0.0::DOUBLE AS steepest FROM o""")
def q_ml03_optimum(spark, sf):
    """ML-3: logistic regression of rises on five lags is at the maximum of its likelihood (to 2 and 3 decimals)."""
    d = ML.logistic_facts(_lagged(spark, sf), ["Lag1", "Lag2", "Lag3", "Lag4", "Lag5"], "up")
    return d.withColumns({"expected_up": F.round("expected_up", 2), "steepest": F.round("steepest", 3)})


@register("ml04_linear_regression", LAG_SQL + """,
r AS (SELECT regr_slope(Today, Lag1) AS b, regr_intercept(Today, Lag1) AS a FROM v WHERE is_train)
SELECT 'Lag1' AS term, round(b, 6) AS value FROM r UNION ALL SELECT 'intercept' AS term, round(a, 6) AS value FROM r""")
def q_ml04(spark, sf):
    return rounded(ML.linear_regression(_lagged(spark, sf), ["Lag1"], "Today"))


_OLS2 = LAG_SQL + """,
o1 AS (SELECT count(*) AS n, avg(Today) AS my, avg(Lag1) AS m1, avg(Lag2) AS m2, var_pop(Lag1) AS s11, var_pop(Lag2) AS s22,
              covar_pop(Lag1, Lag2) AS s12, covar_pop(Today, Lag1) AS s1y, covar_pop(Today, Lag2) AS s2y FROM v WHERE is_train),
o2 AS (SELECT *, s11 * s22 - s12 * s12 AS det FROM o1),
o3 AS (SELECT *, (s1y * s22 - s2y * s12) / det AS b1, (s2y * s11 - s1y * s12) / det AS b2 FROM o2),
ols AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0 FROM o3),
pr AS (SELECT v.symbol, v.bar_ts, v.is_train, v.Today, b0 + b1 * Lag1 + b2 * Lag2 AS pred FROM v, ols)"""


# the two-sided p value is the tail of Student's density, by Simpson's rule over atan(t / sqrt(df))
@register("ml04_regression_terms", _OLS2 + """,
sg AS (SELECT sum(pow(Today - pred, 2)) / (count(*) - 3) AS s2 FROM pr WHERE is_train),
tm AS (SELECT 'Lag1' AS term, b1 AS value, sqrt(s2 / n * s22 / det) AS std_error, n - 3 AS df FROM ols, sg
       UNION ALL SELECT 'Lag2', b2, sqrt(s2 / n * s11 / det), n - 3 FROM ols, sg
       UNION ALL SELECT 'intercept', b0, sqrt(s2 / n * (1 + (m1 * m1 * s22 - 2 * m1 * m2 * s12 + m2 * m2 * s11) / det)), n - 3 FROM ols, sg),
tv AS (SELECT *, value / std_error AS t_value, atan(abs(value / std_error) / sqrt(df)) AS lo FROM tm),
sm AS (SELECT term, sum((CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * pow(greatest(cos(lo + i * (pi() / 2 - lo) / 20000), 0), df - 1))
              * (pi() / 2 - lo) / 60000 AS area FROM tv, range(0, 20001) t(i) GROUP BY term, lo),
tp AS (SELECT tv.*, 2 * exp(lgamma((df + 1) / 2.0) - lgamma(df / 2.0)) / sqrt(pi()) * area AS p_value FROM tv JOIN sm USING (term))
""" + rsql(["term", "value", "std_error", "t_value", "p_value"], ["value", "std_error", "t_value", "p_value"], "tp"))
def q_ml04_terms(spark, sf):
    """ML-4: today's return on two lags: coefficients, standard errors, t and p values."""
    return rounded(ML.linear_terms(_lagged(spark, sf), ["Lag1", "Lag2"], "Today"))


def _fitted(spark, sf):
    return ML.linear_predict(_lagged(spark, sf), ["Lag1", "Lag2"], "Today")


@register("ml04_regression_predictions", _OLS2 + "\n" + rsql(K + ["is_train", "pred"], ["pred"], "pr"))
def q_ml04_pred(spark, sf):
    """ML-4: fitted values of the training rows, predictions of the test rows."""
    return rounded(_fitted(spark, sf).select(*K, "is_train", "pred"))


@register("ml04_regression_fit", _OLS2 + """,
fi AS (SELECT is_train, count(*) AS n, sqrt(avg(pow(Today - pred, 2))) AS rmse, 1 - avg(pow(Today - pred, 2)) / nullif(var_pop(Today), 0) AS r2
       FROM pr GROUP BY is_train)
""" + rsql(["is_train", "n", "rmse", "r2"], ["rmse", "r2"], "fi"))
def q_ml04_fit(spark, sf):
    """ML-4: root mean squared error and R^2 on training and test rows."""
    return rounded(ML.regression_fit(_fitted(spark, sf), "Today"))


@register("ml03_naive_bayes", LAG_SQL + """,
nb AS (SELECT CAST(Direction > 0 AS INT) AS up, * FROM v),
nc AS (SELECT up AS k, ln(count(*) / (SELECT count(*) FROM nb WHERE is_train)) AS lp, avg(Lag1) AS m1, var_pop(Lag1) AS v1, avg(Lag2) AS m2, var_pop(Lag2) AS v2
       FROM nb WHERE is_train GROUP BY up),
ns AS (SELECT symbol, bar_ts, up, k, lp - 0.5 * (ln(v1) + pow(Lag1 - m1, 2) / v1 + ln(v2) + pow(Lag2 - m2, 2) / v2) AS score FROM nb, nc WHERE NOT is_train),
np AS (SELECT symbol, bar_ts, up, arg_max(k, (score, -k)) AS pred FROM ns GROUP BY 1, 2, 3)
SELECT symbol, count(*) AS n_test, CAST(sum(pred) AS BIGINT) AS n_up_predicted, CAST(sum(CAST(pred = up AS INT)) AS BIGINT) AS n_correct FROM np GROUP BY symbol""")
def q_ml03_nb(spark, sf):
    """ML-3: Gaussian naive Bayes of up / down on two lagged returns: test rows, predicted rises, hits."""
    d = ML.naive_bayes(_lagged(spark, sf), ["Lag1", "Lag2"], "up")
    return d.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_test"), F.sum(F.col("prediction").cast("bigint")).alias("n_up_predicted"),
                                   F.sum((F.col("prediction") == F.col("up")).cast("bigint")).alias("n_correct"))


def _knn_sql() -> str:
    z = ", ".join(f"round((g.{c} - m_{c}) / nullif(s_{c}, 0), 9) AS {c}_z" for c in _FEATS)
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _FEATS)
    d2 = " + ".join(f"(q.{c}_z - t.{c}_z) * (q.{c}_z - t.{c}_z)" for c in _FEATS)
    return _feat_sql() + f""",
st AS (SELECT symbol, {stats} FROM g WHERE is_train GROUP BY symbol),
z AS (SELECT g.symbol, g.bar_ts, is_train, lead(DR) OVER (PARTITION BY g.symbol ORDER BY g.bar_ts) AS y, {z} FROM g JOIN st USING (symbol)),
pt AS (SELECT * FROM z WHERE y IS NOT NULL),
near AS (SELECT q.symbol, q.bar_ts, q.is_train, q.y, t.y AS ty, row_number() OVER (PARTITION BY q.symbol, q.bar_ts ORDER BY {d2}, t.bar_ts) AS r
         FROM pt q JOIN pt t ON q.symbol = t.symbol AND t.is_train),
pk AS (SELECT symbol, bar_ts, is_train, any_value(y) AS y, k, sum(ty) / k AS pred FROM near, range(2, 13) u(k) WHERE r <= k GROUP BY symbol, bar_ts, is_train, k)"""


KNN_SQL = _knn_sql()


def _knn_rows(spark, sf):
    """Scaled features (9 decimals, so that both engines rank neighbours alike) and the next bar's return."""
    d = ML.standard_scale(_features(spark, sf), _FEATS)
    d = FE.next_bar_target(d.withColumns({f"{c}_z": half_up(f"{c}_z", 9) for c in _FEATS}))
    return d.select(*K, "is_train", "target", *[f"{c}_z" for c in _FEATS])


@register("ml07_knn_scores", KNN_SQL + """,
sc AS (SELECT symbol, CAST(k AS INT) AS k, 1 - avg(CASE WHEN is_train THEN pow(y - pred, 2) END) / nullif(var_pop(CASE WHEN is_train THEN y END), 0) AS r2_train,
              1 - avg(CASE WHEN NOT is_train THEN pow(y - pred, 2) END) / nullif(var_pop(CASE WHEN NOT is_train THEN y END), 0) AS r2_test FROM pk GROUP BY symbol, k)
""" + rsql(["symbol", "k", "r2_train", "r2_test"], ["r2_train", "r2_test"], "sc"))
def q_ml07(spark, sf):
    """ML-7: R^2 of k-nearest-neighbour regression for k = 2..12 on training and test rows."""
    return rounded(KNN.knn_scores(_knn_rows(spark, sf), [f"{c}_z" for c in _FEATS], "target", range(2, 13)))


@register("ml07_knn_predictions", KNN_SQL + "\n" + rsql(K + ["is_train", "pred"], ["pred"], "pk") + " WHERE k = 12")
def q_ml07_pred(spark, sf):
    """ML-7: predictions with twelve neighbours for training and test rows."""
    d = KNN.knn_regression(_knn_rows(spark, sf), [f"{c}_z" for c in _FEATS], "target", 12)
    return rounded(d.select(*K, "is_train", "pred"))


@register("ml08_ts_folds", HOURLY + """,
b AS (SELECT symbol, bar_ts, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) - 1 AS p, count(*) OVER (PARTITION BY symbol) AS n FROM bars),
f AS (SELECT b.*, fold, n - (3 - fold) * floor(n / 4) AS st, floor(n / 4) AS sz FROM b, range(0, 3) t(fold))
SELECT symbol, bar_ts, CAST(fold AS INT) AS fold, CASE WHEN p < st THEN 'train' ELSE 'test' END AS role FROM f WHERE p < st + sz""")
def q_ml08(spark, sf):
    return ML.ts_folds(bars_hourly(spark, sf), 3).select(*K, "fold", "role")


@register("ml09_model_average", LAG_SQL + """,
r1 AS (SELECT symbol, regr_slope(Today, Lag1) AS b1, regr_intercept(Today, Lag1) AS a1, regr_slope(Today, Lag2) AS b2,
              regr_intercept(Today, Lag2) AS a2 FROM v WHERE is_train GROUP BY symbol)
SELECT symbol, bar_ts, round(((a1 + b1 * Lag1) + (a2 + b2 * Lag2)) / 2, 6) AS pred FROM v JOIN r1 USING (symbol) WHERE NOT is_train""")
def q_ml09(spark, sf):
    d = _lagged(spark, sf)
    f1 = ML.ols_1d(d, "Lag1", "Today", keys=["symbol"]).select("symbol", F.col("slope").alias("b1"), F.col("intercept").alias("a1"))
    f2 = ML.ols_1d(d, "Lag2", "Today", keys=["symbol"]).select("symbol", F.col("slope").alias("b2"), F.col("intercept").alias("a2"))
    p = d.filter(~F.col("is_train")).join(f1.join(f2, "symbol"), "symbol")
    return rounded(p.select(*K, (((F.col("a1") + F.col("b1") * F.col("Lag1")) + (F.col("a2") + F.col("b2") * F.col("Lag2"))) / 2)
                            .alias("pred")))


def _da_sql(quadratic: bool) -> str:
    if quadratic:
        abc = "s11 AS a_, s22 AS b_, s12 AS c_"
        score = "-0.5 * ln(a_ * b_ - c_ * c_) - 0.5 * maha + lp"
    else:
        abc = "p11 / (n - kk) AS a_, p22 / (n - kk) AS b_, p12 / (n - kk) AS c_"
        score = "-0.5 * maha + lp"
    return LAG_SQL + f""",
cls AS (SELECT symbol, Direction AS k, count(*) AS nk, avg(Lag1) AS m1, avg(Lag2) AS m2, var_samp(Lag1) AS s11, var_samp(Lag2) AS s22,
               covar_samp(Lag1, Lag2) AS s12 FROM v WHERE is_train GROUP BY 1, 2),
tot AS (SELECT symbol, sum(nk) AS n, count(*) AS kk, sum((nk - 1) * s11) AS p11, sum((nk - 1) * s22) AS p22, sum((nk - 1) * s12) AS p12
        FROM cls GROUP BY 1),
c2 AS (SELECT cls.symbol, k, m1, m2, ln(nk / n) AS lp, {abc} FROM cls JOIN tot USING (symbol)),
j AS (SELECT v.symbol, v.bar_ts, v.Direction, v.is_train, c2.k, c2.lp, c2.a_, c2.b_, c2.c_,
             (b_ * (Lag1 - m1) * (Lag1 - m1) - 2 * c_ * (Lag1 - m1) * (Lag2 - m2) + a_ * (Lag2 - m2) * (Lag2 - m2)) / (a_ * b_ - c_ * c_) AS maha
      FROM v JOIN c2 USING (symbol)),
s AS (SELECT symbol, bar_ts, Direction, is_train, arg_max(k, ({score}, -k)) AS pred FROM j GROUP BY 1, 2, 3, 4)
SELECT symbol, round(avg(CASE WHEN pred = Direction THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS n_test FROM s
WHERE NOT is_train GROUP BY symbol"""


def _da(spark, sf, quadratic):
    d = ML.discriminant_2d(_lagged(spark, sf), "Lag1", "Lag2", "Direction", quadratic=quadratic)
    return rounded(d.filter(~F.col("is_train")).groupBy("symbol").agg(
        F.avg((F.col("pred") == F.col("Direction")).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n_test")))


@register("ml10_lda", _da_sql(False))
def q_ml10a(spark, sf):
    return _da(spark, sf, False)


@register("ml10_qda", _da_sql(True))
def q_ml10b(spark, sf):
    return _da(spark, sf, True)


# --- STR ----------------------------------------------------------------------------------------

def _stream_dirs(spark, name):
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex}"
    return root, f"{root}/out", f"{root}/state"


@register("str01_stream_bars", "WITH " + BARS_HOURLY_SQL + "\n" + rsql(
    ["symbol", "bar_ts", "open", "high", "low", "close", "volume"], ["open", "high", "low", "close", "volume"], "bars"))
def q_str01(spark, sf):
    """Events read as a file stream (trigger availableNow), hourly bars with a watermark in update
    mode, newest version per bar."""
    _, out, state = _stream_dirs(spark, "bars")
    ST.run_bar_stream(spark, f"{sf}/events*.parquet", out, state)
    return rounded(ST.latest_bars(spark, out))


@register("str02_stream_latest_signal", HOURLY + "," + S.roc_signal_ctes("bars", ROC) + """
SELECT symbol, arg_max(bar_ts, pos) AS bar_ts, round(arg_max(y_pred_val, pos), 6) AS y_pred_val, arg_max(signal, pos) AS signal
FROM td GROUP BY symbol""")
def q_str02(spark, sf):
    """Latest ROC signal per symbol recomputed on each micro-batch from a bounded look-back of bars."""
    root, out, state = _stream_dirs(spark, "signals")
    ST.run_signal_stream(spark, f"{sf}/events*.parquet", f"{root}/bars", out, state, ROC)
    return rounded(ST.latest_signals(spark, out))
