"""Model pipeline (ML-1..10) on Spark MLlib and aggregates.

Scalers are fitted with aggregates on training rows and applied with a join, so the statistics are
exact and testable. Estimators are MLlib (distributed fits over all symbols' rows). LDA/QDA with
two features are closed-form from per-class moments (one aggregate).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.functions.scalar import div
from candela.operators.features import ensure_indexed, whole_series
from candela.operators.series import RN


def standard_scale(df: DataFrame, cols: Sequence[str], train_col: str = "is_train", keys: Sequence[str] = ("symbol",),
                   suffix: str = "_z") -> DataFrame:
    """ML-1: (x - mean) / population std with statistics from training rows only (Q26, Q28)."""
    keys = list(keys)
    stats = df.filter(F.col(train_col)).groupBy(*keys).agg(
        *[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    out = df.join(stats, keys, "left")
    for c in cols:
        out = out.withColumn(f"{c}{suffix}", div(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")))
    return out.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def minmax_scale(df: DataFrame, c: str, train_col: str = "is_train", keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """ML-2: (y - min) / (max - min) fitted on training rows, plus the inverse transform."""
    keys = list(keys)
    st = df.filter(F.col(train_col)).groupBy(*keys).agg(F.min(c).alias("_lo"), F.max(c).alias("_hi"))
    out = df.join(st, keys, "left").withColumn(f"{c}_mm", div(F.col(c) - F.col("_lo"), F.col("_hi") - F.col("_lo")))
    return out.withColumn(f"{c}_inv", F.col(f"{c}_mm") * (F.col("_hi") - F.col("_lo")) + F.col("_lo")).drop("_lo", "_hi")


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector; a row with a missing feature is an error, so callers decide what to drop."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def classifier_bakeoff(df: DataFrame, cols: Sequence[str], label: str, train_col: str = "is_train",
                       seed: int = 7) -> DataFrame:
    """ML-3/ML-6: fit logistic regression, linear SVM, Gaussian naive Bayes, decision tree, random
    forest, boosted trees and a small dense network on training rows; accuracy on test rows."""
    from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                           MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier)
    d = assemble(df, cols).withColumn("label", F.col(label).cast("double"))
    train, test = d.filter(F.col(train_col)), d.filter(~F.col(train_col))
    models = [
        ("LR", LogisticRegression(maxIter=100)),
        ("LSVC", LinearSVC(maxIter=100)),
        ("NB", NaiveBayes(modelType="gaussian")),
        ("DT", DecisionTreeClassifier(maxDepth=5, seed=seed)),
        ("RF", RandomForestClassifier(numTrees=50, maxDepth=6, seed=seed)),
        ("GBT", GBTClassifier(maxIter=20, maxDepth=3, seed=seed)),
        ("MLP", MultilayerPerceptronClassifier(layers=[len(cols), 16, 16, 2], maxIter=100, seed=seed)),
    ]
    rows = None
    for name, est in models:
        pred = est.fit(train).transform(test)
        acc = pred.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
                       F.count(F.lit(1)).alias("n_test")).withColumn("model", F.lit(name))
        rows = acc if rows is None else rows.unionByName(acc)
    return rows


def logistic_facts(df: DataFrame, cols: Sequence[str], label: str, train_col: str = "is_train") -> DataFrame:
    """ML-3: what must hold at the maximum of the likelihood, whichever solver found it: over the training rows the fitted
    probabilities sum to the number of rises, and the gradient of every coefficient is zero. One row: n, n_up, expected_up,
    steepest (the largest mean gradient)."""
    from pyspark.ml.classification import LogisticRegression
    train = df.filter(F.col(train_col)).withColumn("_y", F.col(label).cast("double"))
    m = LogisticRegression(labelCol="_y", maxIter=500, tol=1e-12).fit(assemble(train, cols))
    z = F.lit(float(m.intercept))
    for c, w in zip(cols, m.coefficients):
        z = z + F.lit(float(w)) * F.col(c)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    slopes = [F.abs(F.avg((p - F.col("_y")) * F.col(c))) for c in cols]
    return train.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_y").cast("long")).alias("n_up"), F.sum(p).alias("expected_up"),
                     F.array_max(F.array(*slopes)).alias("steepest"))


def naive_bayes(df: DataFrame, cols: Sequence[str], label: str, train_col: str = "is_train") -> DataFrame:
    """ML-3: test rows with the prediction of Gaussian naive Bayes fitted on the training rows."""
    from pyspark.ml.classification import NaiveBayes
    d = assemble(df, cols).withColumn("label", F.col(label).cast("double"))
    m = NaiveBayes(modelType="gaussian").fit(d.filter(F.col(train_col)))
    return m.transform(d.filter(~F.col(train_col))).drop("features", "label", "rawPrediction", "probability")


def fit_linear(df: DataFrame, cols: Sequence[str], label: str, train_col: str = "is_train"):
    """ML-4: least squares with intercept on the training rows by the normal equations (one pass; the
    driver gets one matrix of the features)."""
    from pyspark.ml.regression import LinearRegression
    d = assemble(df.filter(F.col(train_col)), cols).withColumn("label", F.col(label).cast("double"))
    return LinearRegression(solver="normal", regParam=0.0, fitIntercept=True).fit(d)


def linear_regression(df: DataFrame, cols: Sequence[str], label: str, train_col: str = "is_train") -> DataFrame:
    """ML-4: coefficients and intercept of ``fit_linear``."""
    m = fit_linear(df, cols, label, train_col)
    return df.sparkSession.createDataFrame([(c, float(w)) for c, w in zip(cols, m.coefficients)] + [("intercept", float(m.intercept))],
                                           "term string, value double")


def linear_terms(df: DataFrame, cols: Sequence[str], label: str, train_col: str = "is_train") -> DataFrame:
    """ML-4: per term the coefficient, its standard error, t value and two-sided p value. Features that
    depend on one another linearly have no standard errors; MLlib raises then."""
    m = fit_linear(df, cols, label, train_col)
    s = m.summary
    rows = zip([*cols, "intercept"], [*m.coefficients, m.intercept], s.coefficientStandardErrors, s.tValues, s.pValues)
    return df.sparkSession.createDataFrame([(t, *map(float, v)) for t, *v in rows],
                                           "term string, value double, std_error double, t_value double, p_value double")


def linear_predict(df: DataFrame, cols: Sequence[str], label: str, train_col: str = "is_train", out: str = "pred") -> DataFrame:
    """ML-4: ``df`` (training and test rows) with the fitted value."""
    m = fit_linear(df, cols, label, train_col)
    value = F.lit(float(m.intercept))
    for c, w in zip(cols, m.coefficients):
        value = value + F.lit(float(w)) * F.col(c)
    return df.withColumn(out, value)


def regression_fit(df: DataFrame, label: str, pred: str = "pred", by: str = "is_train") -> DataFrame:
    """ML-4: rows, root mean squared error and R^2 of training and of test rows (R^2 NULL for a constant label)."""
    sq = F.pow(F.col(label) - F.col(pred), 2)
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(sq)).alias("rmse"),
                              (F.lit(1.0) - div(F.avg(sq), F.var_pop(label))).alias("r2"))


def ts_folds(df: DataFrame, n_splits: int = 3, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """ML-8: expanding-window folds per symbol: test size = n // (splits + 1); fold i tests the rows
    [n - (splits - i) * size, n - (splits - i - 1) * size) and trains on every earlier row."""
    d = whole_series(ensure_indexed(df, keys), {"_n": F.count(F.lit(1)), "_r0": F.min(RN)}, keys)
    pos = F.col(RN) - F.col("_r0")
    size = F.floor(F.col("_n") / (n_splits + 1))
    d = d.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    start = F.col("_n") - (F.lit(n_splits) - F.col("fold")) * size
    role = F.when(pos < start, F.lit("train")).when(pos < start + size, F.lit("test"))
    return d.withColumn("role", role).filter(F.col("role").isNotNull()).drop("_n", "_r0")


def ols_1d(df: DataFrame, x: str, y: str, train_col: str = "is_train", keys: Sequence[str] = ()) -> DataFrame:
    """Closed-form 1-feature least squares (slope, intercept) on training rows (ML-4 check, ML-9)."""
    g = df.filter(F.col(train_col))
    g = g.groupBy(*keys) if keys else g.groupBy()
    return g.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def discriminant_2d(df: DataFrame, x1: str, x2: str, label: str, train_col: str = "is_train",
                    quadratic: bool = False, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """ML-10: linear (pooled covariance) or quadratic (per-class covariance) discriminant analysis on
    two features, fitted per symbol from per-class moments; adds ``pred`` (NULL where the covariance is
    singular, as with a flat feature or one row per class)."""
    keys = list(keys)
    tr = df.filter(F.col(train_col) & F.col(x1).isNotNull() & F.col(x2).isNotNull())
    cls = tr.groupBy(*keys, F.col(label).alias("_k")).agg(
        F.count(F.lit(1)).alias("_nk"), F.avg(x1).alias("_m1"), F.avg(x2).alias("_m2"),
        F.var_samp(x1).alias("_s11"), F.var_samp(x2).alias("_s22"), F.covar_samp(x1, x2).alias("_s12"))
    tot = cls.groupBy(*keys).agg(F.sum("_nk").alias("_n"), F.count(F.lit(1)).alias("_ncls"),
                                 F.sum((F.col("_nk") - 1) * F.col("_s11")).alias("_p11"),
                                 F.sum((F.col("_nk") - 1) * F.col("_s22")).alias("_p22"),
                                 F.sum((F.col("_nk") - 1) * F.col("_s12")).alias("_p12"))
    cls = cls.join(tot, keys)
    if quadratic:
        a, b, c = F.col("_s11"), F.col("_s22"), F.col("_s12")
    else:
        den = F.col("_n") - F.col("_ncls")
        a, b, c = div("_p11", den), div("_p22", den), div("_p12", den)
    cls = cls.select(*keys, "_k", "_m1", "_m2", F.ln(F.col("_nk") / F.col("_n")).alias("_lp"),
                     a.alias("_a"), b.alias("_b"), c.alias("_c"))
    # one row per key holds the classes' moments; a row is scored against them in place
    held = cls.groupBy(*keys).agg(F.collect_list(F.struct("_k", "_m1", "_m2", "_lp", "_a", "_b", "_c")).alias("_cls"))

    def score(c):
        det = c["_a"] * c["_b"] - c["_c"] * c["_c"]
        d1, d2 = F.col(x1) - c["_m1"], F.col(x2) - c["_m2"]
        maha = div(c["_b"] * d1 * d1 - 2 * c["_c"] * d1 * d2 + c["_a"] * d2 * d2, det)
        s = -0.5 * maha + c["_lp"]  # linear: the shared x' S^-1 x term cancels between classes
        if quadratic:
            s = -0.5 * F.ln(det) - 0.5 * maha + c["_lp"]
        return F.struct(s.alias("s"), (-c["_k"]).alias("n"), c["_k"].alias("k"))

    best = F.array_max(F.filter(F.transform("_cls", score), lambda z: z["s"].isNotNull()))
    return df.join(held, keys, "left").withColumn("pred", best["k"]).drop("_cls")
