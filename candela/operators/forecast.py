"""Evaluation of supplied forecasts against actuals (JON-8, AGG-16..19).

Forecasts (ds, yhat, yhat_lower, yhat_upper) come from any model; the evaluation is joins, windows
and aggregates. ``moving_average_forecast`` builds a simple forecast table from bars so the
evaluation can run on the test data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.functions.scalar import full, lag
from candela.operators.features import ensure_indexed, rolling
from candela.operators.series import RN, reindex, running


def moving_average_forecast(bars: DataFrame, n: int = 10, ks: Sequence[float] = (2.0,)) -> DataFrame:
    """Forecast table: yhat = previous bar's SMA(close, n); bounds yhat +/- k * rolling std, one
    forecast set per ``k`` (column ``prior``)."""
    d = rolling(ensure_indexed(bars), {
        "yhat": lambda w: F.lag(full(F.avg, "close", w, n), 1).over(w),
        "_sd": lambda w: F.lag(full(F.stddev_samp, "close", w, n), 1).over(w),
    }, back=n)
    d = d.filter(F.col("yhat").isNotNull())
    d = d.withColumn("prior", F.explode(F.array(*[F.lit(float(k)) for k in ks])))
    return d.select("symbol", "bar_ts", "prior", "yhat", (F.col("yhat") - F.col("prior") * F.col("_sd")).alias("yhat_lower"),
                    (F.col("yhat") + F.col("prior") * F.col("_sd")).alias("yhat_upper"))


def join_forecast(actuals: DataFrame, forecast: DataFrame, how: str = "inner") -> DataFrame:
    """JON-8: actuals (symbol, bar_ts, y) joined with the forecast on (symbol, bar_ts)."""
    return actuals.join(forecast, ["symbol", "bar_ts"], how)


def _ts(s: str):
    return F.to_timestamp(F.lit(s)).cast("timestamp_ntz")


def forecast_eval(joined: DataFrame, start: str, end: str, train_years: int = 3) -> DataFrame:
    """AGG-16: over the test range [start, end]: accuracy of the predicted direction (diff of yhat vs
    diff of y) when predicting up and when predicting down, test and train mean absolute error
    (train = the ``train_years`` before start, both ends exclusive) and the share of actuals strictly
    inside the interval."""
    test = joined.filter((F.col("bar_ts") >= _ts(start)) & (F.col("bar_ts") <= _ts(end)))
    test = reindex(test)
    test = rolling(test, {"pred_diff": lambda w: F.col("yhat") - lag("yhat", 1, w),
                          "real_diff": lambda w: F.col("y") - lag("y", 1, w)}, back=1)
    correct = (F.signum("pred_diff") == F.signum("real_diff")).cast("double")
    correct = F.coalesce(correct, F.lit(0.0))
    t = test.groupBy("symbol").agg(
        (F.lit(100.0) * F.avg(F.when(F.col("pred_diff") > 0, correct))).alias("increase_accuracy"),
        (F.lit(100.0) * F.avg(F.when(F.col("pred_diff") < 0, correct))).alias("decrease_accuracy"),
        F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("test_mae"),
        (F.lit(100.0) * F.avg(((F.col("y") < F.col("yhat_upper")) & (F.col("y") > F.col("yhat_lower"))).cast("double")))
        .alias("in_range_pct"))
    lo = F.add_months(_ts(start), -12 * train_years).cast("timestamp_ntz")
    tr = joined.filter((F.col("bar_ts") < _ts(start)) & (F.col("bar_ts") > lo)).groupBy("symbol").agg(
        F.avg(F.abs(F.col("y") - F.col("yhat"))).alias("train_mae"))
    return t.join(tr, "symbol", "left")


def forecast_profit(joined: DataFrame, start: str, end: str, nshares: float = 1.0) -> DataFrame:
    """AGG-17: trading only predicted-up days books nshares * real change (right or wrong, Q20);
    running profit vs holding nshares from the first test day."""
    test = reindex(joined.filter((F.col("bar_ts") >= _ts(start)) & (F.col("bar_ts") <= _ts(end))))
    test = rolling(test, {"pred_diff": lambda w: F.col("yhat") - lag("yhat", 1, w),
                          "real_diff": lambda w: F.col("y") - lag("y", 1, w)}, back=1)
    test = test.withColumn("_p", F.when(F.col("pred_diff") > 0, F.lit(nshares) * F.col("real_diff")).otherwise(F.lit(0.0)))
    test = running(test, [("_p", "sum", "pred_profit")])
    first = test.groupBy("symbol").agg(F.min_by("y", RN).alias("_y0"))
    return (test.join(first, "symbol").withColumn("hold_profit", F.lit(nshares) * (F.col("y") - F.col("_y0")))
            .drop("_p", "_y0"))


def interval_validation(joined: DataFrame, start: str, end: str, train_years: int = 3) -> DataFrame:
    """AGG-18: per forecast set (prior): mean absolute error and mean interval width on train and test."""
    lo = F.add_months(_ts(start), -12 * train_years).cast("timestamp_ntz")
    is_train = (F.col("bar_ts") < _ts(start)) & (F.col("bar_ts") > lo)
    is_test = (F.col("bar_ts") >= _ts(start)) & (F.col("bar_ts") <= _ts(end))
    err = F.abs(F.col("y") - F.col("yhat"))
    rng = F.abs(F.col("yhat_upper") - F.col("yhat_lower"))
    return joined.groupBy("symbol", "prior").agg(
        F.avg(F.when(is_train, err)).alias("train_err"), F.avg(F.when(is_train, rng)).alias("train_range"),
        F.avg(F.when(is_test, err)).alias("test_err"), F.avg(F.when(is_test, rng)).alias("test_range"))


def forecast_direction(forecast: DataFrame, start: str) -> DataFrame:
    """AGG-19: forecast rows from ``start`` on, weekends removed, with the change of the estimate
    and an up (1) / down (0) flag; the first row (no change) is dropped."""
    f = forecast.filter((F.col("bar_ts") >= _ts(start)) & (F.weekday("bar_ts") < 5))
    f = reindex(f)
    f = rolling(f, {"change": lambda w: F.col("yhat") - lag("yhat", 1, w)}, back=1).filter(F.col("change").isNotNull())
    return f.withColumn("direction", (F.col("change") > 0).cast("int")).withColumnRenamed("yhat", "estimate")

