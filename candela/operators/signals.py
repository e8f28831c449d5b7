"""Scores to trading signals and positions (SIG-1..13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candela.config import StrategyConfig
from candela.functions.scalar import col, div, half_up, lag, truncate, truncate_id
from candela.operators.features import e_gross_return, e_roc, ensure_indexed, rolling, whole_series
from candela.operators.indicators import ffill
from candela.operators.series import RN, dropna_dense


def align_scores(df: DataFrame, score: str, delay: int = 1, out: str = "y_pred_val") -> DataFrame:
    """SIG-1: the score of bar i acts on bar i+delay (no look-ahead)."""
    return rolling(df, {out: lambda w: lag(score, delay, w)}, back=delay)


def threshold_signal(c: str | Column = "y_pred_val", threshold: float = 0.5) -> tuple[Column, Column]:
    """SIG-2: (y_pred, signal) with y_pred = score >= threshold (missing -> False)."""
    y = F.coalesce(col(c) >= F.lit(float(threshold)), F.lit(False))
    return y, F.when(y, F.lit("Buy")).otherwise(F.lit("Sell"))


def score_bucket(c: str | Column = "y_pred_val", scale: float = 1000) -> Column:
    """SIG-3: y_pred_id = trunc(score * scale) (BIGINT)."""
    return truncate_id(c, scale)


def gen_signal(df: DataFrame, cfg: StrategyConfig, score: str = "y_pred_val",
               required: Sequence[str] = ()) -> DataFrame:
    """SIG-2..4: signal frame. Rows missing the score or any ``required`` column are dropped; bucket
    ids in ``ignore_signals`` keep the previous signal (forward fill); ``hold_signals`` -> Cash."""
    df = dropna_dense(df, [score, *required])
    y, sig = threshold_signal(score, cfg.signal_threshold)
    df = df.withColumn("y_pred", y).withColumn("y_pred_id", score_bucket(score, cfg.signal_scale)).withColumn("signal", sig)
    if cfg.ignore_signals:
        df = df.withColumn("signal", F.when(~F.col("y_pred_id").isin(list(cfg.ignore_signals)), F.col("signal")))
        df = ffill(df, ["signal"])
    if cfg.hold_signals:
        df = df.withColumn("signal", F.when(F.col("y_pred_id").isin(list(cfg.hold_signals)), F.lit("Cash"))
                           .otherwise(F.col("signal")))
    return df


def roc_scores(bars: DataFrame, cfg: StrategyConfig) -> DataFrame:
    """SIG-5: DR, ROC(n) and the score 1{ROC > threshold} (missing ROC -> 0) delayed by
    ``signal_delay + 1`` bars (quirk Q2)."""
    n, d = cfg.roc_period, cfg.signal_delay + 1
    return rolling(ensure_indexed(bars), {
        "DR": e_gross_return(),
        "ROC": e_roc(n),
        "_raw": lambda w: F.when(F.col("ROC") > F.lit(float(cfg.roc_threshold)), F.lit(1.0)).otherwise(F.lit(0.0)),
        "y_pred_val": lambda w: lag("_raw", d, w),
    }, back=n + d).drop("_raw")


def roc_signal(bars: DataFrame, cfg: StrategyConfig) -> DataFrame:
    """SIG-5 + SIG-2..4: ROC rule signal frame (warm-up rows of DR, ROC and the score dropped)."""
    return gen_signal(roc_scores(bars, cfg), cfg, required=["DR", "ROC"])


def rule_signal(rsi_col="RSI", roc_col="ROC", ma1="MA1", ma2="MA2", rsi_min=0.0, roc_min=0.0) -> Column:
    """SIG-6: 1 when RSI > rsi_min and ROC > roc_min and MA1 >= MA2, else 0."""
    return F.when((col(rsi_col) > rsi_min) & (col(roc_col) > roc_min) & (col(ma1) >= col(ma2)), F.lit(1.0)).otherwise(F.lit(0.0))


def ensemble_signal(members: DataFrame, cfg: StrategyConfig, n_models: int) -> DataFrame:
    """SIG-7 (with JON-3): ``members`` is long (symbol, bar_ts, model, signal). Bars where all models
    have a row are kept; score = mean of Buy flags, also used as position size."""
    agg = (members.groupBy("symbol", "bar_ts")
           .agg(F.avg(F.when(F.col("signal") == "Buy", F.lit(1.0)).otherwise(F.lit(0.0))).alias("y_pred_val"),
                F.countDistinct("model").alias("_n")))
    agg = agg.filter(F.col("_n") == n_models).drop("_n")
    y, sig = threshold_signal("y_pred_val", cfg.signal_threshold)
    return (agg.withColumn("y_pred", y).withColumn("y_pred_id", score_bucket("y_pred_val", cfg.signal_scale))
            .withColumn("signal", sig).withColumn("size", F.col("y_pred_val")))


def breakout_position(df: DataFrame, n: int = 5) -> DataFrame:
    """SIG-9: channel breakout. Close above the prior n-bar high -> long=1, short=0; below the prior
    low -> long=0, short=-1; the position long+short is set only when both are set on the same bar and
    carried forward otherwise (quirk Q14: it never returns to 0 once set)."""
    def prior(agg):
        return lambda w: F.when(F.count("close").over(w.rowsBetween(-n, -1)) >= n, agg("close").over(w.rowsBetween(-n, -1)))
    df = rolling(df, {"ch_high": prior(F.max), "ch_low": prior(F.min)}, back=n)
    up, dn = F.col("close") > F.col("ch_high"), F.col("close") < F.col("ch_low")
    df = df.withColumn("_pos", F.when(up, F.lit(1.0)).when(dn, F.lit(-1.0)))
    return ffill(df, ["_pos"]).withColumnRenamed("_pos", "position")


def today_action(df: DataFrame, action: str = "y_pred_val") -> DataFrame:
    """SIG-10: from a numeric action column, per symbol: BUY when the last value differs from the
    previous one and is positive, SELL when it differs and is not positive, else HOLD."""
    df = rolling(ensure_indexed(df), {"_prev": lambda w: lag(action, 1, w)}, back=1)
    last = df.groupBy("symbol").agg(F.max_by(F.struct(F.col("bar_ts"), F.col(action).alias("cur"), F.col("_prev").alias("prev")),
                                             F.col(RN)).alias("l")).select("symbol", "l.*")
    act = (F.when(~F.col("cur").eqNullSafe(F.col("prev")) & (F.col("cur") > 0), F.lit("BUY"))
           .when(~F.col("cur").eqNullSafe(F.col("prev")), F.lit("SELL")).otherwise(F.lit("HOLD")))
    return last.withColumn("action", act)


def latest_signal(pnl: DataFrame, cfg: StrategyConfig) -> DataFrame:
    """SIG-11: last P&L row per symbol with PnL % and stop/take-profit prices truncated to the price
    precision (max_by over rn: one partial row per task, no sort of the whole series)."""
    fields = ["bar_ts", "date_to", "new_trade", "signal", "open", "close", "CSR", "sl", "sl_price", "tp", "tp_price"]
    last = pnl.groupBy("symbol").agg(F.max_by(F.struct(*fields), F.col(RN)).alias("l")).select("symbol", "l.*")
    return (last.withColumn("pnl", half_up(F.lit(100.0) * (F.col("CSR") - 1), 2))
            .withColumn("sl_price", truncate("sl_price", cfg.price_precision))
            .withColumn("tp_price", truncate("tp_price", cfg.price_precision)))


def signal_text(latest: DataFrame, pair_col: str = "symbol", short: bool = False) -> DataFrame:
    """PRJ-16: one text line per latest signal."""
    txt = F.concat(
        F.col(pair_col), F.lit(":"),
        F.when(F.col("new_trade"), F.lit(" NEW")).otherwise(F.lit(" Same")),
        F.lit(" Signal: "), F.col("signal"),
        F.when(F.lit(short) & (F.col("signal") == "Sell"), F.lit(" SHORT")).otherwise(F.lit("")),
        F.when(F.col("new_trade"), F.concat(F.lit(", Open: "), F.col("open").cast("string"))).otherwise(F.lit("")),
        F.lit(", Total PnL: "), F.coalesce(F.expr("CAST(try_cast(pnl AS DECIMAL(38, 2)) AS STRING)"),
                                           F.col("pnl").cast("string")), F.lit("%"),
        F.when(F.col("tp"), F.lit(" TAKE PROFIT!")).otherwise(F.lit("")),
        F.when(F.col("sl"), F.lit(" STOP LOSS!")).otherwise(F.lit("")))
    return latest.withColumn("text", txt)


def state_id(df: DataFrame, features: Sequence[str], bins: int = 3, train_col: str | None = None) -> DataFrame:
    """SIG-12: each feature binned into ``bins`` equal-frequency bins whose edges are fitted on the
    training rows of each symbol (exact nearest-rank edges: the value at rank floor(i/bins*(n-1))+1,
    found by the distributed order statistic, no per-symbol sort); the state id is the base-``bins``
    number of the bin digits (digit = number of edges below the value), NULL if a feature is missing."""
    from candela.operators.risk import equal_frequency_edges
    fit = df if train_col is None else df.filter(F.col(train_col))
    edges = equal_frequency_edges(fit, features, bins)
    wide = edges.groupBy("symbol").pivot("feature", list(features)).agg(F.first("edges"))
    out = df.join(wide.select("symbol", *[F.col(f"`{f}`").alias(f"_e_{f}") for f in features]), "symbol", "left")
    sid = F.lit(0)
    for f in features:
        digit = F.when(F.col(f).isNotNull(), F.size(F.filter(F.col(f"_e_{f}"), lambda e: e < F.col(f))))
        sid = sid * F.lit(bins) + digit
    return out.withColumn("state", sid.cast("long")).drop(*[f"_e_{f}" for f in features])


def state_reward_table(df: DataFrame, reward: str = "next_ret", min_visits: int = 10) -> DataFrame:
    """SIG-13: per (symbol, state): visits, mean next return, share of the symbol's visits and a
    confidence flag (visits >= min_visits)."""
    t = df.groupBy("symbol", "state").agg(F.count(F.lit(1)).alias("visits"), F.avg(reward).alias("mean_reward"))
    t = whole_series(t, {"_tot": F.sum("visits")}, ["symbol"])
    return (t.withColumn("share", div(F.col("visits"), F.col("_tot")))
            .withColumn("confident", F.col("visits") >= min_visits).drop("_tot"))


def rotate_when(a: DataFrame, b: DataFrame, when_signal: str = "Sell") -> DataFrame:
    """JON-7: bars of B only on timestamps when A's signal is ``when_signal`` (left semi join)."""
    keys = a.filter(F.col("signal") == when_signal).select("bar_ts")
    return b.join(keys, "bar_ts", "left_semi")

