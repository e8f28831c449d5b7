"""DuckDB SQL fragments for the oracle queries (sequential definitions, independent of the Spark
block machinery): indicator recursions are recursive CTEs that follow the textbook loop."""

from __future__ import annotations

from candela.config import StrategyConfig


def f(x: float) -> str:
    """Float literal that DuckDB reads as DOUBLE."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def indexed(src: str, name: str, pos: str = "pos") -> str:
    return f"{name} AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY bar_ts) - 1 AS {pos} FROM {src})"


def adx_ctes(src: str, n: int, out: str = "ADX", name: str = "adx_out") -> str:
    """``name``: all columns of ``src`` (which has ``pos`` 0..) plus ``out``."""
    return f"""
{name}_dm AS (
  SELECT symbol, pos, high - lag(high) OVER w AS dp, lag(low) OVER w - low AS dm,
         greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w)) AS tr
  FROM {src} WINDOW w AS (PARTITION BY symbol ORDER BY pos)),
{name}_x AS (
  SELECT symbol, pos, tr,
         CASE WHEN dm > 0 AND dp < dm THEN dm ELSE 0.0 END AS mdm,
         CASE WHEN NOT (dm > 0 AND dp < dm) AND dp > 0 AND dp > dm THEN dp ELSE 0.0 END AS pdm
  FROM {name}_dm),
{name}_rec AS (
  SELECT symbol, pos, sp, sm, st, 0.0::DOUBLE AS dxsum, NULL::DOUBLE AS adx FROM (
    SELECT symbol, {n - 1} AS pos, sum(pdm) AS sp, sum(mdm) AS sm, sum(tr) AS st
    FROM {name}_x WHERE pos BETWEEN 1 AND {n - 1} GROUP BY symbol HAVING count(*) = {n - 1})
  UNION ALL
  SELECT r.symbol, r.pos + 1, q.sp2, q.sm2, q.st2,
         CASE WHEN r.pos + 1 <= {2 * n - 1} THEN r.dxsum + coalesce(q.dx, 0.0) ELSE r.dxsum END,
         CASE WHEN r.pos + 1 < {2 * n - 1} THEN NULL
              WHEN r.pos + 1 = {2 * n - 1} THEN (r.dxsum + coalesce(q.dx, 0.0)) / {n}
              WHEN q.dx IS NULL THEN r.adx
              ELSE (r.adx * {n - 1} + q.dx) / {n} END
  FROM {name}_rec r JOIN {name}_x x ON x.symbol = r.symbol AND x.pos = r.pos + 1,
  LATERAL (SELECT r.sp - r.sp / {n} + x.pdm AS sp2, r.sm - r.sm / {n} + x.mdm AS sm2, r.st - r.st / {n} + x.tr AS st2,
                  CASE WHEN (r.st - r.st / {n} + x.tr) <> 0
                        AND 100.0 * (r.sp - r.sp / {n} + x.pdm) / (r.st - r.st / {n} + x.tr)
                          + 100.0 * (r.sm - r.sm / {n} + x.mdm) / (r.st - r.st / {n} + x.tr) <> 0
                       THEN 100.0 * abs(100.0 * (r.sm - r.sm / {n} + x.mdm) / (r.st - r.st / {n} + x.tr)
                                        - 100.0 * (r.sp - r.sp / {n} + x.pdm) / (r.st - r.st / {n} + x.tr))
                            / (100.0 * (r.sm - r.sm / {n} + x.mdm) / (r.st - r.st / {n} + x.tr)
                               + 100.0 * (r.sp - r.sp / {n} + x.pdm) / (r.st - r.st / {n} + x.tr))
                  END AS dx) q),
{name} AS (SELECT s.*, r.adx AS {out} FROM {src} s LEFT JOIN {name}_rec r ON r.symbol = s.symbol AND r.pos = s.pos)"""


def wilder_mean_ctes(src: str, u_expr: str, n: int, out: str, name: str) -> str:
    """Wilder mean of ``u_expr`` (a window expression over ``w``): seed = mean of bars 1..n at bar n,
    then y = (y*(n-1) + u)/n."""
    return f"""
{name}_u AS (SELECT symbol, pos, {u_expr} AS u FROM {src} WINDOW w AS (PARTITION BY symbol ORDER BY pos)),
{name}_rec AS (
  SELECT symbol, {n} AS pos, avg(u) AS y FROM {name}_u WHERE pos BETWEEN 1 AND {n} GROUP BY symbol HAVING count(*) = {n}
  UNION ALL
  SELECT r.symbol, r.pos + 1, (r.y * {n - 1} + x.u) / {n}
  FROM {name}_rec r JOIN {name}_u x ON x.symbol = r.symbol AND x.pos = r.pos + 1),
{name} AS (SELECT s.*, r.y AS {out} FROM {src} s LEFT JOIN {name}_rec r ON r.symbol = s.symbol AND r.pos = s.pos)"""


def rsi_ctes(src: str, n: int, out: str = "RSI", name: str = "rsi_out") -> str:
    g = wilder_mean_ctes(src, "greatest(close - lag(close) OVER w, 0.0)", n, "_G", f"{name}_g")
    l_ = wilder_mean_ctes(f"{name}_g", "greatest(lag(close) OVER w - close, 0.0)", n, "_L", f"{name}_l")
    return g + "," + l_ + f""",
{name} AS (SELECT * EXCLUDE (_G, _L), CASE WHEN _G + _L = 0 THEN 0.0 ELSE 100.0 * _G / (_G + _L) END AS {out}
           FROM {name}_l)"""


def atr_ctes(src: str, n: int, out: str = "ATR", name: str = "atr_out") -> str:
    return wilder_mean_ctes(
        src, "greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w))", n, out, name)


def full_avg(c: str, n: int, w: str = "w") -> str:
    return (f"CASE WHEN count({c}) OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) >= {n} "
            f"THEN avg({c}) OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END")


def full_agg(agg: str, c: str, n: int, w: str = "w") -> str:
    return (f"CASE WHEN count({c}) OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) >= {n} "
            f"THEN {agg}({c}) OVER ({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END")


def roc_signal_ctes(src: str, cfg: StrategyConfig, name: str = "td") -> str:
    """ROC rule signal frame with the same warm-up drop as ``signals.roc_signal``."""
    n, d = cfg.roc_period, cfg.signal_delay + 1
    return f"""
{name}_a AS (
  SELECT *, close / nullif(lag(close) OVER w, 0) AS DR,
         CASE WHEN lag(close, {n}) OVER w IS NULL THEN NULL WHEN lag(close, {n}) OVER w = 0 THEN 0.0
              ELSE 100.0 * (close / lag(close, {n}) OVER w - 1) END AS ROC
  FROM {src} WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts)),
{name}_b AS (
  SELECT *, lag(CASE WHEN ROC > {f(cfg.roc_threshold)} THEN 1.0 ELSE 0.0 END, {d}) OVER w AS y_pred_val
  FROM {name}_a WINDOW w AS (PARTITION BY symbol ORDER BY bar_ts)),
{name}_c AS (
  SELECT symbol, bar_ts, open, high, low, close, volume, DR, ROC, y_pred_val,
         coalesce(y_pred_val >= {f(cfg.signal_threshold)}, false) AS y_pred,
         CAST(trunc(y_pred_val * {f(cfg.signal_scale)}) AS BIGINT) AS y_pred_id,
         CASE WHEN coalesce(y_pred_val >= {f(cfg.signal_threshold)}, false) THEN 'Buy' ELSE 'Sell' END AS signal
  FROM {name}_b WHERE y_pred_val IS NOT NULL AND DR IS NOT NULL AND ROC IS NOT NULL),
{indexed(f"{name}_c", name)}"""


def pnl_ctes(td: str, cfg: StrategyConfig, name: str = "pnl") -> str:
    """The P&L frame of ``run_pnl`` for a signal frame ``td`` with ``pos`` (no stops/short/breakout
    variants beyond what ``cfg`` enables in this SQL: stops and take-profit flags, fees, adjust)."""
    lf, mf = cfg.open_fee, cfg.market_fee
    sl_terms = ["false"]
    if cfg.buy_sl:
        sl_terms.append("(signal = 'Buy' AND sl_price <= open AND sl_price >= low)")
    if cfg.sell_sl:
        sl_terms.append("(signal = 'Sell' AND sl_price >= open AND sl_price <= high)")
    tp_terms = ["false"]
    if cfg.buy_tp:
        tp_terms.append("(signal = 'Buy' AND tp_price >= open AND tp_price <= high)")
    if cfg.sell_tp and cfg.short:
        tp_terms.append("(signal = 'Sell' AND tp_price <= open AND tp_price >= low)")
    ctr = "CASE WHEN signal = 'Buy' THEN close_price / nullif(open_price, 0)"
    if cfg.short:
        ctr += " WHEN signal = 'Sell' THEN 2.0 - close_price / nullif(open_price, 0)"
    ctr += " ELSE 1.0 END"
    if cfg.breakout:
        ctr = f"CASE WHEN signal = 'Sell' AND sl THEN ({ctr}) * (close / nullif(sl_price, 0)) ELSE {ctr} END"
    fee = f"CASE WHEN sl THEN {f(lf)} + ctr * {f(mf)} ELSE {f(lf)} + ctr * {f(lf)} END"
    if cfg.short and cfg.breakout:
        fee = f"CASE WHEN signal = 'Sell' AND sl THEN ({fee}) + ctr * {f(mf + lf)} ELSE {fee} END"
    if not cfg.short and not cfg.breakout:
        fee = f"CASE WHEN signal = 'Sell' THEN 0.0 ELSE {fee} END"
    margin = "0.0"
    if cfg.short:
        margin = (f"CASE WHEN signal = 'Sell' THEN {f(cfg.margin_open)} + {f(cfg.margin)} * "
                  f"(sum(1) OVER (PARTITION BY symbol, trade_id ORDER BY pos ROWS UNBOUNDED PRECEDING)) ELSE 0.0 END")
    sr = "CASE WHEN new_trade THEN ctrf ELSE ctrf / nullif(lag(ctrf) OVER w, 0) END"
    if cfg.position_sizing:
        sr = f"(({sr}) - 1) * size + 1"
    n = cfg.asr_period
    adjust = ""
    if cfg.adjust_signal:
        adjust = f""",
{name}_j1 AS (SELECT * REPLACE (CASE WHEN ADX_prev < {f(cfg.adx_lo_threshold)} OR ADX_prev > {f(cfg.adx_hi_threshold)}
                                     THEN 'Cash' ELSE signal END AS signal) FROM {name}_s),
{name}_j2 AS (SELECT * REPLACE (CASE WHEN signal = 'Cash' THEN 1.0 ELSE SR END AS SR) FROM {name}_j1),
{name}_j3 AS (SELECT *, CASE WHEN count(SR) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) >= {n}
                         THEN avg(SR) OVER (w ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) END AS ASR
              FROM {name}_j2 WINDOW w AS (PARTITION BY symbol ORDER BY pos)),
{name}_j4 AS (SELECT * REPLACE (CASE WHEN ASR < {f(cfg.asr_threshold)} THEN 'Cash' ELSE signal END AS signal) FROM {name}_j3),
{name}_j5 AS (SELECT * REPLACE (CASE WHEN signal = 'Cash' THEN 1.0 ELSE SR END AS SR) FROM {name}_j4)"""
    last = f"{name}_j5" if cfg.adjust_signal else f"{name}_s"
    sma = full_avg("close", cfg.stop_sma_period)
    return f"""
{adx_ctes(td, cfg.adx_period, "ADX", f"{name}_adx")},
{name}_b0 AS (SELECT symbol, bar_ts, pos, open, high, low, close, signal, y_pred_id, y_pred, y_pred_val{", size" if cfg.position_sizing else ""}, ADX
              FROM {name}_adx WHERE ADX IS NOT NULL AND signal IS NOT NULL),
{name}_b1 AS (
  SELECT *, (high + low + close) / 3 AS PP FROM {name}_b0),
{name}_b2 AS (
  SELECT *, 2 * PP - low AS R1, 2 * PP - high AS S1, PP + high - low AS R2, PP - high + low AS S2,
         high + 2 * (PP - low) AS R3, low - 2 * (high - PP) AS S3, high + 3 * (PP - low) AS R4, low - 3 * (high - PP) AS S4,
         {sma} AS _sma
  FROM {name}_b1 WINDOW w AS (PARTITION BY symbol ORDER BY pos)),
{name}_b3 AS (
  SELECT *, CASE WHEN signal = 'Sell' THEN lag(R2) OVER w WHEN signal = 'Buy' THEN lag(_sma) OVER w ELSE 0.0 END AS sl_price,
         CASE WHEN signal = 'Sell' THEN open * {f(1 - cfg.take_profit)} WHEN signal = 'Buy' THEN open * {f(1 + cfg.take_profit)}
              ELSE 0.0 END AS tp_price,
         close / nullif(lag(close) OVER w, 0) AS DR, lag(ADX) OVER w AS ADX_prev
  FROM {name}_b2 WINDOW w AS (PARTITION BY symbol ORDER BY pos)),
{name}_b4 AS (SELECT *, coalesce({' OR '.join(sl_terms)}, false) AS sl, coalesce({' OR '.join(tp_terms)}, false) AS tp FROM {name}_b3),
{name}_b5 AS (
  SELECT *, (signal IS DISTINCT FROM lag(signal) OVER w) OR coalesce(lag(sl) OVER w, false)
            OR coalesce(lag(tp) OVER w, false) AS new_trade
  FROM {name}_b4 WINDOW w AS (PARTITION BY symbol ORDER BY pos)),
{name}_f AS (
  SELECT * REPLACE (last_value(sl_price IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS sl_price),
         last_value(CASE WHEN new_trade THEN CAST(epoch(bar_ts) AS BIGINT) END IGNORE NULLS)
           OVER (w ROWS UNBOUNDED PRECEDING) AS trade_id,
         last_value(CASE WHEN new_trade THEN open END IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS open_price
  FROM {name}_b5 WINDOW w AS (PARTITION BY symbol ORDER BY pos)),
{name}_g AS (SELECT *, CASE WHEN sl THEN sl_price WHEN tp THEN tp_price ELSE close END AS close_price FROM {name}_f),
{name}_h AS (SELECT *, {ctr} AS ctr FROM {name}_g),
{name}_i AS (SELECT *, {margin} AS summargin, {fee} AS fee FROM {name}_h),
{name}_k AS (SELECT *, ctr - fee - summargin AS ctrf FROM {name}_i),
{name}_s AS (SELECT *, {sr} AS SR FROM {name}_k WINDOW w AS (PARTITION BY symbol ORDER BY pos)){adjust},
{name} AS (
  SELECT *, CASE WHEN DR > 1 THEN 1 ELSE 0 END AS Price_Rise,
         coalesce(lead(bar_ts) OVER w, bar_ts + INTERVAL {cfg.trade_interval} MINUTE) AS date_to,
         product(SR) OVER (w ROWS UNBOUNDED PRECEDING) AS CSR,
         product(DR) OVER (w ROWS UNBOUNDED PRECEDING) AS CMR
  FROM {last} WINDOW w AS (PARTITION BY symbol ORDER BY pos))"""


def publish_sql(x: str, decimals: int = 6, digits: int = 10) -> str:
    """DuckDB twin of ``scalar.publish`` (same decade correction, same literal powers of ten)."""
    def pw(i):
        return f"CAST('1e' || CAST(CAST(({i}) AS INTEGER) AS VARCHAR) AS DOUBLE)"
    body = (f"list_transform([CAST(least(greatest(floor(log10(abs(_x))), -30), 306) AS INTEGER)], lambda _k0: "
            f"CASE WHEN abs(_x) < {pw('_k0')} THEN _k0 - 1 WHEN abs(_x) >= {pw('_k0 + 1')} THEN _k0 + 1 ELSE _k0 END)[1]")
    rnd = (f"list_transform([least({decimals}, {digits - 1} - ({body}))], lambda _d: "
           f"floor((floor(_x * {pw('_d + 3')} + 0.5) / {pw('_d + 3')}) * {pw('_d')} + 0.5) / {pw('_d')})[1]")
    return (f"(list_transform([CAST(({x}) AS DOUBLE)], lambda _x: CASE WHEN _x IS NULL OR _x = 0 THEN _x "
            f"ELSE {rnd} END)[1])")


def sig_sql(x: str, digits: int = 8) -> str:
    """Compounded multiples: 6 decimals, at most 8 significant digits."""
    return publish_sql(x, 6, digits)


def half_up_sql(sql: str) -> str:
    """Rewrite every ``round(e, d)`` of an oracle query into the half-up double formula of
    ``scalar.half_up`` so both engines publish identical digits."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, comma, k = 0, None, j + 5
        for k in range(j + 5, len(sql)):
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
                if depth == 0:
                    break
            elif ch == "," and depth == 1:
                comma = k
        out.append(sql[i:j])
        if comma is None:
            out.append(sql[j:k + 1])
        else:
            inner = half_up_sql(sql[j + 6:comma])
            d = int(sql[comma + 1:k].strip())
            if d == 6:
                out.append(publish_sql(inner))
                i = k + 1
                continue
            sc, fn = repr(float(10.0 ** d)), repr(float(10.0 ** (d + 3)))
            snap = f"CASE WHEN abs(_x) * {fn} < 1e17 THEN floor(_x * {fn} + 0.5) / {fn} ELSE _x END"
            fin = f"CASE WHEN abs(_s) * {sc} < 1e17 THEN floor(_s * {sc} + 0.5) / {sc} ELSE round(_s, {d}) END"
            out.append(f"(list_transform(list_transform([CAST(({inner}) AS DOUBLE)], lambda _x: {snap}), lambda _s: {fin})[1])")
        i = k + 1
