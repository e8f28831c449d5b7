"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

import math

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def named(c: str) -> Column:
    """Column by its literal name, which may hold dots, spaces or quotes."""
    return F.col("`" + c.replace("`", "``") + "`")


def div(a, b) -> Column:
    """Division that yields NULL for a zero or NULL divisor (ANSI mode raises on x/0)."""
    return F.try_divide(col(a), col(b))


def full(agg, c: str | Column, w: Window, n: int) -> Column:
    """``agg`` over the last ``n`` rows, NULL until ``n`` non-NULL values are in the frame
    (pandas ``rolling(n)`` / TA-Lib warm-up semantics)."""
    frame = w.rowsBetween(-(n - 1), 0)
    x = col(c)
    return F.when(F.count(x).over(frame) >= n, agg(x).over(frame))


def lag(c: str | Column, n: int, w: Window) -> Column:
    return F.lag(col(c), n).over(w)


def lead(c: str | Column, n: int, w: Window) -> Column:
    return F.lead(col(c), n).over(w)


def truncate(c: str | Column, digits: int) -> Column:
    """PRJ-10: truncate toward zero at ``digits`` decimals."""
    scale = float(10 ** digits)
    s = col(c) * F.lit(scale)
    return F.when(s >= 0, F.floor(s)).otherwise(F.ceil(s)).cast("double") / F.lit(scale)


def truncate_id(c: str | Column, scale: float) -> Column:
    """SIG-3: trunc(score * scale) as BIGINT."""
    s = col(c) * F.lit(float(scale))
    return F.when(s >= 0, F.floor(s)).otherwise(F.ceil(s)).cast("long")


def pivot_points(high="high", low="low", close="close") -> dict[str, Column]:
    """PRJ-11: classic floor pivots."""
    h, lo, c = col(high), col(low), col(close)
    pp = (h + lo + c) / 3
    return {
        "PP": pp, "R1": 2 * pp - lo, "S1": 2 * pp - h, "R2": pp + h - lo, "S2": pp - h + lo,
        "R3": h + 2 * (pp - lo), "S3": lo - 2 * (h - pp), "R4": h + 3 * (pp - lo), "S4": lo - 3 * (h - pp),
    }


def encode_cyclical(c: str | Column, max_val: float) -> tuple[Column, Column]:
    """PRJ-9: sin/cos(2*pi*x/max)."""
    ang = F.lit(2 * math.pi) * col(c) / F.lit(float(max_val))
    return F.sin(ang), F.cos(ang)


def half_up(c: str | Column, d: int = 6) -> Column:
    """Round half up as plain double arithmetic, floor(x*10^d + 0.5)/10^d, so that any engine doing
    the same IEEE operations publishes the same digits. Values are first snapped to the 10^-(d+3)
    grid, so last-bit differences from summation order cannot decide an exact decimal tie."""
    x = col(c)
    fine, scale = float(10.0 ** (d + 3)), float(10.0 ** d)
    snapped = F.when(F.abs(x) * F.lit(fine) < F.lit(1e17), F.floor(x * F.lit(fine) + F.lit(0.5)).cast("double") / F.lit(fine)) \
        .otherwise(x)
    return F.when(F.abs(snapped) * F.lit(scale) < F.lit(1e17),
                  F.floor(snapped * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)).otherwise(F.round(x, d))


# Decades handled by the publication rounding.
POW10_LO, POW10_HI = -300, 307


def _pow10(idx: Column) -> Column:
    """10**idx as the correctly rounded double of the decimal text '1e<idx>' (the same value a
    literal 1e<idx> parses to, in any engine)."""
    return F.concat(F.lit("1e"), idx.cast("int").cast("string")).cast("double")


def finite(x: Column) -> Column:
    return ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))


def factor_parts(x: Column) -> tuple[Column, Column]:
    """A factor as (m, e), x = m * 2**e with |m| about 1: the product of many m stays in the range of doubles where that of
    the factors leaves it on the way. Factors that have no such form (0, infinities, NaN) are their own m."""
    e = F.when(finite(x) & (x != 0), F.greatest(F.least(F.round(F.log2(F.abs(x))), F.lit(1000.0)), F.lit(-1000.0)))
    e = F.when(x.isNotNull(), F.coalesce(e, F.lit(0.0)))
    return x * F.pow(F.lit(2.0), -e), e


def product_of_parts(m: Column, e: Column, direct: Column) -> Column:
    """The product from the product ``m`` and the sum ``e`` of its factors' parts: infinite or 0 only where the product
    itself is beyond doubles, and else the same double as ``direct``, the product of the factors where that has kept in
    range. ``direct`` is taken where m has left the range."""
    third = F.greatest(F.least(e, F.lit(2100.0)), F.lit(-2100.0))
    steps = [F.floor(third / 3), F.floor(third / 3), third - 2 * F.floor(third / 3)]
    out = m
    for k in steps:
        out = out * F.pow(F.lit(2.0), k.cast("double"))
    return F.when(finite(m) & (m != 0), out).otherwise(F.nanvl(direct, m))


def product(x: Column) -> Column:
    """Aggregate: the product of ``x``, whatever the order of the rows (``product_of_parts``)."""
    m, e = factor_parts(x)
    return product_of_parts(F.product(m), F.sum(e), F.product(x))


def _decade(a: Column) -> Column:
    """First guess of the decade of ``a`` >= 0, held within the handled range before it is narrowed to INT: that of
    an infinity is beyond any INT."""
    return F.least(F.greatest(F.floor(F.log10(a)), F.lit(-30)), F.lit(POW10_HI - 1)).cast("int")


def _as_is(x: Column) -> Column:
    """Values without digits to round."""
    return x.isNull() | (x == 0) | ~finite(x)


def publish(c: str | Column, decimals: int = 6, digits: int = 10) -> Column:
    """Publication rounding: ``decimals`` decimal places but at most ``digits`` significant digits.
    The decade k comes from log10 and is corrected against exact powers of ten; the value is snapped
    to 3 finer places and then rounded half up, all as plain double arithmetic, so engines that
    compute the same value up to last-bit noise publish the same digits. Infinities and NaN, which
    compounding reaches on long series, are published as they are."""
    x = col(c)
    a = F.abs(x)
    k0 = _decade(a)
    k = (F.when(a < _pow10(k0), k0 - 1).when(a >= _pow10(k0 + 1), k0 + 1).otherwise(k0))
    d = F.least(F.lit(decimals), F.lit(digits - 1) - k)
    fine, scale = _pow10(d + 3), _pow10(d)
    snapped = F.floor(x * fine + F.lit(0.5)).cast("double") / fine
    return F.when(_as_is(x), x).otherwise(F.floor(snapped * scale + F.lit(0.5)).cast("double") / scale)


def publish_frame(df, specs: dict[str, tuple[int, int]]):
    """``publish`` applied to many columns of ``df`` in staged projections (decade, then places,
    then the value), so each piece is computed once per value. ``specs``: column -> (decimals, digits)."""
    names = list(specs)
    tmp = {c: f"__p{i}" for i, c in enumerate(names)}
    x = df.select("*", *[F.abs(F.col(c)).alias(f"{tmp[c]}_a") for c in names])
    x = x.select("*", *[_decade(F.col(f"{tmp[c]}_a")).alias(f"{tmp[c]}_k0") for c in names])
    x = x.select("*", *[(lambda a, k0: F.when(a < _pow10(k0), k0 - 1).when(a >= _pow10(k0 + 1), k0 + 1)
                         .otherwise(k0))(F.col(f"{tmp[c]}_a"), F.col(f"{tmp[c]}_k0")).alias(f"{tmp[c]}_k") for c in names])
    x = x.select("*", *[F.least(F.lit(specs[c][0]), F.lit(specs[c][1] - 1) - F.col(f"{tmp[c]}_k")).alias(f"{tmp[c]}_d")
                        for c in names])
    x = x.select("*", *[_pow10(F.col(f"{tmp[c]}_d") + 3).alias(f"{tmp[c]}_f") for c in names],
                 *[_pow10(F.col(f"{tmp[c]}_d")).alias(f"{tmp[c]}_s") for c in names])
    x = x.select("*", *[(F.floor(F.col(c) * F.col(f"{tmp[c]}_f") + F.lit(0.5)).cast("double") / F.col(f"{tmp[c]}_f"))
                        .alias(f"{tmp[c]}_n") for c in names])
    out = []
    for col_name in df.columns:
        if col_name in specs:
            t = tmp[col_name]
            v = F.col(col_name)
            out.append(F.when(_as_is(v), v).otherwise(
                F.floor(F.col(f"{t}_n") * F.col(f"{t}_s") + F.lit(0.5)).cast("double") / F.col(f"{t}_s")).alias(col_name))
        else:
            out.append(F.col(col_name))
    return x.select(*out)


def sig_round(c: str | Column, digits: int = 10) -> Column:
    """Round to ``digits`` significant digits (no decimal cap)."""
    return publish(c, 400, digits)
