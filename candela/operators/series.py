"""Layout of ordered per-symbol series across tasks.

A bar table may hold one symbol with a third of all rows, so no operator here partitions by ``symbol``
alone. Instead every series carries

* ``rn``   - 0-based position of the row inside its symbol (dense, ordered by ``bar_ts``);
* ``_blk`` - ``rn // B`` with ``B = spark.candela.blockRows`` (a power of two).

Finite-frame windows run per ``(symbol, _blk)`` after copying the last ``back`` rows of the previous
block (and the first ``fwd`` rows of the next) into each block as halo rows (``halo_stage``).
Unbounded running frames (cumulative sum/product, forward fill, running max) run per block and add a
carry computed on a block-level table that is ``1/B`` of the data (``running``). Wilder/EWMA
recurrences are a blocked affine scan whose carries travel by equi-join (``affine_scan``); one that
skips rows composes affine maps (``affine_map_scan``). Rows that leave a series are compacted by
per-block counts (``compact``).
Every step is a DataFrame window, aggregate or join, so Spark partitions and retries the work.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.functions.scalar import factor_parts, product_of_parts
from candela.session import BLOCK_ROWS_KEY, BUCKET_SECONDS_KEY, materialize, setting

RN = "rn"
BLK = "_blk"
KEYS = ("symbol",)
_UNB = Window.unboundedPreceding


def block_rows(df: DataFrame) -> int:
    b = max(2, setting(df.sparkSession, BLOCK_ROWS_KEY, 1 << 16))
    return 1 << int(math.floor(math.log2(b)))  # power of two so scan sub-blocks nest in blocks


def index_series(df: DataFrame, keys: Sequence[str] = KEYS, order: str = "bar_ts") -> DataFrame:
    """Add ``rn`` and ``_blk`` without sorting a whole symbol in one task.

    Rows are numbered inside time buckets (``spark.candela.bucketSeconds``); a per-bucket count table
    (one row per symbol and bucket) gives each bucket its offset. ``(keys, order)`` must be unique.
    """
    keys = list(keys)
    b = block_rows(df)
    secs = setting(df.sparkSession, BUCKET_SECONDS_KEY, 30 * 86400)
    tb = df.withColumn("_tb", F.floor(F.unix_seconds(F.col(order).cast("timestamp")) / F.lit(secs)))
    wb = Window.partitionBy(*keys, "_tb")
    tb = (tb.withColumn("_lrn", F.row_number().over(wb.orderBy(order)) - 1)
          .withColumn("_cnt", F.count(F.lit(1)).over(wb)))
    # the bucket table comes from the same windowed frame, so both branches share one exchange and
    # the input (often an aggregation of ticks) is evaluated once
    counts = tb.groupBy(*keys, "_tb").agg(F.max("_cnt").alias("_cnt"))
    offs = counts.select(
        *keys, "_tb",
        F.coalesce(F.sum("_cnt").over(Window.partitionBy(*keys).orderBy("_tb").rowsBetween(_UNB, -1)),
                   F.lit(0)).alias("_off"))
    out = tb.join(offs, on=[*keys, "_tb"], how="inner")
    out = out.withColumn(RN, (F.col("_off") + F.col("_lrn")).cast("long"))
    out = out.withColumn(BLK, F.floor(F.col(RN) / F.lit(b)).cast("long")).drop("_tb", "_lrn", "_off", "_cnt")
    return materialize(out)


def reindex(df: DataFrame, keys: Sequence[str] = KEYS, order: str = "bar_ts") -> DataFrame:
    """Renumber after a filter that removed rows from the middle of a series."""
    return index_series(df.drop(RN, BLK), keys, order)


def dropna_dense(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """Drop rows missing any of ``cols`` and keep positions dense (``compact``)."""
    if RN not in df.columns:
        return df.dropna(subset=list(cols))
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull()
    return compact(df, ok, keys)


def compact(df: DataFrame, keep: Column, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows where ``keep`` holds, renumbered in order: ``rn`` is 0 at the first kept row of a series and has no gaps,
    whichever rows went. A row's new position is the number of kept rows in the blocks before (a table of one row per
    block) plus its place among the kept rows of its block. Nothing runs while the plan is composed."""
    keys, b = list(keys), block_rows(df)
    marked = df.withColumn("_keep", F.coalesce(keep, F.lit(False)))
    counts = marked.filter("_keep").groupBy(*keys, BLK).agg(F.count(F.lit(1)).alias("_kept"))
    before = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(_UNB, -1)
    counts = counts.select(*keys, BLK, F.coalesce(F.sum("_kept").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(*keys, BLK).orderBy(RN)) - 1
    out = marked.filter("_keep").drop("_keep").join(counts, [*keys, BLK]).withColumn(RN, (F.col("_before") + place).cast("long"))
    return out.withColumn(BLK, F.floor(F.col(RN) / F.lit(b)).cast("long")).drop("_before")


def halo_stage(df: DataFrame, build: Callable[[DataFrame, Window], DataFrame], back: int, fwd: int = 0,
               keys: Sequence[str] = KEYS) -> DataFrame:
    """Run ``build(df, w)`` where ``w`` orders rows by ``rn`` inside a block plus halo rows.

    Window frames used by ``build`` may reach at most ``back`` rows back and ``fwd`` rows ahead; the
    results are exact for every home row. Cost: one shuffle on ``(keys, block)`` and ``(back+fwd)/B``
    duplicated rows.
    """
    keys = list(keys)
    b = block_rows(df)
    rn = F.col(RN)
    lo = F.greatest(F.floor((rn - F.lit(fwd)) / F.lit(b)), F.lit(0)).cast("long")
    hi = F.floor((rn + F.lit(back)) / F.lit(b)).cast("long")
    x = df.withColumn("_wblk", F.explode(F.sequence(lo, hi)))
    x = x.withColumn("_home", F.col("_wblk") == F.col(BLK))
    w = Window.partitionBy(*keys, "_wblk").orderBy(RN)
    x = build(x, w)
    return x.filter(F.col("_home")).drop(BLK, "_home").withColumnRenamed("_wblk", BLK)


def rows_frame(w: Window, n: int) -> Window:
    """The last ``n`` rows up to and including the current one."""
    return w.rowsBetween(-(n - 1), 0)


# --- unbounded running frames -------------------------------------------------------------------

_LOCAL = {
    "sum": lambda c: F.sum(c),
    "product": lambda c: F.product(c),
    "max": lambda c: F.max(c),
    "min": lambda c: F.min(c),
    "last": lambda c: F.last(c, ignorenulls=True),
}


def _combine(op: str, local: Column, carry: Column) -> Column:
    if op == "sum":
        return F.coalesce(local + carry, local, carry)
    if op == "product":
        return F.coalesce(local * carry, local, carry)
    if op == "max":
        return F.greatest(local, carry)
    if op == "min":
        return F.least(local, carry)
    return F.coalesce(local, carry)


def running(df: DataFrame, specs: Sequence[tuple[str | Column, str, str]], keys: Sequence[str] = KEYS) -> DataFrame:
    """Cumulative ``sum``/``product``/``max``/``min``/``last`` (forward fill) over ``rn``, per key.

    ``specs`` is a list of ``(input, op, output)``. Several columns share one block table and one join.
    NULL inputs are skipped; an output is NULL until the first non-NULL input (pandas ``cum*`` and
    ``ffill`` semantics for leading gaps). A product that leaves the range of doubles comes back when it does
    (``scalar.product_of_parts``).
    """
    keys = list(keys)
    cols, parts, products = [], {}, []
    for i, (src, op, out) in enumerate(specs):
        c = F.col(src) if isinstance(src, str) else src
        cols.append((f"_rin{i}", c, op, f"_rout{i}" if op == "product" else out))
        if op == "product":
            parts[f"_rin{i}m"], parts[f"_rin{i}e"] = factor_parts(F.col(f"_rin{i}").cast("double"))
            products.append((f"_rout{i}", out))
    x = df.withColumns({name: c for name, c, _, _ in cols})
    x = materialize(x)
    if products:
        x = x.withColumns(parts)
        cols += [(f"_rin{r[5:]}{k}", None, op, f"{r}{k}") for r, _ in products for k, op in (("m", "product"), ("e", "sum"))]
    wloc = Window.partitionBy(*keys, BLK).orderBy(RN).rowsBetween(_UNB, 0)
    block_aggs = []
    for name, _, op, _ in cols:
        if op == "last":
            block_aggs.append(F.max_by(F.col(name), F.when(F.col(name).isNotNull(), F.col(RN))).alias(f"{name}_t"))
        else:
            block_aggs.append(_LOCAL[op](F.col(name)).alias(f"{name}_t"))
    blocks = x.groupBy(*keys, BLK).agg(*block_aggs)
    wblk = Window.partitionBy(*keys).orderBy(BLK).rowsBetween(_UNB, -1)
    blocks = blocks.select(*keys, BLK, *[_LOCAL[op](F.col(f"{name}_t")).over(wblk).alias(f"{name}_c")
                                         for name, _, op, _ in cols])
    x = x.join(blocks, on=[*keys, BLK], how="left")
    for name, _, op, out in cols:
        x = x.withColumn(out, _combine(op, _LOCAL[op](F.col(name)).over(wloc), F.col(f"{name}_c")))
    for r, out in products:
        x = x.withColumn(out, product_of_parts(F.col(f"{r}m"), F.col(f"{r}e"), F.col(r)))
    return x.drop(*[n for n, *_ in cols], *[f"{n}_c" for n, *_ in cols], *[f"{r}{k}" for r, _ in products for k in ("", "m", "e")])


# --- affine recurrence y_t = a * y_{t-1} + c_t --------------------------------------------------

def _sub_block(a: float, b: int) -> int:
    """Largest power of two with ``Bs * ln(1/a) <= 300`` (no overflow of ``a**-j``), capped at B."""
    if a <= 0.0:
        return 1
    lim = 300.0 / math.log(1.0 / a)
    bs = 1
    while bs * 2 <= min(lim, b):
        bs *= 2
    return bs


def affine_scan(df: DataFrame, specs: Sequence[tuple[str | Column, float, str]], keys: Sequence[str] = KEYS) -> DataFrame:
    """For each ``(contrib, a, out)``: ``out_t = sum_{k<=t} a**(t - k) * contrib_k`` per key, along ``rn``.

    Rows are split into sub-blocks of ``Bs`` positions (``Bs * ln(1/a) <= 300`` so ``a**-j`` cannot
    overflow). Inside a sub-block the sum is a running window sum of ``contrib * a**-j`` rescaled by
    ``a**j``; the value entering a sub-block is the decayed sum of the previous sub-blocks' end
    values, shipped forward by an explode + groupBy and one equi-join (no window over a whole
    symbol). Sub-blocks further back than a decay of 1e-300 contribute nothing in double precision
    and are not shipped. All specs share one sub-block table and one join.
    """
    keys = list(keys)
    b = block_rows(df)
    items = []
    for i, (contrib, a, out) in enumerate(specs):
        if not (0.0 < a < 1.0):
            raise ValueError("affine_scan needs 0 < a < 1")
        c = F.col(contrib) if isinstance(contrib, str) else contrib
        items.append((f"_c{i}", c, math.log(a), out))
    bs = min(_sub_block(math.exp(la), b) for _, _, la, _ in items)
    hops = max(max(1, math.ceil(690.0 / (bs * -la))) for _, _, la, _ in items)
    x = df.withColumns({name: F.coalesce(c.cast("double"), F.lit(0.0)) for name, c, _, _ in items})
    x = materialize(x)
    x = x.withColumn("_sb", F.floor(F.col(RN) / F.lit(bs)).cast("long"))
    x = x.withColumn("_j", (F.col(RN) - F.col("_sb") * F.lit(bs)).cast("double"))
    wsb = Window.partitionBy(*keys, BLK, "_sb").orderBy(RN).rowsBetween(_UNB, 0)
    # end value of each sub-block, as if the sub-block were alone
    ends = x.groupBy(*keys, "_sb").agg(
        *[F.sum(F.col(name) * F.exp(F.lit(la) * (F.lit(bs - 1) - F.col("_j")))).alias(f"{name}_e")
          for name, _, la, _ in items])
    hop = F.explode(F.sequence(F.lit(1), F.lit(hops))).alias("_h")
    carry = (ends.select(*keys, "_sb", *[f"{n}_e" for n, *_ in items], hop)
             .select(*keys, (F.col("_sb") + F.col("_h")).alias("_sb"),
                     *[(F.col(f"{name}_e") * F.exp(F.lit(la * bs) * (F.col("_h") - F.lit(1)))).alias(f"{name}_v")
                       for name, _, la, _ in items])
             .groupBy(*keys, "_sb").agg(*[F.sum(f"{n}_v").alias(f"{n}_k") for n, *_ in items]))
    x = x.join(carry, on=[*keys, "_sb"], how="left")
    for name, _, la, out in items:
        local = F.exp(F.lit(la) * F.col("_j")) * F.sum(F.col(name) * F.exp(F.lit(-la) * F.col("_j"))).over(wsb)
        x = x.withColumn(out, local + F.coalesce(F.col(f"{name}_k"), F.lit(0.0)) * F.exp(F.lit(la) * (F.col("_j") + 1)))
    return x.drop("_sb", "_j", *[n for n, *_ in items], *[f"{n}_k" for n, *_ in items])


# --- recurrence of affine maps y_t = m_t * y_{t-1} + c_t, m_t = a or 1 ----------------------------

FOLD = 4096


def affine_map_scan(df: DataFrame, specs: Sequence[tuple[str | Column, float, str | Column, str]], keys: Sequence[str] = KEYS) -> DataFrame:
    """For each ``(contrib, a, decays, out)``: ``out_t = m_t * out_{t-1} + contrib_t``, where the map's factor ``m_t`` is
    ``a`` on rows where ``decays`` holds and 1 elsewhere, so with contrib 0 such a row is the identity.

    A run of rows composes to one affine map (its decays' product, its own value from 0). Rows are split into sub-blocks by
    position, whatever their maps are, so a series of identities is spread like any other. Inside a sub-block the number of
    decays so far takes the place of the position of ``affine_scan``; the sub-blocks' maps are composed in order by folds
    over arrays of at most ``FOLD`` maps, level by level, and give the value that enters each sub-block. All specs
    (one per state, each with a decay of its own) share one windowed pass, one map table and one join.
    """
    keys, b = list(keys), block_rows(df)
    items = []
    for i, (contrib, a, decays, out) in enumerate(specs):
        if not (0.0 < a < 1.0):
            raise ValueError("affine_map_scan needs 0 < a < 1")
        c, m = (F.col(v) if isinstance(v, str) else v for v in (contrib, decays))
        items.append((i, F.coalesce(c.cast("double"), F.lit(0.0)), math.log(a), F.coalesce(m, F.lit(False)).cast("int"), out))
    bs = min(_sub_block(math.exp(la), b) for _, _, la, _, _ in items)
    x = df.withColumns({f"_c{i}": c for i, c, _, _, _ in items} | {f"_m{i}": m for i, _, _, m, _ in items})
    x = x.withColumn("_sb", F.floor(F.col(RN) / F.lit(bs)).cast("long"))
    w = Window.partitionBy(*keys, BLK, "_sb").orderBy(RN).rowsBetween(_UNB, 0)
    x = x.withColumns({f"_m{i}": F.sum(f"_m{i}").over(w) for i, *_ in items})
    x = x.withColumns({f"_c{i}": F.exp(F.lit(la) * F.col(f"_m{i}")) * F.sum(F.col(f"_c{i}") * F.exp(F.lit(-la) * F.col(f"_m{i}"))).over(w)
                       for i, _, la, _, _ in items})
    x = materialize(x)
    states = F.array(*[F.struct(F.exp(F.lit(la) * F.col(f"_m{i}")).alias("f"), F.col(f"_c{i}").alias("v")) for i, _, la, _, _ in items])
    maps = x.groupBy(*keys, "_sb").agg(F.max_by(states, F.col(RN)).alias("_map"))
    entry = _entries(materialize(maps), keys, len(items))
    x = x.join(entry, [*keys, "_sb"], "left")
    y = {out: F.col(f"_c{i}") + F.exp(F.lit(la) * F.col(f"_m{i}")) * F.coalesce(F.get("_in", F.lit(i)), F.lit(0.0)) for i, _, la, _, out in items}
    return x.withColumns(y).drop("_sb", "_in", *[f"_c{i}" for i, *_ in items], *[f"_m{i}" for i, *_ in items])


def _entries(maps: DataFrame, keys: list[str], n: int) -> DataFrame:
    """maps (keys, ``_sb``, ``_map``: factor f and value v of n states) -> the n values that enter each sub-block."""
    zero = F.array_repeat(F.lit(0.0), n)

    def through(state: Column, m: Column) -> Column:
        return F.zip_with(state, m["_map"], lambda y, z: z["f"] * y + z["v"])

    def walk(start: Column) -> Column:
        """(_sb, value entering it) of a group's maps."""
        first = F.struct(start.alias("y"), F.array().cast(f"array<struct<_sb:bigint,_in:array<double>>>").alias("out"))
        return F.aggregate("_maps", first, lambda s, m: F.struct(through(s["y"], m).alias("y"), F.concat(
            s["out"], F.array(F.struct(m["_sb"].alias("_sb"), s["y"].alias("_in")))).alias("out")), lambda s: s["out"])

    listed = F.array_sort(F.collect_list(F.struct("_sb", "_map"))).alias("_maps")
    if (maps.agg(F.max("_sb")).first()[0] or 0) < FOLD:
        return maps.groupBy(*keys).agg(listed).select(*keys, F.explode(walk(zero)).alias("_e")).select(*keys, "_e.*")
    groups = materialize(maps.groupBy(*keys, F.floor(F.col("_sb") / FOLD).cast("long").alias("_g")).agg(listed))
    ones = F.array_repeat(F.lit(1.0), n)
    factors = F.aggregate("_maps", ones, lambda f, m: F.zip_with(f, m["_map"], lambda a, z: a * z["f"]))
    whole = F.zip_with(factors, F.aggregate("_maps", zero, through), lambda f, v: F.struct(f.alias("f"), v.alias("v")))
    above = _entries(materialize(groups.select(*keys, F.col("_g").alias("_sb"), whole.alias("_map"))), keys, n)
    joined = groups.join(above.select(*keys, F.col("_sb").alias("_g"), "_in"), [*keys, "_g"])
    return joined.select(*keys, F.explode(walk(F.col("_in"))).alias("_e")).select(*keys, "_e.*")


def from_pos(w: Window, k: int) -> Column:
    """True when the row has at least ``k`` earlier rows in its series (0-based position >= k).
    Needs a halo of ``k`` rows."""
    if k <= 0:
        return F.lit(True)
    return F.count(F.lit(1)).over(w.rowsBetween(-k, 0)) == k + 1


def at_pos(w: Window, k: int) -> Column:
    """True only for the row at 0-based position ``k`` of its series. Needs a halo of ``k + 1`` rows."""
    return from_pos(w, k) & ~from_pos(w, k + 1)
