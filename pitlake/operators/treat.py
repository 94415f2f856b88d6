"""Declared feature treatments D1-D5 and W4.

The reference declares these in its feature schema but never runs them;
they are built here as plain column/window operations.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from pitlake.operators.joins import AsofSource, asof_join, lineage_name
from pitlake.operators.quantiles import exact_quantiles
from pitlake.operators.slices import hot_keys, tag

# --- fixed values: declared feature schema (name, dtype, missing strategy, winsorize bounds) ---
FEATURE_SCHEMA = (
    ("open", "float64", "keep_nan", None),
    ("high", "float64", "keep_nan", None),
    ("low", "float64", "keep_nan", None),
    ("close", "float64", "keep_nan", None),
    ("volume", "float64", "keep_nan", None),
    ("amount", "float64", "keep_nan", (0.001, 0.999)),
    ("turnover", "float64", "keep_nan", None),
    ("adj_close_hfq", "float64", "keep_nan", None),
    ("is_member", "int8", "fill_zero", None),
    ("is_suspended", "int8", "fill_zero", None),
)

# --- fixed values: split boundaries (start, end) ---
SPLITS = (
    ("train", "2019-12-30", "2024-01-01"),
    ("validation", "2024-01-03", "2025-01-01"),
    ("test", "2025-01-01", "2025-08-15"),
)


def _clip(c: Column, lo, hi) -> Column:
    """Guarded clip: null stays null (``greatest``/``least`` skip nulls)."""
    v = c
    if hi is not None:
        v = F.least(F.lit(float(hi)), v)
    if lo is not None:
        v = F.greatest(F.lit(float(lo)), v)
    return F.when(c.isNotNull(), v)


def winsorize_bounds(df: DataFrame, bounds: Mapping[str, tuple[float, float]], exact: bool = True,
                     accuracy: int = 10_000) -> dict[str, tuple]:
    """Quantile bounds per column (exact by digit selection, or sketch)."""
    cols = list(bounds)
    if exact:
        probs = sorted({p for b in bounds.values() for p in b})
        # the counting passes read only these columns: persist that projection
        # (memory, spilling to disk) unless the input is cached already
        src = df if df.is_cached else df.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            qs = exact_quantiles(src, cols, probs)
        finally:
            if src is not df:
                src.unpersist()
        return {c: (qs[(c, bounds[c][0])], qs[(c, bounds[c][1])]) for c in cols}
    row = df.agg(*[F.percentile_approx(F.col(c), list(bounds[c]), accuracy).alias(c) for c in cols]).first()
    return {c: tuple(row[c]) if row[c] is not None else (None, None) for c in cols}


def winsorize(df: DataFrame, bounds: Mapping[str, tuple[float, float]], fit_on: DataFrame | None = None,
              exact: bool = True, suffix: str = "") -> DataFrame:
    """Clip each column to its [lower, upper] quantiles.

    ``fit_on`` (e.g. the train split) fits the bounds on other rows than the
    ones clipped, which keeps validation/test statistics out of training.
    The bounds are two numbers per column; clipping is a map-only projection.
    """
    fitted = winsorize_bounds(fit_on if fit_on is not None else df, bounds, exact)
    out = []
    for c in df.columns:
        if c in fitted:
            lo, hi = fitted[c]
            clipped = _clip(F.col(c), lo, hi)
            out += [F.col(c), clipped.alias(c + suffix)] if suffix else [clipped.alias(c)]
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def fill_missing(df: DataFrame, strategies: Mapping[str, str], by: str = "ticker",
                 order: str = "date") -> DataFrame:
    """Per column ``keep_nan`` (no-op), ``fill_zero`` or ``forward_fill``."""
    ff = [c for c, s in strategies.items() if s == "forward_fill" and c in df.columns]
    out = df
    if ff:
        out = ffill(out, ff, by, order)
    zero = {c for c, s in strategies.items() if s == "fill_zero" and c in df.columns}
    for c, s in strategies.items():
        if s not in ("keep_nan", "fill_zero", "forward_fill"):
            raise ValueError(f"unknown missing strategy {s!r} for {c}")
    return out.select(*[F.coalesce(F.col(c), F.lit(0).cast(out.schema[c].dataType)).alias(c) if c in zero
                        else F.col(f"`{c}`") for c in out.columns])


def ffill(df: DataFrame, cols: Sequence[str], by: str = "ticker", order: str = "date",
          split: str | None = None) -> DataFrame:
    """Carry each column's last non-null value forward within ``by``.

    One window (one Exchange on ``by``) serves all columns; in a panel a key
    holds one row per trading day, so partitions are bounded by the calendar.
    ``split`` (a ``date_trunc`` unit) partitions by (key, period) instead and
    seeds each period with the last non-null value of earlier periods, for
    frames where one key may hold a large share of all rows.  ``"rows"`` cuts
    such keys at quantiles of their own times (as in ``asof_join``); rows of
    one time stay together, as each may fill the next.
    """
    cols = [c for c in cols if c in df.columns]
    if split == "rows":
        return _ffill_sliced(df, cols, by, order)
    if split is None:
        w = W.partitionBy(by).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
        return df.select(*[F.last(F.col(c), ignorenulls=True).over(w).alias(c) if c in cols else F.col(f"`{c}`")
                           for c in df.columns])
    per = F.date_trunc(split, F.col(order))
    tagged = df.withColumn("__P", per)
    # last non-null value per (key, period) -- partial aggregates, bounded by periods
    last = tagged.groupBy(by, "__P").agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order)))
                                           .alias(f"__l{i}") for i, c in enumerate(cols)])
    wp = W.partitionBy(by).orderBy("__P").rowsBetween(W.unboundedPreceding, -1)
    carry = last.select(by, "__P", *[F.last(f"__l{i}", ignorenulls=True).over(wp).alias(f"__c{i}")
                                     for i in range(len(cols))])
    w = W.partitionBy(by, "__P").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = tagged.join(carry, [by, "__P"], "left")
    return joined.select(*[F.coalesce(F.last(F.col(c), ignorenulls=True).over(w), F.col(f"__c{cols.index(c)}")).alias(c)
                           if c in cols else F.col(f"`{c}`") for c in df.columns])


def _ffill_sliced(df: DataFrame, cols: Sequence[str], by: str, order: str) -> DataFrame:
    """W4 with hot keys cut by rows.  The carried values are one row per slice
    of a hot key, fewer than two a task, and so are broadcast."""
    hot = hot_keys(df, by, order)
    tagged = tag(df, hot, by, order).drop("__n")
    cs = range(len(cols))
    each = (tagged.join(F.broadcast(hot.select("__h")), F.col(by).eqNullSafe(F.col("__h")), "left_semi")
            .groupBy(F.col(by).alias("__k"), "__P")
            .agg(*[F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.struct("__P", order))).alias(f"__l{i}")
                   for i, c in enumerate(cols)]))
    wp = W.partitionBy("__k").orderBy("__P").rowsBetween(W.unboundedPreceding, -1)
    carry = each.select("__k", F.col("__P").alias("__Q"), *[F.last(f"__l{i}", ignorenulls=True).over(wp).alias(f"__c{i}") for i in cs])
    w = W.partitionBy(by, "__P").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    filled = tagged.withColumns({f"__f{i}": F.last(F.col(f"`{c}`"), ignorenulls=True).over(w) for i, c in enumerate(cols)})
    joined = filled.join(F.broadcast(carry), F.col(by).eqNullSafe(F.col("__k")) & (F.col("__P") == F.col("__Q")), "left")
    return joined.select(*[F.coalesce(f"__f{cols.index(c)}", f"__c{cols.index(c)}").alias(c) if c in cols else F.col(f"`{c}`")
                           for c in df.columns])


def assign_split(df: DataFrame, splits: Sequence[tuple[str, str, str]] = SPLITS, date: str = "date",
                 out: str = "split") -> DataFrame:
    """D3: split name per row: ``[start, end)`` for all but the last split,
    ``[start, end]`` for the last (inclusive ends would put a boundary day in
    two splits); dates in no split get null."""
    d = F.col(date).cast("date")
    expr = None
    for i, (name, start, end) in enumerate(splits):
        lo = F.lit(_dt.date.fromisoformat(start))
        hi = F.lit(_dt.date.fromisoformat(end))
        cond = (d >= lo) & ((d <= hi) if i == len(splits) - 1 else (d < hi))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return df.withColumn(out, expr)


def membership(df: DataFrame, universe: DataFrame, key: str = "ticker", out: str = "is_member") -> DataFrame:
    """1 when the row's key is in the universe, else 0 (fill_zero), as int8.

    The universe is reduced to its distinct keys first (partial aggregate),
    so the left join cannot fan out; AQE broadcasts it when it proves small.
    """
    u = universe.select(key).distinct().withColumn("__m", F.lit(1).cast("tinyint"))
    return df.join(u, key, "left").withColumn(out, F.coalesce(F.col("__m"), F.lit(0).cast("tinyint"))).drop("__m")


def open_spans(spans: DataFrame, key: str = "ticker", start: str = "start", end: str = "end") -> DataFrame:
    """``(key, date, n_open)``: how many spans of a key are open from that day on.

    A sweep: a span adds one on its first day and takes it away on the day after
    its last (never, if ``end`` is null).  The changes are summed per (key, day) map-side
    first, so overlapping and repeated spans cost one row a day, and one running
    sum per key gives the levels.  Spans without a start or that end before it are none.
    """
    day = lambda c: F.col(c).cast("date")
    known = spans.select(F.col(key), day(start).alias("__s"), day(end).alias("__e")).where(
        F.col(key).isNotNull() & F.col("__s").isNotNull() & (F.col("__e").isNull() | (F.col("__e") >= F.col("__s"))))
    change = lambda d, n: F.struct(d.alias("date"), F.lit(n).cast("long").alias("n"))
    after = F.when(F.col("__e").isNotNull(), change(F.date_add("__e", 1), -1))
    changes = (known.select(key, F.explode(F.array_compact(F.array(change(F.col("__s"), 1), after))).alias("c"))
               .groupBy(key, "c.date").agg(F.sum("c.n").alias("n")).where("n <> 0"))
    w = W.partitionBy(key).orderBy("date").rowsBetween(W.unboundedPreceding, W.currentRow)
    return changes.select(key, "date", F.sum("n").over(w).alias("n_open"))


def suspension(df: DataFrame, spans: DataFrame, key: str = "ticker", date: str = "date", start: str = "start",
               end: str = "end", out: str = "is_suspended", count: str | None = None, split: str | None = None) -> DataFrame:
    """1 on the rows whose day lies in one of their key's spans (both ends
    inclusive, open-ended if ``end`` is null), else 0, as int8; ``count`` also
    keeps how many spans are open.

    No range join: the levels of ``open_spans`` are joined as of the row's day
    (one window on the key; ``split`` as in ``asof_join``, for keys that hold
    a large share of all rows).  Rows without a key or day are not suspended.
    """
    levels = AsofSource("spans", open_spans(spans, key, start, end).withColumnRenamed("date", date), cols=["n_open"],
                        prefix="__", keep_date_as=None)
    n = F.coalesce(F.col(lineage_name("n_open", "spans", "__")), F.lit(0).cast("long"))
    if isinstance(df.schema[date].dataType, T.StringType):
        raise TypeError(f"{date!r} must be a date or a timestamp")
    joined = asof_join(df, levels, by=key, date=date, split=split)
    flag = F.when(n > 0, 1).otherwise(0).cast("tinyint").alias(out)
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), flag, *([n.alias(count)] if count else []))


def apply_feature_schema(df: DataFrame, feature_map: Mapping[str, str],
                         schema: Sequence[tuple] = FEATURE_SCHEMA) -> DataFrame:
    """P12 + D2 for the declared features present in ``feature_map``
    (name -> column): cast to the declared dtype, then fill per strategy."""
    types = {"float64": "double", "int8": "tinyint"}
    casts = {feature_map[n]: types[t] for n, t, _, _ in schema if n in feature_map and feature_map[n] in df.columns}
    out = df.select(*[F.col(f"`{c}`").try_cast(casts[c]).alias(c) if c in casts else F.col(f"`{c}`")
                      for c in df.columns])
    strat = {feature_map[n]: s for n, _, s, _ in schema if n in feature_map and feature_map[n] in df.columns}
    return fill_missing(out, strat)
