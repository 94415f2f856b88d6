"""Labels: W2 forward value over trading-day positions, F1 clipped returns,
F2 availability flags, A6 last-wins dedupe.

"h days ahead" means the calendar position idx+h, not the h-th next price
row: a suspended stock has no row on some days, and ``lead(h)`` would skip
over them.  A range frame ``[idx+h, idx+h]`` over the calendar index finds
exactly that day or nothing.

Plan: the grid rows and the full price history are stacked and sorted once
per key; every horizon is a frame over the same window, so all horizons cost
one Exchange and one Sort.  Each key holds at most one price row and one grid
row per trading day, so a window partition is bounded by the calendar.

A day without a price of its own has no label, so of a whole grid
(``universe``) only the price rows and one row per entity are hashed and
sorted, and the grid's rows follow by spans of days
(:mod:`pitlake.operators.spans`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pitlake.functions.scalar import label_na, return_bps
from pitlake.operators.calendar import calendar_index, distinct_dates
from pitlake.operators.grid import base_grid
from pitlake.operators.spans import days_of, spread

HORIZONS = (1, 5, 20)


def dedupe_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the last one by ``order`` (the reference keeps the
    last row in file order; an explicit order column makes that repeatable).

    ``max_by`` over a struct is a partial aggregate, so duplicates collapse
    map-side before the shuffle even for a hot key.  Of the other columns only
    ``cols`` are kept and shuffled (None: all).
    """
    rest = [c for c in df.columns if c not in keys and (cols is None or c in cols)]
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in rest])
    ordk = F.struct(*[F.col(f"`{c}`") for c in order])
    return (df.groupBy(*keys).agg(F.max_by(row, ordk).alias("__r"))
            .select(*keys, *[F.col(f"__r.`{c}`").alias(c) for c in rest]))


def price_rows(prices: DataFrame, price_col: str, order: Sequence[str] | None, key: str = "ticker", date: str = "date") -> DataFrame:
    """key, day and ``__px`` of every price; with ``order`` the last by it of
    each key and day (A6)."""
    px = prices.select(key, F.col(date).cast("date").alias(date), F.col(price_col).cast("double").alias("__px"),
                       *[F.col(f"`{c}`").alias(f"__o{i}") for i, c in enumerate(order or [])])
    px = px.where(F.col(date).isNotNull())
    if order:
        px = dedupe_last(px, [key, date], [f"__o{i}" for i in range(len(order))], cols=["__px"])
    return px.select(key, date, "__px")


def price_at(window, h: int) -> Column:
    """The price ``h`` trading days ahead; the query fails on two different rows for that day."""
    frame = window.rangeBetween(h, h)
    msg = F.lit("several prices for one key and day; give their order")
    return F.when(F.count("__px").over(frame) > 1, F.raise_error(msg).cast("double")).otherwise(F.max("__px").over(frame))


def forward_labels(grid: DataFrame, prices: DataFrame, calendar: DataFrame, price_col: str,
                   horizons: Sequence[int] = HORIZONS, clip: float | None = 2000.0,
                   base_col: str | None = None, key: str = "ticker", date: str = "date",
                   keep: Sequence[str] = (), price_order: Sequence[str] | None = None,
                   universe: DataFrame | None = None, days: DataFrame | None = None) -> DataFrame:
    """W2 + F1 + F2: ``r_{h}d`` (bps, clipped) and ``label_na_{h}d`` per grid row.

    ``prices`` is the full price history; of several rows for one (key, date)
    the last by ``price_order`` counts, and without an order the query fails
    on them.  Forward prices are looked up there, not in the windowed grid,
    so the last grid days keep their labels.  NaN prices are missing prices.  The base price is ``base_col`` of the grid when given (the
    gold feature column), else the price on the row's own date.  Rows whose
    date is not a trading day get NA for every horizon.

    ``universe`` states that ``grid`` is ``base_grid(universe, calendar)``,
    uncut; its rows are then made after the window instead of shuffled: the
    same rows.  ``base_col`` and ``keep`` need the grid's rows themselves.
    ``days`` are the grid's own days, if they are not the calendar's: it then
    is ``base_grid(universe, days)``.
    """
    if universe is not None and not base_col and not keep:
        px = price_rows(prices, price_col, price_order, key, date)
        rows = _by_spans(universe, calendar, px, horizons, clip, key, date)
        return rows if days is None else _on_days(rows, universe, calendar, days, horizons, key, date)
    cal = F.broadcast(calendar_index(calendar))   # one row per trading day
    g = grid.select(key, F.col(date).cast("date").alias(date), *keep,
                    *([F.col(base_col).alias("__p0")] if base_col else []))
    g = g.join(cal, date, "left")
    px = price_rows(prices, price_col, price_order, key, date).join(cal, date, "inner")
    lcols = [date, *keep] + (["__p0"] if base_col else [])
    ltype = g.select(F.struct(*lcols).alias("s")).schema["s"].dataType
    stacked = (g.select(key, "idx", F.lit(None).cast("double").alias("__px"), F.struct(*lcols).alias("__l"))
               .unionByName(px.select(key, "idx", "__px", F.lit(None).cast(ltype).alias("__l"))))
    w = W.partitionBy(key).orderBy("idx")
    fwd = {h: price_at(w, h) for h in horizons}
    p0 = F.col("__l.__p0") if base_col else price_at(w, 0)
    looked = (stacked.select(key, "idx", "__l", p0.alias("__p0v"),
                             *[fwd[h].alias(f"__p{h}") for h in horizons])
              .where(F.col("__l").isNotNull()))
    known = F.col("idx").isNotNull()
    out = [F.col(key), F.col(f"__l.{date}").alias(date), *[F.col(f"__l.`{c}`").alias(c) for c in keep]]
    for h in horizons:
        ph = F.col(f"__p{h}")
        p = F.when(known, F.col("__p0v"))
        out.append(return_bps(p, ph, clip).alias(f"r_{h}d"))
        out.append(label_na(p, ph, known).alias(f"label_na_{h}d"))
    return looked.select(*out)


def _by_spans(universe: DataFrame, calendar: DataFrame, px: DataFrame, horizons: Sequence[int], clip: float | None,
              key: str, date: str) -> DataFrame:
    """Labels of the whole grid from its price rows: NA on the days after a price row, up to the next."""
    feed = px.toDF("__k", "__d", "__px").join(days_of(calendar), "__d").drop("__d")
    ahead = W.partitionBy("__k").orderBy("__i")
    states = {f"__f{h}": price_at(ahead, h) for h in dict.fromkeys([0, *horizons])}
    p0, out = F.when(F.col("__first"), F.col("__f0")), []
    for h in horizons:
        ph = F.col(f"__f{h}")
        out += [return_bps(p0, ph, clip).alias(f"r_{h}d"), label_na(p0, ph).alias(f"label_na_{h}d")]
    return spread(universe, calendar, [feed], states, key=key, date=date).select(key, date, *out)


def _on_days(rows: DataFrame, universe: DataFrame, calendar: DataFrame, days: DataFrame, horizons: Sequence[int],
             key: str, date: str) -> DataFrame:
    """``rows`` of the trading days among ``days``, and NA on the others, which are made without a shuffle."""
    of_grid = distinct_dates(days)
    closed = of_grid.join(F.broadcast(distinct_dates(calendar)), "date", "left_anti")
    na = [c for h in horizons for c in (F.lit(None).cast("double").alias(f"r_{h}d"), F.lit(1).alias(f"label_na_{h}d"))]
    off = base_grid(universe, closed, key=key).select(key, F.col("date").alias(date), *na)
    kept = rows.join(F.broadcast(of_grid.withColumnRenamed("date", date)), date, "left_semi").select(*rows.columns)
    return kept.unionByName(off)
