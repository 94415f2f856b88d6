"""Fused gold assembly: panel features and forward labels in one shuffle.

Composing J1 -> J2 -> J4 -> W2 -> J6 separately shuffles the (entity x day)
grid once per join and window.  Here every per-entity input is stacked with
the grid rows and hash-partitioned by entity once:

* grid rows (side 1),
* keyed daily sources (equality on date; must be unique per (entity, date),
  e.g. bars or a deduplicated price table),
* keyed slow sources (as-of),
* the label price series (full history).

Every row carries its trading-day index; a slow source row dated on a
non-trading day is placed on the first trading day on or after it (the first
grid day that may see it).  Rows are sorted once by (index, side, date): a
running frame picks the latest source row for each source (daily ones keep
it only if its date equals the row's), and -- since that order also
satisfies an order by index -- range frames ``[h, h]`` over the index read
the price h trading days ahead without another sort.  Market-wide sources
are resolved per trading day and broadcast.

Each entity partition holds a few rows per trading day and source (sources
are reduced to one row per (entity, day) by partial aggregation first), so
a hot entity cannot blow up a task.

``grid_on_calendar=False`` handles grids whose dates are not all trading
days: rows are then ordered by (date, side) for the as-of frame and by the
trading-day index for the label frames, which costs a second sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from pitlake.functions.scalar import label_na, return_bps
from pitlake.operators.calendar import calendar_index, first_trading_index
from pitlake.operators.joins import AsofSource, _expand, _reduce_source, add_lineage, asof_join, lineage_name, one_row_per_day
from pitlake.operators.labels import price_at, price_rows
from pitlake.operators.panel import avail_rules, available
from pitlake.operators.spans import asof_feed, days_of, running, spread

HORIZONS = (1, 5, 20)


@dataclass
class LabelSpec:
    prices: DataFrame            # full history: key, date, price column
    price_col: str
    horizons: Sequence[int] = HORIZONS
    clip: float | None = 2000.0
    base_col: str | None = None  # grid/feature column holding the base price; default: same-day price
    price_order: Sequence[str] | None = None   # of several prices for one key and day the last by these; None: the query fails


def assemble_gold(grid: DataFrame, calendar: DataFrame, daily: Sequence[AsofSource] = (),
                  slow: Sequence[AsofSource] = (), market_daily: Sequence[tuple[str, DataFrame]] = (),
                  market_slow: Sequence[AsofSource] = (), labels: LabelSpec | None = None,
                  key: str = "ticker", date: str = "date", grid_on_calendar: bool = True,
                  avail: Mapping[str, str | tuple[str, str]] | str | None = None,
                  universe: DataFrame | None = None) -> DataFrame:
    """Gold table = grid + every source's features (+ labels), one grid shuffle.

    ``daily`` sources have one row per (key, date), and the query fails on a
    second one (:func:`join_daily` is for sources that repeat keys).  ``slow``
    ones follow J4.  Column names are those of the unfused operators, so both
    paths give identical tables.  ``grid_on_calendar`` states that every grid
    date is a trading day (true for :func:`base_grid`), which allows the
    single-sort plan; the query fails on another date.

    ``avail`` gives sources' availability rules as in :func:`assemble`; a daily
    source with a rule keeps its day as ``effective_date_<source>``.

    ``universe`` states that ``grid`` is ``base_grid(universe, calendar)``,
    uncut.  Only the sources' and price rows are then stacked, shuffled and
    sorted, and the grid's are made after the windows, by spans of days
    (:mod:`pitlake.operators.spans`): the same rows.  A label whose base price
    is a column of the grid (``base_col``) needs the grid's rows themselves.
    """
    spans = universe is not None and (labels is None or labels.base_col is None)
    cal_idx = calendar_index(calendar)
    cal = F.broadcast(cal_idx.select(F.col("date").alias("__d"), F.col("idx").alias("__i")))  # one row per day
    # work on copies: the caller's source specs stay as they are
    daily = [replace(s, keep_date_as=None) for s in daily]
    slow = [replace(s) for s in slow]
    names = [*(s.name for s in [*daily, *slow, *market_slow]), *(name for name, _ in market_daily)]
    rules = avail_rules(names, avail)

    def usable(s: AsofSource) -> AsofSource:
        """An as-of source dated by the day it may be used from."""
        if not rules.get(s.name):
            return s
        cols = s.cols if s.cols is not None else [c for c in s.df.columns if c not in (key, date)]
        src = available(s.df, calendar, *rules[s.name], key=key, date=date, tie_break=s.tie_break or (), period=s.period)
        return replace(s, df=src, cols=cols, on_calendar=True)

    def usable_daily(name: str, src: DataFrame) -> DataFrame:
        return available(src, calendar, *rules[name], key=key, date=date, daily=True) if rules.get(name) else src

    daily = [replace(s, df=usable_daily(s.name, s.df), cols=[*s.cols, "effective_date"] if rules.get(s.name) and s.cols is not None else s.cols) for s in daily]
    slow, market_slow = [usable(s) for s in slow], [usable(s) for s in market_slow]
    market_daily = [(name, usable_daily(name, src)) for name, src in market_daily]
    own_date = {lineage_name("effective_date", n, s.prefix): f"effective_date_{n}" for s in daily if rules.get(n := s.name)}
    own_date |= {lineage_name("effective_date", n): f"effective_date_{n}" for n, _ in market_daily if rules.get(n)}
    if spans:
        res = _by_spans(universe, calendar, daily, slow, labels, key, date)
    else:
        res = _by_rows(grid, calendar, cal, daily, slow, labels, key, date, grid_on_calendar)

    # market-wide sources: resolved per trading day, then one broadcast join
    if market_daily or market_slow:
        days = cal_idx.select(F.col("date").alias(date))
        per_day = days
        for name, src in market_daily:
            per_day = per_day.join(add_lineage(one_row_per_day(src, name, date), name, [date]), date, "left")
        if market_slow:
            per_day = asof_join(per_day, list(market_slow), by=None, date=date, dates=days)
        feat = [c for c in per_day.columns if c != date]
        lab_names = [f"{k}_{h}d" for h in (labels.horizons if labels is not None else []) for k in ("r", "label_na")]
        keep = [c for c in res.columns if c not in lab_names]
        res = res.join(F.broadcast(per_day), date, "left").select(*keep, *feat, *lab_names)
    return res.withColumnsRenamed(own_date)


def _features(sources: Sequence[AsofSource], is_daily: Sequence[bool], pcols: Sequence[str], day: Column) -> list[Column]:
    """The sources' columns from their latest rows; a daily source's only on its own day."""
    out = []
    for s, p, one_day in zip(sources, pcols, is_daily):
        if one_day:
            same = F.col(f"{p}.__date") == day
            out += [F.when(same, F.col(f"{p}.`{c}`")).alias(f"{s.prefix}{c}_{s.name}") for c in s._payload]
        else:
            out += _expand(s, p)
    return out


def _labels(labels: LabelSpec | None, p0: Column, known: Column | None = None) -> list[Column]:
    out = []
    for h in labels.horizons if labels is not None else []:
        ph = F.col(f"__f{h}")
        out += [return_bps(p0, ph, labels.clip).alias(f"r_{h}d"), label_na(p0, ph, known).alias(f"label_na_{h}d")]
    return out


def _by_spans(universe: DataFrame, calendar: DataFrame, daily: Sequence[AsofSource], slow: Sequence[AsofSource],
              labels: LabelSpec | None, key: str, date: str) -> DataFrame:
    """Grid, keyed sources and labels by spans of days; prices ahead are frames
    over the days with rows, since a label needs a price on its own day."""
    sources, is_daily = [*daily, *slow], [True] * len(daily) + [False] * len(slow)
    feeds, states, pcols = [], {}, [f"__p{i}" for i in range(len(sources))]
    for s, p, one_day in zip(sources, pcols, is_daily):
        if one_day:       # rows on other days can never match
            rows = _reduce_source(s, key, date, T.DateType(), unique=True).toDF("__k", "__d", p)
            rows, latest = rows.join(days_of(calendar), "__d"), F.last(p, ignorenulls=True).over(running())
        else:
            rows, latest = asof_feed(s, calendar, p, key, date)
        feeds.append(rows)
        states[p] = latest
    if labels is not None:
        px = price_rows(labels.prices, labels.price_col, labels.price_order, key, date).toDF("__k", "__d", "__px")
        feeds.append(px.join(days_of(calendar), "__d"))
        ahead = W.partitionBy("__k").orderBy("__i")
        states |= {f"__f{h}": price_at(ahead, h) for h in dict.fromkeys([0, *labels.horizons])}
    res = spread(universe, calendar, feeds, states, key=key, date=date)
    p0 = F.when(F.col("__first"), F.col("__f0")) if labels is not None else None
    return res.select(key, date, *_features(sources, is_daily, pcols, F.col(date)), *_labels(labels, p0))


def _by_rows(grid: DataFrame, calendar: DataFrame, cal: DataFrame, daily: Sequence[AsofSource], slow: Sequence[AsofSource],
             labels: LabelSpec | None, key: str, date: str, grid_on_calendar: bool) -> DataFrame:
    """Grid, keyed sources and labels by one stack of all their rows."""
    sources = [*daily, *slow]
    is_daily = [True] * len(daily) + [False] * len(slow)
    reduced = [_reduce_source(s, key, date, T.DateType(), unique=day) for s, day in zip(sources, is_daily)]
    n = len(sources)
    pcols = [f"__p{i}" for i in range(n)]
    ptypes = [r.schema["__p"].dataType for r in reduced]
    nulls = [F.lit(None).cast(t) for t in ptypes]

    def on_calendar(df: DataFrame, what: str) -> DataFrame:
        """``df`` with its index; the query fails on a row dated off the calendar."""
        msg = F.lit(f"{what} has a row on a day that is not in the calendar")
        off = F.col("__i").isNull() & F.col("__d").isNotNull()
        found = df.join(cal, "__d", "left")
        return found.withColumn("__i", F.when(off, F.raise_error(msg).cast("int")).otherwise(F.col("__i")))

    g = grid.withColumn("__d", F.col(date).cast("date"))
    g = on_calendar(g, "the grid") if grid_on_calendar else g.join(cal, "__d", "left")
    lcols = list(grid.columns)
    lstruct = F.struct(*[F.col(f"`{c}`").alias(c) for c in lcols])
    parts = [g.select(F.col(key).alias("__k"), "__d", F.lit(1).alias("__side"), "__i", lstruct.alias("__l"),
                      F.lit(None).cast("double").alias("__px"), *[nl.alias(p) for nl, p in zip(nulls, pcols)])]
    ltype = parts[0].schema["__l"].dataType

    def payload_row(r: DataFrame, i: int, idx: Column) -> DataFrame:
        return r.select(F.col("__k"), F.col("__d"), F.lit(0).alias("__side"), idx.alias("__i"),
                        F.lit(None).cast(ltype).alias("__l"), F.lit(None).cast("double").alias("__px"),
                        *[F.col("__p").alias(p) if j == i else nulls[j].alias(p) for j, p in enumerate(pcols)])

    for i, r in enumerate(reduced):
        r = r.select(F.col(key).alias("__k"), F.col(date).cast("date").alias("__d"), "__p")
        if not grid_on_calendar:
            parts.append(payload_row(r, i, F.lit(None).cast("int")))
        elif is_daily[i]:
            # equality on a trading day: rows on other days can never match
            parts.append(payload_row(r.join(cal, "__d", "inner"), i, F.col("__i")))
        elif sources[i].on_calendar:
            # dated on trading days only: no day mapping, and the plan holds it to that
            parts.append(payload_row(on_calendar(r, f"source {sources[i].name!r}"), i, F.col("__i")))
        else:
            # as-of: place on the first trading day on/after the row's date
            # (the day map has one row per distinct day); rows after the
            # calendar end are visible to no grid row
            r = r.join(F.broadcast(first_trading_index(r.select("__d"), calendar, "__d", "__i")), "__d", "inner").where(F.col("__i").isNotNull())
            parts.append(payload_row(r, i, F.col("__i")))
    if labels is not None:
        px = price_rows(labels.prices, labels.price_col, labels.price_order, key, date).toDF("__k", "__d", "__px")
        px = px.join(cal, "__d", "inner")
        parts.append(px.select("__k", "__d", F.lit(0).alias("__side"), "__i", F.lit(None).cast(ltype).alias("__l"),
                               "__px", *[nl.alias(p) for nl, p in zip(nulls, pcols)]))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)

    cols = ["__k", "__d", "__side", "__i", "__l", "__px"]
    horizons = list(labels.horizons) if labels is not None else []
    if grid_on_calendar:
        # one sort: rows sorted by (idx, side, date) feed the running frame, and
        # that order also satisfies the (idx) order of the range frames
        run = (W.partitionBy("__k").orderBy("__i", "__side", "__d")
               .rowsBetween(W.unboundedPreceding, W.currentRow))
        step = stacked.select(*cols, *[F.last(p, ignorenulls=True).over(run).alias(p) for p in pcols])
        if labels is not None:
            w2 = W.partitionBy("__k").orderBy("__i")
            fwd = [price_at(w2, h).alias(f"__f{h}") for h in horizons]
            base = [] if labels.base_col else [price_at(w2, 0).alias("__f0")]
            step = step.select(*cols, *pcols, *fwd, *base)
    else:
        w1 = W.partitionBy("__k").orderBy("__d", "__side").rowsBetween(W.unboundedPreceding, W.currentRow)
        step = stacked.select(*cols, *[F.last(p, ignorenulls=True).over(w1).alias(p) for p in pcols])
        if labels is not None:
            w2 = W.partitionBy("__k").orderBy("__i")
            fwd = [price_at(w2, h).alias(f"__f{h}") for h in horizons]
            base = [] if labels.base_col else [price_at(w2, 0).alias("__f0")]
            step = step.select(*cols, *pcols, *fwd, *base)
    rows = step.where(F.col("__side") == 1)

    known = F.col("__i").isNotNull()
    p0 = None
    if labels is not None:
        p0 = F.when(known, F.col(f"__l.`{labels.base_col}`") if labels.base_col else F.col("__f0"))
    return rows.select(*[F.col(f"__l.`{c}`").alias(c) for c in lcols], *_features(sources, is_daily, pcols, F.col("__d")),
                       *_labels(labels, p0, known))
