"""Joins: J2/J3 equi left joins, J4/J5 as-of joins, P5 lineage names, J6 gold.

As-of join (Spark has no operator for it) is a union + one ordered window:
source rows and left rows are stacked, sorted by (key, date, side) and every
left row takes the last non-null source payload seen so far.  One Exchange
(hash on the key) and one Sort, whatever the number of sources on that key.

Skew: the source side is first reduced to one row per (key, date) with a
partial (map-side) aggregate, so a key that holds a third of all source rows
still contributes at most one row per day to its window partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from pitlake.operators.slices import heads, hot_keys, tag


def lineage_name(col: str, iface: str, prefix: str = "feat_") -> str:
    """P5: ``feat_<col>_<iface>`` (``prefix=""`` reproduces the bare as-of names)."""
    return f"{prefix}{col}_{iface}"


def add_lineage(df: DataFrame, iface: str, keys: Sequence[str], prefix: str = "feat_") -> DataFrame:
    """P5: rename every non-key column to its lineage name."""
    return df.select(*[F.col(f"`{c}`") if c in keys else F.col(f"`{c}`").alias(lineage_name(c, iface, prefix))
                       for c in df.columns])


def join_daily(left: DataFrame, src: DataFrame, iface: str, key: str = "ticker",
               date: str = "date", prefix: str = "feat_", check_unique: bool = True) -> DataFrame:
    """Left join a daily or static source on (key, date), or on date
    alone when the source has no key (market-wide).

    Duplicate rows of a keyed source fan out, as in the reference.  The
    physical join is left to Catalyst/AQE, but a market-wide source held to
    one row a day is broadcast: the left side is not dealt by date.  A market-wide source that repeats a date would multiply every
    grid row of that day (T5): the query fails on it, inside the plan, unless
    ``check_unique`` is off.
    """
    keys = [key, date] if key in src.columns else [date]
    if check_unique and keys == [date]:
        src = one_row_per_day(src, iface, date)
    right = add_lineage(src, iface, keys, prefix)
    return left.join(F.broadcast(right) if check_unique and keys == [date] else right, keys, "left")


def one_row_per_day(src: DataFrame, name: str, date: str = "date") -> DataFrame:
    """A market-wide daily source as one row per day (T5); the query fails on
    a day with several rows (``raise_error`` inside the plan, no extra job).
    One row per day is also what bounds a broadcast of it."""
    cols = [c for c in src.columns if c != date]
    red = src.where(F.col(date).isNotNull()).groupBy(F.col(date).cast("date").alias(date)).agg(
        F.max(F.struct(*[F.col(f"`{c}`").alias(c) for c in cols])).alias("__m"), F.count(F.lit(1)).alias("__n"))
    msg = F.lit(f"market-wide source {name!r} has several rows for one {date}")
    checked = F.when(F.col("__n") > 1, F.raise_error(msg)).otherwise(F.col("__m"))
    return red.select(date, checked.alias("__m")).select(date, *[F.col(f"__m.`{c}`").alias(c) for c in cols])


@dataclass
class AsofSource:
    """One as-of source: ``df`` has the join key (optional), ``date`` and payload."""

    name: str
    df: DataFrame
    cols: Sequence[str] | None = None        # payload columns (default: all but key/date)
    tie_break: Sequence[str] | None = None   # among same-date rows keep the largest
    prefix: str = "feat_"
    keep_date_as: str | None = "effective_date_{name}"   # T2: source date for the audit
    unique: bool = False                     # one row per (key, date): the query fails on a second
    on_calendar: bool = False                # every date is a trading day: the query fails on another
    period: str | None = None                # reports that are restated: the column with the period they speak of
    reduced: bool = False                    # the plan before it gives one row per (key, date): not aggregated again
    every: bool = False                      # rows of ``panel.usable``, any number a (key, date): see ``spans.every_feed``
    _payload: list = field(default_factory=list, repr=False)


def _reduce_source(s: AsofSource, by: str | None, date: str, on_type: T.DataType | None = None,
                   unique: bool = False) -> DataFrame:
    """One row per (key, date): the whole row with the largest tie-break.

    max_by/max are partial aggregates, so the reduction happens map-side
    before any shuffle.  The date is cast to ``on_type`` (the left side's)
    before the reduction; among rows that then fall on one date the latest
    original date comes first, then the tie-break.  ``unique`` (or the
    source's own flag) states one row per (key, date): the same aggregate
    counts them, and the query fails on a second one.

    A source with a ``period`` is dated by when its reports became known.  A
    day then gives the report of the newest period known so far, in its latest
    version (date, then tie-break): a restatement of an older period that
    arrives later does not displace it.  Reports without a period come
    before all others.
    """
    keys = ([by] if by else []) + [date]
    cols = list(s.cols) if s.cols is not None else [c for c in s.df.columns if c not in keys]
    s._payload = cols
    on = F.col(f"`{date}`").cast(on_type) if on_type is not None else F.col(f"`{date}`")
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in cols], F.col(date).alias("__date"))
    order = [F.col(f"`{date}`"), *[F.col(f"`{c}`") for c in s.tie_break or []]]
    agg = F.max_by(row, F.struct(*order)) if s.tie_break else F.max(F.struct(F.col(f"`{date}`").alias("__o"), row.alias("__r")))["__r"]
    src = s.df.where(F.col(date).isNotNull())
    if s.reduced and not s.period:
        return src.select(*([by] if by else []), on.alias(date), row.alias("__p"))
    if s.period:
        return _newest_known(s, by, date, on)
    if not (unique or s.unique):
        return src.groupBy(*([by] if by else []), on.alias(date)).agg(agg.alias("__p"))
    msg = F.lit(f"source {s.name!r} has several rows for one {'key and ' if by else ''}date")
    return (src.groupBy(*([by] if by else []), on.alias(date)).agg(agg.alias("__p"), F.count(F.lit(1)).alias("__n"))
            .select(*keys, F.when(F.col("__n") > 1, F.raise_error(msg)).otherwise(F.col("__p")).alias("__p")))


def _best_of_day(s: AsofSource, by: str | None, date: str, on: Column) -> DataFrame:
    """Reports with a period: per (key, day of knowledge) the best one ``r`` and
    its rank ``b`` (period, date, tie-break), a partial aggregate."""
    cols = list(s.cols) if s.cols is not None else [c for c in s.df.columns if c not in (by, date)]
    s._payload = cols
    if s.unique:
        raise ValueError(f"source {s.name!r}: reports with a period may share a date, so it cannot be unique")
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in cols], F.col(date).alias("__date"))
    order = [F.col(f"`{date}`"), *[F.col(f"`{c}`") for c in s.tie_break or []]]
    best = F.struct(F.col(f"`{s.period}`").alias("p"), F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order))).alias("o"))
    src = s.df.where(F.col(date).isNotNull())
    if s.reduced:
        return src.select(*([by] if by else []), on.alias(date), F.struct(best.alias("b"), row.alias("r")).alias("__x"))
    return src.groupBy(*([by] if by else []), on.alias(date)).agg(F.max_by(F.struct(best.alias("b"), row.alias("r")), best).alias("__x"))


def _newest_known(s: AsofSource, by: str | None, date: str, on: Column) -> DataFrame:
    """As-of in two times: per (key, day of knowledge) the best report known by
    then.  Each day's best is a partial aggregate, and the running maximum over
    the days needs one window on the key, of one row a day."""
    if by is None and not isinstance(s.df.select(on).schema[0].dataType, T.DateType):
        raise ValueError(f"source {s.name!r}: reports without a key are joined by day")
    keys = [by] if by else []
    daily = _best_of_day(s, by, date, on)
    w = (W.partitionBy(*keys) if by else W.partitionBy(F.lit(0))).orderBy(date).rowsBetween(W.unboundedPreceding, W.currentRow)
    return daily.select(*keys, date, F.max_by("__x.r", "__x.b").over(w).alias("__p"))


def _expand(s: AsofSource, col: str) -> list[Column]:
    out = [F.col(f"{col}.`{c}`").alias(lineage_name(c, s.name, s.prefix)) for c in s._payload]
    if s.keep_date_as:
        out.append(F.col(f"{col}.__date").alias(s.keep_date_as.format(name=s.name)))
    return out


def asof_join(left: DataFrame, sources: Sequence[AsofSource] | AsofSource, by: str | None = "ticker",
              date: str = "date", dates: DataFrame | None = None, split: str | None = None) -> DataFrame:
    """For every left row, the latest source row with source date <= left date.

    A source with a ``period`` is matched in two times: of all reports known by
    the left date, the newest period's latest version.
    Exact matches count; no tolerance; a missing match gives nulls; the whole
    matched row is taken even if some of its values are null.  Several
    sources on the same key share one window.  ``date`` may be a date or a
    timestamp column (the source's is cast to the left's type).

    ``by=None`` is the market-wide (key-less) variant; it matches on the
    distinct dates of ``left``, or on ``dates`` (e.g. the calendar the grid
    was built from) when given, which spares recomputing the left side; a
    left side with timestamps is matched on its distinct timestamps.

    ``split`` (a ``date_trunc`` unit such as ``"day"`` or ``"month"``) bounds
    the window partitions by (key, period) instead of key: needed when the
    left side is an event stream in which one key may hold a large share of
    all rows.  Each period receives the latest earlier source row as a
    carry-in, so the result is identical.  ``split="rows"`` cuts the keys that
    hold more than a task's share at quantiles of their own times instead
    (:mod:`pitlake.operators.slices`): no period has to be guessed, a burst
    inside one period is cut too, and rows of one time, or without a time, are
    dealt by a hash of the row (rows equal in every column stay together).  It
    runs two passes over keys and times when the join is built.
    """
    if isinstance(sources, AsofSource):
        sources = [sources]
    if not sources:
        return left
    if by is None and isinstance(left.schema[date].dataType, T.DateType):
        return _asof_market(left, sources, date, dates)
    if by is None:
        return _asof_market_times(left, sources, date)
    on_type = left.schema[date].dataType
    reduced = [_reduce_source(s, by, date, on_type) for s in sources]
    n = len(sources)
    pcols = [f"__p{i}" for i in range(n)]
    ptypes = [r.schema["__p"].dataType for r in reduced]
    lstruct = F.struct(*[F.col(f"`{c}`").alias(c) for c in left.columns])
    lpart = left.select(F.col(by).alias("__k"), F.col(date).alias("__d"), F.lit(1).alias("__side"),
                        lstruct.alias("__l"), *[F.lit(None).cast(t).alias(p) for p, t in zip(pcols, ptypes)])
    ltype = lpart.schema["__l"].dataType
    rparts = [r.select(F.col(by).alias("__k"), F.col(date).cast(on_type).alias("__d"), F.lit(0).alias("__side"),
                       F.lit(None).cast(ltype).alias("__l"),
                       *[F.col("__p").alias(p) if j == i else F.lit(None).cast(ptypes[j]).alias(p)
                         for j, p in enumerate(pcols)])
              for i, r in enumerate(reduced)]
    if split is None:
        stacked = lpart
        for p in rparts:
            stacked = stacked.unionByName(p)
        w = W.partitionBy("__k").orderBy("__d", "__side").rowsBetween(W.unboundedPreceding, W.currentRow)
    elif split == "rows":
        times = left.select(F.col(by).alias("__k"), F.col(date).alias("__d"))
        for x in sources:
            times = times.union(x.df.select(F.col(by), F.col(date).cast(on_type)).where(F.col(date).isNotNull()))
        stacked, w = _sliced_stack(lpart, rparts, pcols, ptypes, hot_keys(times, "__k", "__d"))
    else:
        stacked, w = _split_stack(lpart, rparts, pcols, ptypes, split)
    filled = stacked.select("__side", "__l", *[F.last(p, ignorenulls=True).over(w).alias(p) for p in pcols])
    out = filled.where(F.col("__side") == 1)
    sel = [F.col(f"__l.`{c}`").alias(c) for c in left.columns]
    for s, p in zip(sources, pcols):
        sel += _expand(s, p)
    return out.select(*sel)


def _carry_in(heads: DataFrame, rparts: list, pcols: list, ptypes: list) -> DataFrame:
    """``heads`` (``__k``, ``__P`` and more) with each source's latest row from
    earlier periods ``__P`` of the key.

    Found on small tables: the heads and each source's last row per
    (key, period) (partial max_by), with a window over periods per key --
    bounded by the number of periods.
    """
    more = [c for c in heads.columns if c not in ("__k", "__P")]
    stack = heads.select("__k", "__P", F.lit(0).alias("__o"), *more, *[F.lit(None).cast(t).alias(p) for p, t in zip(pcols, ptypes)])
    for i, r in enumerate(rparts):
        last_i = r.groupBy("__k", "__P").agg(F.max_by(F.col(pcols[i]), F.col("__d")).alias(pcols[i]))
        stack = stack.unionByName(last_i.withColumn("__o", F.lit(1)), allowMissingColumns=True)
    # a period's head sorts before the same period's source summary: strictly earlier periods only
    w = W.partitionBy("__k").orderBy("__P", "__o").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (stack.select("__k", "__P", "__o", *more, *[F.last(p, ignorenulls=True).over(w).alias(p) for p in pcols])
            .where(F.col("__o") == 0).drop("__o"))


def _stack_parts(lpart: DataFrame, rparts: list, carry: DataFrame) -> DataFrame:
    """Left rows, source rows and, before both (``__c``), the carry-in rows."""
    body = lpart
    for p in rparts:
        body = body.unionByName(p)
    first = carry.select("*", F.lit(None).cast(lpart.schema["__d"].dataType).alias("__d"), F.lit(0).alias("__side"),
                         F.lit(None).cast(lpart.schema["__l"].dataType).alias("__l"), F.lit(0).alias("__c"))
    return body.withColumn("__c", F.lit(1)).unionByName(first)


def _split_stack(lpart: DataFrame, rparts: list, pcols: list, ptypes: list, unit: str):
    """Stack for the period-split as-of: rows keyed by (key, period) plus one
    carry-in row per left (key, period)."""
    lpart, *rparts = [p.withColumn("__P", F.date_trunc(unit, F.col("__d"))) for p in (lpart, *rparts)]
    carry = _carry_in(lpart.select("__k", "__P").distinct(), rparts, pcols, ptypes)
    w = W.partitionBy("__k", "__P").orderBy("__c", "__d", "__side").rowsBetween(W.unboundedPreceding, W.currentRow)
    return _stack_parts(lpart, rparts, carry), w


def _sliced_stack(lpart: DataFrame, rparts: list, pcols: list, ptypes: list, hot: DataFrame):
    """Stack for the as-of with hot keys cut by rows: keyed by (key, slice,
    copy).  Left rows of a slice with copies are dealt over them, source and
    carry-in rows go to each."""
    lpart, *rparts = [tag(p, hot, "__k", "__d") for p in (lpart, *rparts)]
    copies = F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("__z")
    carry = _carry_in(heads(hot), [r.drop("__n") for r in rparts], pcols, ptypes).select("*", copies).drop("__n")
    fields = [f for f in lpart.schema["__l"].dataType.fields if not _has_map(f.dataType)]
    spread = F.pmod(F.xxhash64(*[F.col(f"__l.`{f.name}`") for f in fields]), F.col("__n")).cast("int")
    body = _stack_parts(lpart.withColumn("__z", spread).drop("__n"), [r.select("*", copies).drop("__n") for r in rparts], carry)
    w = W.partitionBy("__k", "__P", "__z").orderBy("__c", "__d", "__side").rowsBetween(W.unboundedPreceding, W.currentRow)
    return body, w


def _has_map(t: T.DataType) -> bool:
    """Maps have no hash."""
    return "map<" in t.simpleString() or "variant" in t.simpleString()


def _asof_market_times(left: DataFrame, sources: Sequence[AsofSource], date: str) -> DataFrame:
    """J5 on timestamps: the match is made on the distinct left timestamps in
    (day) partitions with a carry-in row a day, and joined back on the
    timestamp.  There may be as many timestamps as rows, so that join is left
    to Catalyst and AQE."""
    one = F.lit(0).alias("__one")
    times = left.select(date, one).where(F.col(date).isNotNull()).distinct()
    keyed = [replace(s, df=s.df.select("*", one), cols=s.cols if s.cols is not None else [c for c in s.df.columns if c != date])
             for s in sources]
    matched = asof_join(times, keyed, by="__one", date=date, split="day").drop("__one")
    return left.join(matched, date, "left").select(*left.columns, *[c for c in matched.columns if c != date])


def _asof_market(left: DataFrame, sources: Sequence[AsofSource], date: str,
                 dates: DataFrame | None = None) -> DataFrame:
    """J5 on dates: key-less as-of.

    A window with no key would run in one task over all left rows, so the
    match is made on the distinct left dates only (one row per day, bounded
    by the calendar) and joined back by date with a broadcast of that
    date-keyed result.
    """
    reduced = [_reduce_source(s, None, date, T.DateType()) for s in sources]
    n = len(sources)
    pcols = [f"__p{i}" for i in range(n)]
    ptypes = [r.schema["__p"].dataType for r in reduced]
    src_dates = left if dates is None else dates
    dates = src_dates.select(F.col(date).cast("date").alias("__d")).where(F.col("__d").isNotNull()).distinct()
    stacked = dates.select("__d", F.lit(1).alias("__side"),
                           *[F.lit(None).cast(t).alias(p) for p, t in zip(pcols, ptypes)])
    for i, r in enumerate(reduced):
        stacked = stacked.unionByName(r.select(F.col(date).cast("date").alias("__d"), F.lit(0).alias("__side"),
                                               *[F.col("__p").alias(p) if j == i else F.lit(None).cast(ptypes[j]).alias(p)
                                                 for j, p in enumerate(pcols)]))
    w = W.orderBy("__d", "__side").rowsBetween(W.unboundedPreceding, W.currentRow)
    matched = (stacked.select("__d", "__side", *[F.last(p, ignorenulls=True).over(w).alias(p) for p in pcols])
               .where(F.col("__side") == 1).drop("__side"))
    sel = []
    for s, p in zip(sources, pcols):
        sel += _expand(s, p)
    matched = matched.select(F.col("__d"), *sel)
    # ``matched`` has one row per distinct date: bounded by the time span
    joined = left.join(F.broadcast(matched), F.col(date).cast("date") == F.col("__d"), "left")
    return joined.drop("__d")


def gold(features: DataFrame, labels: DataFrame, keys: Sequence[str] = ("ticker", "date")) -> DataFrame:
    """Features inner-join labels on (ticker, date)."""
    lab = labels.select(*keys, *[c for c in labels.columns if c not in keys and c not in features.columns])
    return features.join(lab, list(keys), "inner")
