"""Whole grids by spans of days: only source rows are shuffled and sorted.

On a :func:`base_grid` of the whole calendar every entity has every trading
day, so between two days on which some source has a row for the entity nothing
changes.  The sources' rows are stacked under (entity, index of the trading
day), with one head row an entity of the universe, and hashed and sorted by
entity once.  A running frame gives the state after each row; the last row of a day
stands for that day and those up to the entity's next row, and is spread over
them after the window.  The grid's rows, many times those of the sources, are
thus made in place and never travel.

A source may repeat days (``repeated``, as an equality join does): such rows
come last on their day, each of them makes a grid row, and the day's last one
also stands for the days after, on which it has no value.  Where several
source days fall on one trading day, rows of the latest of them count.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from pitlake.operators.calendar import calendar_index, first_trading_index
from pitlake.operators.joins import AsofSource, _best_of_day, _reduce_source


def by_row():
    """All rows of an entity in order; frames of days ([h, h] over ``__i``) keep to it."""
    return W.partitionBy("__k").orderBy("__i", "__side", "__d")


def running():
    return by_row().rowsBetween(W.unboundedPreceding, W.currentRow)


def days_of(calendar: DataFrame) -> DataFrame:
    """``__d``, ``__i``: every trading day with its index, to be broadcast (one row per day)."""
    return F.broadcast(calendar_index(calendar).select(F.col("date").alias("__d"), F.col("idx").alias("__i")))


def on_days(df: DataFrame, days: DataFrame, what: str) -> DataFrame:
    """``df`` with the index of its day; the query fails on a row dated off the calendar."""
    msg = F.lit(f"{what} has a row on a day that is not in the calendar")
    off = F.col("__i").isNull() & F.col("__d").isNotNull()
    found = df.join(days, "__d", "left")
    return found.withColumn("__i", F.when(off, F.raise_error(msg).cast("int")).otherwise(F.col("__i")))


def asof_feed(s: AsofSource, calendar: DataFrame, name: str, key: str, date: str) -> tuple[DataFrame, Column]:
    """Rows of an as-of source (``__k``, ``__d``, ``__i``, ``name``) and the
    column that gives its latest row as a grid row sees it."""
    if s.period:
        rows, latest = _best_of_day(s, key, date, F.col(f"`{date}`").cast(T.DateType())), F.max_by(f"{name}.r", f"{name}.b").over(running())
    else:
        rows, latest = _reduce_source(s, key, date, T.DateType()), F.last(name, ignorenulls=True).over(running())
    rows = rows.toDF("__k", "__d", name)
    if s.on_calendar:
        return on_days(rows, days_of(calendar), f"source {s.name!r}"), latest
    first = F.broadcast(first_trading_index(rows.select("__d"), calendar, "__d", "__i"))       # one row per distinct day
    return rows.join(first, "__d").where(F.col("__i").isNotNull()), latest


def latest_order(s: AsofSource, cols: Sequence[str], key: str, date: str) -> list[str]:
    """By which columns of ``panel.usable`` the last row of a key and trading day counts."""
    return [*([s.period] if s.period else []), "__src", *(s.tie_break or [c for c in cols if c not in (key, date, "__src")])]


def every_feed(s: AsofSource, calendar: DataFrame, name: str, key: str, date: str) -> tuple[DataFrame, Column]:
    """As :func:`asof_feed`, of a source that may have many rows a key and day
    (``panel.usable``): none is aggregated before the shuffle, the state finds
    the latest of them.  A row's order is read from its own columns."""
    s._payload = [c for c in s.df.columns if c not in (key, date, "__src")]
    row = F.struct(*[F.col(f"`{c}`") for c in s._payload], "__src", F.col(date).alias("__date"))
    rows = s.df.select(F.col(key).alias("__k"), F.col(date).alias("__d"), row.alias(name))
    first, *more = latest_order(s, s.df.columns, key, date)
    order = [first, "__date", *more] if s.period else ["__date", first, *more]
    best = F.struct(*[F.col(f"{name}.`{c}`").alias(f"o{i}") for i, c in enumerate(order)])
    return rows.join(days_of(calendar), "__d").drop("__d"), F.max_by(name, best).over(running())


def spread(universe: DataFrame, calendar: DataFrame, feeds: Sequence[DataFrame], states: dict[str, Column],
           repeated: DataFrame | None = None, key: str = "ticker", date: str = "date", parts: int | None = None) -> DataFrame:
    """Grid of ``universe`` and the whole ``calendar`` with ``states``, columns over the windows of this module.

    ``feeds`` and ``repeated`` have ``__k``, ``__d``, ``__i`` and payload
    columns.  The result has key, date, the states, ``__first`` (the grid row's
    day is that of the source rows) and, on such days, the columns of
    ``repeated``, whose rows of one day are in order of ``__d``, and of them
    only those of the last ``__d`` count.  An entity that the universe repeats has its rows repeatedly.
    If all of them lie in ``parts`` partitions by ``__k``, they stay there.
    """
    days = days_of(calendar)
    size = F.broadcast(calendar_index(calendar).agg((F.max("idx") + 1).alias("days")))
    heads = (universe.groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("times")).crossJoin(size)
             .select("__k", F.lit(0).alias("__i"), F.lit(0).alias("__side"), F.struct("times", "days").alias("__h")))
    if parts:
        heads = heads.repartition(parts, "__k")
    stack = [heads, *(f.withColumn("__side", F.lit(1)) for f in feeds)]
    more = [c for c in repeated.columns if c not in ("__k", "__d", "__i")] if repeated is not None else []
    if repeated is not None:
        stack.append(repeated.withColumn("__side", F.lit(2)))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stack)
    if "__d" not in stacked.columns:
        stacked = stacked.withColumn("__d", F.lit(None).cast("date"))
    steps = stacked.select("__k", "__i", "__side", "__d", *more, F.lead("__i").over(by_row()).alias("__next"),
                           F.last("__h", ignorenulls=True).over(running()).alias("__h"), *[c.alias(n) for n, c in states.items()])
    upto = F.coalesce("__next", "__h.days") - 1
    upto = F.when(F.col("__side") == 2, F.greatest(upto, F.col("__i"))).otherwise(upto)
    if repeated is not None:        # the rows of a side are sorted by it, so those left out come first and no span is cut
        last = F.max(F.when(F.col("__side") == 2, F.col("__d"))).over(W.partitionBy("__k").orderBy("__i").rangeBetween(0, 0))
        steps = steps.withColumn("__last", last).where((F.col("__side") != 2) | (F.col("__d") == F.col("__last")))
    rows = steps.withColumn("__to", upto).where(F.col("__h").isNotNull() & (F.col("__to") >= F.col("__i")))
    span = F.sequence("__i", "__to")
    each = F.when(F.col("__h.times") == 1, span).otherwise(F.flatten(F.array_repeat(span, F.col("__h.times").cast("int"))))
    first = F.col("__x") == F.col("__i")
    grid = rows.select(F.col("__k").alias(key), "__i", *more, *states, F.explode(each).alias("__x"))
    grid = grid.select(key, "__x", first.alias("__first"), *[F.when(first, F.col(c)).alias(c) for c in more], *states)
    named = days.select(F.col("__i").alias("__x"), F.col("__d").alias(date))
    return grid.join(F.broadcast(named), "__x").select(key, date, "__first", *more, *states)
