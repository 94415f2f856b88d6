"""J10 panel assembly: fold every source onto the base grid.

Dispatch per source on the registry ``freq``: ``D``/``static`` join by
equality (J2 keyed, J3 market-wide), everything else as-of (J4 keyed,
J5 market-wide).  All keyed as-of sources go through one shared window and
all market-wide ones through one shared date match (SURVEY §4 rule 1), so the
number of shuffles does not grow with the number of slow sources.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pitlake.operators.audit import accounting
from pitlake.operators.calendar import shift_available
from pitlake.operators.joins import AsofSource, _expand, add_lineage, asof_join, join_daily, lineage_name
from pitlake.operators.labels import dedupe_last
from pitlake.operators.normalise import pick_date_key
from pitlake.operators.spans import asof_feed, days_of, every_feed, latest_order, spread
from pitlake.sources.registry import EQUI_FREQS, avail_rule_of, freq_of

log = logging.getLogger(__name__)


def usable(src: DataFrame, calendar: DataFrame, rule: str, avail_col: str | None = None, date: str = "date") -> DataFrame:
    """Every row of ``src`` that is ever used, dated by the trading day it may be used from; its own date is ``__src``."""
    shifted = shift_available(src, calendar, rule, date=date, avail_col=avail_col, out="__eff")
    return shifted.where("__eff IS NOT NULL").withColumnRenamed(date, "__src").withColumnRenamed("__eff", date)


def latest_day(rows: DataFrame, key: str = "ticker", date: str = "date") -> DataFrame:
    """Rows of :func:`usable` whose source day is the latest of their key and trading day."""
    day = F.col("__src").cast("date")
    latest = F.max(day).over(W.partitionBy(*[c for c in (key,) if c in rows.columns], date))
    return rows.withColumn("__last", latest).where(day.eqNullSafe(F.col("__last"))).drop("__last", "__src")


def available(src: DataFrame, calendar: DataFrame, rule: str, avail_col: str | None = None, key: str = "ticker",
              date: str = "date", daily: bool = False, tie_break: Sequence[str] = (), period: str | None = None) -> DataFrame:
    """D4 before a join: ``src`` dated by the trading day it may be used from,
    also kept as ``effective_date``; a row that never is used is left out.

    Of the rows of a key that become usable on one day those of an earlier
    source date are superseded.  A ``daily`` source keeps every row of the
    latest source day, so repeated keys fan out (J2) and a market-wide source
    is held to one row a day (T5).  Of an as-of source the latest row counts,
    by ``tie_break`` among equals, or without one the largest (as in J4); of
    reports with a ``period`` the newest period's latest row."""
    rest = [c for c in src.columns if c not in (key, date)]
    keys = [c for c in (key,) if c in src.columns]
    dated = usable(src, calendar, rule, avail_col, date)
    if daily:
        kept = latest_day(dated, key, date)
    else:
        kept = dedupe_last(dated, [*keys, date], [*([period] if period else []), "__src", *(tie_break or rest)]).drop("__src")
    return kept.withColumn("effective_date", F.col(date))


def collapsed(rows: DataFrame, loose: DataFrame, s: AsofSource, hot: Sequence, parts: int | None = None, key: str = "ticker",
              date: str = "date") -> DataFrame:
    """``rows`` of :func:`usable`, those of the ``hot`` keys (None: the rows without a key) as one a key and trading day, made
    from ``loose``, the same rows in any partitioning, and dealt to ``parts`` partitions."""
    if not hot:
        return rows
    is_hot = F.when(F.col(key).isNull(), F.lit(None in hot)).otherwise(F.col(key).isin([k for k in hot if k is not None]))
    one = dedupe_last(loose.where(is_hot), [key, date], latest_order(s, rows.columns, key, date))
    return rows.where(~is_hot).unionByName(one.repartition(parts, key) if parts else one)


def avail_rules(names: Sequence[str], avail: Mapping[str, str | tuple[str, str]] | str | None) -> dict[str, tuple[str, str | None] | None]:
    """Rule and column of each source; ``"registry"`` takes the registered rules."""
    rules = {i: avail_rule_of(i) for i in names} if avail == "registry" else dict(avail or {})
    return {i: r if isinstance(r, tuple) or not r else (r, None) for i, r in rules.items()}


def assemble(grid: DataFrame, sources: Mapping[str, DataFrame] | Sequence[tuple[str, DataFrame]],
             freqs: Mapping[str, str] | None = None, tie_breaks: Mapping[str, Sequence[str]] | None = None,
             key: str = "ticker", date: str = "date", asof_prefix: str = "feat_",
             on_error: str = "raise", calendar: DataFrame | None = None,
             avail: Mapping[str, str | tuple[str, str]] | str | None = None,
             periods: Mapping[str, str] | None = None, counted: dict | None = None,
             universe: DataFrame | None = None, hot: Mapping[str, tuple[Sequence, DataFrame]] | None = None,
             parts: int | None = None) -> DataFrame:
    """Left-fold sources onto ``grid`` (one lazy plan).

    ``freqs`` overrides the registry; a source that is neither registered nor
    in ``freqs`` is skipped, as is one without a date column (both logged).
    ``on_error="skip"`` logs and skips a source whose join fails to analyse;
    ``"raise"`` (default) surfaces it.  ``calendar`` (the grid's dates) lets
    market-wide as-of sources match on it instead of the grid's distinct dates.

    ``avail`` (D4) gives sources' availability rules, with the column for the
    rules that need one, or is ``"registry"`` for the registered rules; such a
    source is joined on the trading day it may be used from, which is kept as
    ``effective_date_<source>`` (needs ``calendar``).  Without it sources join
    on their own dates.

    ``periods`` names the period column of as-of sources whose reports are
    restated (see :class:`AsofSource`).  ``counted`` (A8) is filled with one
    row counter after the grid and after every equi join, all read from the
    one job that computes the panel; the join that adds rows is the source
    that fans out.

    ``universe`` states that ``grid`` is ``base_grid(universe, calendar)``,
    uncut.  The as-of sources and the first daily one with a key are then
    joined by spans of days (:mod:`pitlake.operators.spans`): the same rows, and only the
    sources' rows are shuffled.  It has no place to count rows after each
    join, nor to skip a join that fails: with ``counted`` or ``"skip"`` the
    sources are folded one by one.  ``hot`` gives, for an as-of source, the
    keys that hold so many rows that these are first reduced to one a day,
    and the source as it is read without buckets; rows of all other keys, and
    of sources it leaves out, are then shuffled once, as they are.  Without
    it every source with a rule is reduced, which takes a shuffle of its own.
    With sources stored in ``parts`` buckets by key they are not shuffled.
    """
    spans = universe is not None and calendar is not None and counted is None and on_error == "raise"
    items = list(sources.items()) if isinstance(sources, Mapping) else list(sources)
    rules = avail_rules([i for i, _ in items], avail)
    freqs = dict(freqs or {})
    tie_breaks = dict(tie_breaks or {})
    out, periods = grid, dict(periods or {})
    if counted is not None:
        out, counted["grid"] = accounting(out, "grid")
    keyed, market, equi = [], [], []
    for iface, df in items:
        freq = freqs.get(iface) or freq_of(iface)
        if freq is None:
            log.warning("no registry entry for %r; skipped", iface)
            continue
        try:
            src = pick_date_key(df, date)
            if date not in src.columns:
                log.warning("no date column in %r; skipped", iface)
                continue
            ties = list(tie_breaks.get(iface) or [])
            if rules.get(iface) and calendar is None:
                raise ValueError("availability rules need the calendar")
            whole = bool(rules.get(iface)) and spans and key in src.columns
            if whole and freq in EQUI_FREQS:
                src = usable(src, calendar, *rules[iface], date=date).withColumn("effective_date", F.col(date))
            elif whole and hot is not None:
                s = AsofSource(iface, usable(src, calendar, *rules[iface], date=date), tie_break=ties or None, prefix=asof_prefix,
                               period=periods.get(iface), every=True)
                crowd, loose = hot.get(iface) or ([], df)
                loose = usable(pick_date_key(loose, date), calendar, *rules[iface], date=date)
                keyed.append(replace(s, df=collapsed(s.df, loose, s, crowd, parts, key, date)))
                continue
            elif rules.get(iface):
                src = available(src, calendar, *rules[iface], key=key, date=date, daily=freq in EQUI_FREQS,
                                tie_break=ties, period=None if freq in EQUI_FREQS else periods.get(iface))
            if freq in EQUI_FREQS and spans:
                equi.append((iface, src))
            elif freq in EQUI_FREQS:
                out = join_daily(out, src, iface, key=key, date=date)
                if rules.get(iface):
                    out = out.withColumnRenamed(lineage_name("effective_date", iface), f"effective_date_{iface}")
                if counted is not None:
                    out, counted[iface] = accounting(out, iface)
            else:
                src = src.drop("effective_date") if rules.get(iface) else src      # the as-of join keeps its date itself
                s = AsofSource(iface, src, tie_break=ties or None, prefix=asof_prefix, period=periods.get(iface),
                               reduced=bool(rules.get(iface)))       # ``available`` has left one row a key and day
                (keyed if key in src.columns else market).append(s)
        except Exception:
            if on_error == "skip":
                log.exception("source %r failed; skipped", iface)
                continue
            raise
    if spans:
        out = _by_spans(out, universe, calendar, equi, keyed, key, date, parts)
        out = out.withColumnsRenamed({lineage_name("effective_date", i): f"effective_date_{i}" for i, _ in equi if rules.get(i)})
    elif keyed:
        out = asof_join(out, keyed, by=key, date=date)
    if market:
        out = asof_join(out, market, by=None, date=date, dates=calendar)
    return out


def _by_spans(grid: DataFrame, universe: DataFrame, calendar: DataFrame, equi: Sequence[tuple[str, DataFrame]],
              keyed: Sequence[AsofSource], key: str, date: str, parts: int | None = None) -> DataFrame:
    """The equi sources and the keyed as-of ones on a whole grid, in that order of columns."""
    types = {f.name: f.dataType for f in grid.schema}
    fits = [i for i, src in equi if all(c in src.columns and src.schema[c].dataType == types[c] for c in (key, date))]
    feeds, states, repeated, base = [], {}, None, []
    for n, s in enumerate(keyed):
        rows, latest = (every_feed if s.every else asof_feed)(s, calendar, f"__p{n}", key, date)
        feeds.append(rows)
        states[f"__p{n}"] = latest
    for i, src in equi:
        if fits and i == fits[0]:
            named = add_lineage(src, i, [key, date, "__src"])
            base = [c for c in named.columns if c not in (key, date, "__src")]
            rows = named.where(F.col(key).isNotNull()).withColumnsRenamed({key: "__k", date: "__d"})
            repeated = rows.join(days_of(calendar), "__d")
            if "__src" in rows.columns:
                repeated = repeated.withColumn("__d", F.col("__src").cast("date")).drop("__src")
    out = spread(universe, calendar, feeds, states, repeated, key, date, parts)
    out = out.select(key, date, *base, *[c for n, s in enumerate(keyed) for c in _expand(s, f"__p{n}")])
    asof_cols = [c for c in out.columns if c not in (key, date, *base)]
    order = [key, date]
    for i, src in equi:         # columns stand as join after join would leave them
        new, on = base, [key, date]
        if not (fits and i == fits[0]):
            before, on = out.columns, [c for c in on if c in src.columns]
            src = latest_day(src, key, date) if "__src" in src.columns else src
            out = join_daily(out, src, i, key=key, date=date)
            new = [c for c in out.columns if c not in before]
        order = [*on, *[c for c in order if c not in on], *new]
    return out.select(*order, *asof_cols)
