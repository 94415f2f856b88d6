"""Registered queries over the driver tables (one per operator group).

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables;
those that need exact quantiles (``describe``, ``stats_summary``,
``winsorize``) run their counting passes while they are built, ``asof_hot`` and ``ffill_hot`` cut their
hot keys then, and ``panel_landed`` writes its tables, silver as tables of the
session's catalog.  Floating-point aggregates whose value depends on summation order
(mean, std, interpolated quantiles) are rounded to 6 decimals here and in the
matching oracle SQL, so both sides compare exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.functions.scalar import ticker_of
from pitlake.operators.audit import (describe_numeric, label_na_report, lookahead_audit, missing_report,
                                     stats_summary)
from pitlake.operators.calendar import enrich_calendar, shift_available
from pitlake.operators.export import to_cpt, to_sft, to_txt
from pitlake.operators.gold import LabelSpec, assemble_gold
from pitlake.operators.grid import base_grid
from pitlake.operators.joins import AsofSource, asof_join, gold, join_daily
from pitlake.operators.labels import dedupe_last, forward_labels
from pitlake.operators.manifest import full_manifest, pending, replay_manifest
from pitlake.operators.normalise import normalise, normalise_date, union_sources
from pitlake.operators.panel import assemble
from pitlake.operators.treat import apply_feature_schema, assign_split, ffill, fill_missing, membership, suspension, winsorize
from pitlake.plans import tables as tb
from pitlake.plans.landed import buckets_for, landed_panel, write_landed_silver
from pitlake.sources.registry import registry


def _events(spark, sf):
    return tb.load(spark, sf, "events")


def events_grid(bars: DataFrame) -> DataFrame:
    return base_grid(tb.event_universe(bars), tb.event_calendar(bars))


GRID_WINDOW = ("2024-01-05", "2024-01-24")


# 1 ------------------------------------------------------------- S4, P11, bars
def q_bars(spark: SparkSession, sf: str) -> DataFrame:
    return tb.event_bars(_events(spark, sf))


# 2 ---------------------------------------------------------------- J1, P6
def q_base_grid(spark, sf):
    bars = tb.event_bars(_events(spark, sf))
    cal = tb.event_calendar(bars)
    # an inclusive window (P6) that cuts the calendar on both sides
    return base_grid(tb.event_universe(bars), cal, *GRID_WINDOW)


# 3 ------------------------------------------------------------ J2, J3, P5
def q_join_daily(spark, sf):
    bars = tb.event_bars(_events(spark, sf))
    return join_daily(events_grid(bars), bars, "bars")


def q_join_market(spark, sf):
    bars = tb.event_bars(_events(spark, sf))
    return join_daily(events_grid(bars), tb.market_daily(bars), "market")


# 4 ------------------------------------------------- W1, W2, F1, F2, J8 (flagship)
def q_labels(spark, sf):
    bars = tb.event_bars(_events(spark, sf))
    return forward_labels(events_grid(bars), bars, tb.event_calendar(bars), "close")


def q_labels_lineitem(spark, sf):
    bars = tb.lineitem_bars(tb.load(spark, sf, "lineitem"))
    cal = tb.event_calendar(bars)               # the bars' days: their exchange is reused, lineitem is not read again
    uni = tb.supplier_universe(tb.load(spark, sf, "supplier"))
    grid = base_grid(uni, cal)
    return forward_labels(grid, bars, cal, "price", universe=uni)


# 5 ---------------------------------------------------------- J4, J5, O2
def q_asof_keyed(spark, sf):
    ev = _events(spark, sf)
    src = AsofSource("signup", tb.signup_source(ev), tie_break=["signup_ts"])
    return asof_join(events_grid(tb.event_bars(ev)), src, by="ticker")


def q_asof_market(spark, sf):
    ev = _events(spark, sf)
    bars = tb.event_bars(ev)
    src = AsofSource("weekly", tb.weekly_purchase_report(ev))
    return asof_join(events_grid(bars), src, by=None, dates=tb.event_calendar(bars))


def q_asof_orders(spark, sf):
    od = tb.load(spark, sf, "orders")
    grid = base_grid(tb.customer_universe(tb.load(spark, sf, "customer")), tb.monthly_calendar(od))
    src = AsofSource("orders", tb.order_source(od), tie_break=["o_orderkey"])
    return asof_join(grid, src, by="ticker")


def q_asof_restated(spark, sf):
    """As-of in two times: of all reports known by a month's first order date, the newest quarter's latest version."""
    od, li = tb.load(spark, sf, "orders"), tb.load(spark, sf, "lineitem")
    grid = base_grid(tb.supplier_universe(tb.load(spark, sf, "supplier")), tb.monthly_calendar(od))
    src = AsofSource("reports", tb.order_reports(li, od), period="quarter", tie_break=["l_orderkey", "l_linenumber"])
    return asof_join(grid, src, by="ticker")


def q_asof_hot(spark, sf):
    """As-of on time where one key holds more than half of all events: the latest large one of the key at or before each."""
    ev = tb.stream_events(_events(spark, sf))
    src = ev.where(F.col("value") >= 90).select("stream", "ts", F.col("value").alias("large"), F.col("event_id").alias("large_id"))
    return asof_join(ev.select("event_id", "stream", "ts"), AsofSource("stream", src, tie_break=["large_id"]),
                     by="stream", date="ts", split="rows")


def q_ffill_hot(spark, sf):
    """Forward fill in time where one key holds more than half of all rows: the last large value of the key, one row an instant."""
    ev = tb.stream_events(_events(spark, sf)).groupBy("stream", "ts").agg(F.max("value").alias("value"))
    seen = ev.withColumn("large", F.when(F.col("value") >= 90, F.col("value")))
    return ffill(seen, ["large"], by="stream", order="ts", split="rows")


def q_asof_events(spark, sf):
    """As-of on time over every event (not a grid): the latest signup at or
    before each event, split into (user, day) partitions so a user holding a
    large share of all events cannot overload one task."""
    ev = _events(spark, sf)
    left = ev.select("event_id", F.col("user_id").alias("ticker"), "ts")
    src = (ev.where(F.col("event_type") == "signup")
           .select(F.col("user_id").alias("ticker"), "ts", F.col("value").alias("signup_value"),
                   F.col("event_id").alias("signup_id")))
    return asof_join(left, AsofSource("signups", src, tie_break=["signup_id"]), by="ticker", date="ts", split="day")


# 6 --------------------------------------------------------------------- J10
PANEL_FREQS = {"bars": "D", "market": "D", "signup": "event", "weekly": "Q"}
PANEL_TIES = {"signup": ["signup_ts"]}


def events_panel(ev: DataFrame, bars: DataFrame) -> DataFrame:
    sources = [("bars", bars), ("market", tb.market_daily(bars)),
               ("signup", tb.signup_source(ev)), ("weekly", tb.weekly_purchase_report(ev))]
    return assemble(events_grid(bars), sources, freqs=PANEL_FREQS, tie_breaks=PANEL_TIES,
                    calendar=tb.event_calendar(bars))


def q_panel(spark, sf):
    ev = _events(spark, sf)
    return events_panel(ev, tb.event_bars(ev))


def events_gold(ev: DataFrame) -> DataFrame:
    """Gold = panel features + labels (J10 + W2 + J6), fused into one grid shuffle."""
    bars = tb.event_bars(ev)
    return assemble_gold(
        events_grid(bars), tb.event_calendar(bars),
        daily=[AsofSource("bars", bars, unique=True)],      # bars: one row per (user, day)
        # signups are events, and the calendar is the event days: on calendar
        slow=[AsofSource("signup", tb.signup_source(ev), tie_break=PANEL_TIES["signup"], on_calendar=True)],
        market_daily=[("market", tb.market_daily(bars))],
        market_slow=[AsofSource("weekly", tb.weekly_purchase_report(ev))],
        labels=LabelSpec(bars, "close"))


def events_gold_unfused(ev: DataFrame) -> DataFrame:
    """Same table by the step-by-step operators (J10, then W2, then J6)."""
    bars = tb.event_bars(ev)
    lab = forward_labels(events_grid(bars), bars, tb.event_calendar(bars), "close")
    return gold(events_panel(ev, bars), lab)


def q_gold(spark, sf):
    return events_gold(_events(spark, sf))


def q_gold_lineitem(spark, sf):
    """Fused gold on the supplier x ship-day panel (the large one)."""
    li = tb.load(spark, sf, "lineitem")
    bars = tb.lineitem_bars(li)
    cal = tb.event_calendar(bars)
    uni = tb.supplier_universe(tb.load(spark, sf, "supplier"))
    grid = base_grid(uni, cal)
    return assemble_gold(
        grid, cal,
        daily=[AsofSource("bars", bars, unique=True)],
        # returned lines are lineitems, and the calendar is their ship days: on calendar
        slow=[AsofSource("returns", tb.supplier_returns(li), tie_break=["l_orderkey", "l_linenumber"],
                         on_calendar=True)],
        market_daily=[("market", tb.lineitem_market(bars))],
        labels=LabelSpec(bars, "price"), universe=uni)


def q_gold_unfused(spark, sf):
    return events_gold_unfused(_events(spark, sf))


# 7 ------------------------------------------------------------- J6, F3-F7
EVENT_FEATURES = {n: f"feat_{n}_bars" for n in ("open", "high", "low", "close", "volume")}


def q_export_cpt(spark, sf):
    return to_cpt(events_gold(_events(spark, sf)), 1, EVENT_FEATURES)


def q_export_sft(spark, sf):
    return to_sft(events_gold(_events(spark, sf)), 1, EVENT_FEATURES)


def q_export_txt(spark, sf):
    return to_txt(events_gold(_events(spark, sf)), 1, EVENT_FEATURES)


# 8 ------------------------------------------------------- A1-A4, A7, J9
R6 = ("mean", "std", "25%", "50%", "75%")


def _round6(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{c}`"), 6).alias(c) if c in R6 else F.col(f"`{c}`") for c in df.columns])


def q_missing_report(spark, sf):
    return missing_report(events_gold(_events(spark, sf)))


def q_describe(spark, sf):
    return _round6(describe_numeric(events_gold(_events(spark, sf))))


def q_label_na(spark, sf):
    return label_na_report(events_gold(_events(spark, sf)))


def q_lookahead(spark, sf):
    return lookahead_audit(events_gold(_events(spark, sf)))


def q_stats_summary(spark, sf):
    return _round6(stats_summary(events_gold(_events(spark, sf))))


# 9 ------------------------------------------------ P1-P4, P8, P12, U1, A6
ORDER_MAP = {"o_orderdate": "date", "o_custkey": "ticker", "o_totalprice": "amount", "o_comment": "comment"}


def q_silver_orders(spark, sf):
    return normalise(tb.load(spark, sf, "orders"), ORDER_MAP, ticker=None)


def q_panel_landed(spark, sf):
    """Five landed sources, one of each kind, to one panel by their registered columns, frequencies and availability
    rules.  Landing table and silver, which is dealt by ticker into buckets, are written and read again."""
    li, od = tb.load(spark, sf, "lineitem"), tb.load(spark, sf, "orders")
    landing, silver = tb.scratch(spark, "landing"), tb.scratch(spark, "silver")
    tb.land_sources(li, od, landing)
    buckets = buckets_for(spark, landing)
    sources = write_landed_silver(spark, landing, silver, buckets)
    uni = tb.load(spark, sf, "supplier").select(ticker_of(F.col("s_suppkey")).alias("ticker"))
    cal = tb.lineitem_calendar(li)
    ties = {i: ["l_orderkey", "l_linenumber"] for i in ("stock_yjbb_em", "stock_industry_change_cninfo")}
    return landed_panel(spark, silver, list(sources), base_grid(uni, cal), cal, tie_breaks=ties, universe=uni, buckets=buckets)


def q_union_drift(spark, sf):
    """Fetches that disagree on their columns' types: whole numbers and doubles, numbers and text, days and times."""
    ev = _events(spark, sf)
    of = lambda kind: ev.where(F.col("event_type") == kind)
    whole = F.floor("value").cast("int").alias("amount")
    return union_sources([of("click").select("event_id", whole, F.to_date("ts").alias("at")),
                          of("purchase").select("event_id", F.col("value").alias("amount"), F.col("ts").alias("at")),
                          of("view").select("event_id", F.col("user_id").alias("ref"), F.lit(None).alias("amount")),
                          of("signup").select("event_id", F.col("props").alias("ref"), F.col("ts").alias("at"))])


def q_date_forms(spark, sf):
    """Ship days written in seven forms, read back as dates."""
    day, n = F.to_date("l_shipdate"), F.col("l_linenumber")
    forms = ("yyyyMMdd", "yyyy-MM-dd", "yyyy/M/d", "yyyy-MM", "yyyyMM", "yyyy年M月d日", "yyyy-MM-dd HH:mm:ss")
    text = F.coalesce(*[F.when(n == i, F.date_format(day, f)) for i, f in enumerate(forms, 1)])
    li = tb.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.alias("written"), text.alias("date"))
    return normalise_date(li)


def q_silver_union(spark, sf):
    ev = _events(spark, sf)
    of = lambda kind: ev.where(F.col("event_type") == kind)
    purchases = of("purchase").select("user_id", "ts", F.col("value").alias("amount"))
    signups = of("signup").select("user_id", "ts", "props")
    views = of("view").select("user_id", "ts", F.col("event_id").alias("view_id"))
    clicks = of("click").select("user_id", "ts", F.col("event_id").alias("click_id"))
    errors = of("error").select("user_id", "ts", F.col("value").alias("error_value"), "props")
    return union_sources([purchases, signups, views, clicks, errors])


def lineitem_codes(li: DataFrame) -> DataFrame:
    """Codes of each line: its price in cents, with leading zeros up to six digits, or whole if longer."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string")
    ticker = ticker_of(cents)
    return li.select("l_orderkey", "l_linenumber", F.regexp_extract(ticker, r"^(\d+)", 1).alias("code"), ticker.alias("ticker"))


def q_exchange_code(spark, sf):
    return lineitem_codes(tb.load(spark, sf, "lineitem"))


def q_dedupe_last(spark, sf):
    li = tb.load(spark, sf, "lineitem").select(F.col("l_suppkey").alias("ticker"), F.to_date("l_shipdate").alias("date"),
                                             "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return dedupe_last(li, ["ticker", "date"], ["l_orderkey", "l_linenumber"])


def q_typed_features(spark, sf):
    bars = tb.event_bars(_events(spark, sf))
    return apply_feature_schema(bars, {n: n for n in ("open", "high", "low", "close", "volume")})


# 10 ------------------------------------------------ M1-M3, F9-F11, J7, U2
RAW_BASE = "data_raw"


def _no_map(df: DataFrame) -> DataFrame:
    return df.drop("params")


def q_full_manifest(spark, sf):
    cal = tb.lineitem_calendar(tb.load(spark, sf, "lineitem"))
    return _no_map(full_manifest(registry(spark), cal, raw_base=RAW_BASE))


def q_pending_tasks(spark, sf):
    """Manifest over ship days, minus the tasks of an earlier run that
    covered the order days."""
    reg = registry(spark)
    todo = full_manifest(reg, tb.lineitem_calendar(tb.load(spark, sf, "lineitem")), raw_base=RAW_BASE)
    done = full_manifest(reg, tb.load(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")),
                         raw_base=RAW_BASE)
    return _no_map(pending(todo, done))


def q_replay_manifest(spark, sf):
    tickers = lineitem_codes(tb.load(spark, sf, "lineitem")).select("ticker")
    return _no_map(replay_manifest(registry(spark), tickers, raw_base=RAW_BASE))


# 11 ------------------------------------------------ D1-D5, W3, W4, P12
def q_winsorize(spark, sf):
    li = tb.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return winsorize(li, {"l_extendedprice": (0.001, 0.999)}, suffix="_w")


def q_fill(spark, sf):
    bars = tb.event_bars(_events(spark, sf))
    return fill_missing(join_daily(events_grid(bars), bars, "bars"), {"feat_volume_bars": "fill_zero"})


def q_ffill(spark, sf):
    bars = tb.event_bars(_events(spark, sf))
    return ffill(join_daily(events_grid(bars), bars, "bars"), ["feat_close_bars"])


def q_split(spark, sf):
    return assign_split(events_grid(tb.event_bars(_events(spark, sf))))


def q_avail_shift(spark, sf):
    bars = tb.event_bars(_events(spark, sf))
    cal = tb.event_calendar(bars)
    m = shift_available(tb.market_daily(bars), cal, "T_plus_1", out="eff_t1")
    return shift_available(m, cal, "T_plus_5", out="eff_t5")


def q_avail_announce(spark, sf):
    od = tb.load(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    cal = tb.lineitem_calendar(tb.load(spark, sf, "lineitem"))
    return shift_available(od, cal, "announcement_date", avail_col="o_orderdate")


def q_calendar_enriched(spark, sf):
    return enrich_calendar(tb.lineitem_calendar(tb.load(spark, sf, "lineitem")))


def q_is_suspended(spark, sf):
    li = tb.load(spark, sf, "lineitem")
    grid = base_grid(tb.supplier_universe(tb.load(spark, sf, "supplier")), tb.lineitem_calendar(li))
    return suspension(grid, tb.return_spans(li), count="n_open")


def q_is_member(spark, sf):
    od = tb.order_source(tb.load(spark, sf, "orders")).select("ticker", "date", "o_orderkey")
    cust = tb.load(spark, sf, "customer")
    return membership(od, cust.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("ticker")))


# 12 ------------------------- gaps, missing and repeated prices, times, look-ahead
def weekdays(cal: DataFrame) -> DataFrame:
    """The calendar without its Saturdays and Sundays: sources still have rows on them."""
    return cal.where(~F.dayofweek("date").isin(1, 7))


def q_labels_gapped(spark, sf):
    """Labels over a calendar with gaps; prices on closed days cannot be seen."""
    li = tb.load(spark, sf, "lineitem")
    cal = weekdays(tb.lineitem_calendar(li))
    uni, days = tb.supplier_universe(tb.load(spark, sf, "supplier")), tb.lineitem_calendar(li)
    grid = base_grid(uni, days)
    return forward_labels(grid, tb.lineitem_bars(li), cal, "price", universe=uni, days=days)


def q_calendar_gapped(spark, sf):
    return enrich_calendar(weekdays(tb.lineitem_calendar(tb.load(spark, sf, "lineitem"))))


def q_avail_shift_gapped(spark, sf):
    bars = tb.event_bars(_events(spark, sf))
    cal = weekdays(tb.event_calendar(bars))
    m = shift_available(tb.market_daily(bars), cal, "T_plus_1", out="eff_t1")
    return shift_available(m, cal, "T_plus_5", out="eff_t5")


def q_gold_gapped(spark, sf):
    """Fused gold on weekdays; signups and weekly reports dated on closed days wait for the next open one."""
    ev = _events(spark, sf)
    bars = tb.event_bars(ev)
    cal = weekdays(tb.event_calendar(bars))
    return assemble_gold(base_grid(tb.event_universe(bars), cal), cal, daily=[AsofSource("bars", bars)],
                         slow=[AsofSource("signup", tb.signup_source(ev), tie_break=PANEL_TIES["signup"])],
                         market_slow=[AsofSource("weekly", tb.weekly_purchase_report(ev))], labels=LabelSpec(bars, "close"))


def q_labels_nan(spark, sf):
    """A day's close is NaN where the user had an error that day, and zero where the day had one event."""
    ev = _events(spark, sf)
    bars = tb.event_bars(ev)
    bad = ev.where(F.col("event_type") == "error").select(F.col("user_id").alias("ticker"), F.to_date("ts").alias("date"), F.lit(True).alias("bad")).distinct()
    px = bars.join(bad, ["ticker", "date"], "left").withColumn(
        "close", F.when(F.col("bad"), float("nan")).when(F.col("volume") == 1, 0.0).otherwise(F.col("close"))).drop("bad")
    return forward_labels(events_grid(bars), px, tb.event_calendar(bars), "close")


def q_labels_dup(spark, sf):
    """Several raw prices a day: the last by (order, line) counts (A6 inside W2)."""
    li = tb.load(spark, sf, "lineitem")
    px = li.select(F.col("l_suppkey").alias("ticker"), F.to_date("l_shipdate").alias("date"), "l_extendedprice", "l_orderkey", "l_linenumber")
    cal = tb.lineitem_calendar(li)
    uni = tb.supplier_universe(tb.load(spark, sf, "supplier"))
    grid = base_grid(uni, cal)
    return forward_labels(grid, px, cal, "l_extendedprice", price_order=["l_orderkey", "l_linenumber"], universe=uni)


def q_asof_market_ts(spark, sf):
    """Every event against the latest error event of any user at or before it, in time."""
    ev = _events(spark, sf)
    errors = ev.where(F.col("event_type") == "error").select("ts", F.col("event_id").alias("error_id"), F.col("value").alias("error_value"))
    return asof_join(ev.select("event_id", "ts"), AsofSource("errors", errors, tie_break=["error_id"]), by=None, date="ts")


def q_asof_day_time(spark, sf):
    """Days against a source with times: the last signup of the latest day that has one."""
    ev = _events(spark, sf)
    src = (ev.where(F.col("event_type") == "signup")
           .select(F.col("user_id").alias("ticker"), F.col("ts").alias("date"), F.col("value").alias("signup_value"), F.col("event_id").alias("signup_id")))
    return asof_join(events_grid(tb.event_bars(ev)), AsofSource("signups", src, tie_break=["signup_id"]), by="ticker")


AVAIL_RULES = {"market": "T_plus_1", "bars": "T_day_1500"}


def q_panel_available(spark, sf):
    """The panel by availability: market numbers are seen a trading day later."""
    ev = _events(spark, sf)
    bars = tb.event_bars(ev)
    cal = weekdays(tb.event_calendar(bars))
    return assemble(base_grid(tb.event_universe(bars), cal), [("bars", bars), ("market", tb.market_daily(bars))],
                    freqs={"bars": "D", "market": "D"}, calendar=cal, avail=AVAIL_RULES)


def q_lookahead_violations(spark, sf):
    """The audit of a naive same-day join of T_plus_1 numbers: every joined row sees the future."""
    bars = tb.event_bars(_events(spark, sf))
    cal = weekdays(tb.event_calendar(bars))
    market = shift_available(tb.market_daily(bars), cal, "T_plus_1", out="effective_date_market")
    naive = base_grid(tb.event_universe(bars), cal).join(market, "date", "left")
    return lookahead_audit(naive)


# fixed bounds, both boundary days of a gap and of a change among the ship days
SPLITS_INSIDE = (("train", "1993-01-01", "1995-01-01"), ("validation", "1995-01-03", "1997-01-01"), ("test", "1997-01-01", "1998-06-30"))


def q_split_inside(spark, sf):
    """Splits whose bounds lie inside the ship days, so each branch and boundary occurs."""
    return assign_split(tb.lineitem_calendar(tb.load(spark, sf, "lineitem")), SPLITS_INSIDE)


QUERIES = {
    "labels_gapped": q_labels_gapped,
    "calendar_gapped": q_calendar_gapped,
    "avail_shift_gapped": q_avail_shift_gapped,
    "gold_gapped": q_gold_gapped,
    "labels_nan": q_labels_nan,
    "labels_dup": q_labels_dup,
    "asof_market_ts": q_asof_market_ts,
    "asof_day_time": q_asof_day_time,
    "panel_available": q_panel_available,
    "lookahead_violations": q_lookahead_violations,
    "split_inside": q_split_inside,
    "bars": q_bars,
    "base_grid": q_base_grid,
    "join_daily": q_join_daily,
    "join_market": q_join_market,
    "labels": q_labels,
    "labels_lineitem": q_labels_lineitem,
    "asof_keyed": q_asof_keyed,
    "asof_market": q_asof_market,
    "asof_orders": q_asof_orders,
    "asof_events": q_asof_events,
    "asof_hot": q_asof_hot,
    "ffill_hot": q_ffill_hot,
    "asof_restated": q_asof_restated,
    "panel": q_panel,
    "gold": q_gold,
    "gold_unfused": q_gold_unfused,
    "gold_lineitem": q_gold_lineitem,
    "export_cpt": q_export_cpt,
    "export_sft": q_export_sft,
    "export_txt": q_export_txt,
    "missing_report": q_missing_report,
    "describe": q_describe,
    "label_na": q_label_na,
    "lookahead": q_lookahead,
    "stats_summary": q_stats_summary,
    "silver_orders": q_silver_orders,
    "silver_union": q_silver_union,
    "union_drift": q_union_drift,
    "date_forms": q_date_forms,
    "panel_landed": q_panel_landed,
    "exchange_code": q_exchange_code,
    "dedupe_last": q_dedupe_last,
    "typed_features": q_typed_features,
    "full_manifest": q_full_manifest,
    "pending_tasks": q_pending_tasks,
    "replay_manifest": q_replay_manifest,
    "winsorize": q_winsorize,
    "fill": q_fill,
    "ffill": q_ffill,
    "split": q_split,
    "avail_shift": q_avail_shift,
    "avail_announce": q_avail_announce,
    "calendar_enriched": q_calendar_enriched,
    "is_member": q_is_member,
    "is_suspended": q_is_suspended,
}
