"""Panel inputs derived from the driver tables.

The driver data has no market prices, so the panel stands in as follows
(all derived by Spark from whole tables):

* events: entity = ``user_id``, trading day = event date; daily bars are
  open/high/low/close of ``value`` by time and the event count as volume.
  The calendar is the set of event dates, the universe the set of users.
* keyed slow source: each user's ``signup`` events (as-of per user).
* market-wide slow source: a weekly purchase report, published on the last
  day (Sunday) of each ISO week (as-of without key).
* market-wide daily source: per-day event count and maximum value, rolled
  up from the bars.
* lineitem: entity = supplier (``supplier`` table is the universe), day =
  ship date, price = the day's highest extended price; a supplier's
  returned lines are its keyed slow source, and a per-day roll-up of the
  bars its market-wide daily source.
* orders: an irregular keyed source with same-day ties (tie-break
  ``o_orderkey``) for customers (``customer`` is the universe), on a
  monthly calendar made of each month's first order date.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.functions.scalar import ticker_of
from pitlake.sources.sinks import shuffles_freed, write_raw

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day(c: str):
    return F.to_date(F.col(c))


# ---------------------------------------------------------------- events panel
def event_bars(events: DataFrame) -> DataFrame:
    """Daily bars per (user, day): open/close by time, high/low, event count."""
    return (events.select(F.col("user_id").alias("ticker"), _day("ts").alias("date"), "ts", "value")
            .groupBy("ticker", "date")
            .agg(F.min_by("value", "ts").alias("open"), F.max("value").alias("high"),
                 F.min("value").alias("low"), F.max_by("value", "ts").alias("close"),
                 F.count(F.lit(1)).alias("volume")))


def event_calendar(bars: DataFrame) -> DataFrame:
    """Trading days = days with any event (every event has a user, so the
    bars' dates are exactly the event dates; no second scan of events)."""
    return bars.select("date").distinct()


def event_universe(bars: DataFrame) -> DataFrame:
    return bars.select("ticker").distinct()


def signup_source(events: DataFrame) -> DataFrame:
    """Keyed slow source: every signup event of a user, dated by its day."""
    return (events.where(F.col("event_type") == "signup")
            .select(F.col("user_id").alias("ticker"), _day("ts").alias("date"),
                    F.col("value").alias("signup_value"), F.col("ts").alias("signup_ts")))


def stream_events(events: DataFrame) -> DataFrame:
    """Events under the stream they come in by: all views, signups and errors
    share one (more than half of all rows), the others go by user."""
    shared = F.col("event_type").isin("view", "signup", "error")
    return events.withColumn("stream", F.when(shared, F.lit("shared")).otherwise(F.col("user_id").cast("string")))


def weekly_purchase_report(events: DataFrame) -> DataFrame:
    """Market-wide slow source: one row per ISO week, dated the week's Sunday."""
    week_end = F.date_add(F.to_date(F.date_trunc("week", F.col("ts"))), 6)
    return (events.where(F.col("event_type") == "purchase")
            .groupBy(week_end.alias("date"))
            .agg(F.max("value").alias("max_purchase"), F.count(F.lit(1)).alias("n_purchases")))


def market_daily(bars: DataFrame) -> DataFrame:
    """Market-wide daily source: one row per day, rolled up from the bars
    (event count = sum of volumes, max value = max of highs)."""
    return (bars.groupBy("date")
            .agg(F.sum("volume").alias("n_events"), F.max("high").alias("max_value")))


# -------------------------------------------------------------- lineitem panel
def lineitem_bars(lineitem: DataFrame) -> DataFrame:
    return (lineitem.select(F.col("l_suppkey").alias("ticker"), _day("l_shipdate").alias("date"),
                            "l_extendedprice")
            .groupBy("ticker", "date")
            .agg(F.max("l_extendedprice").alias("price"), F.count(F.lit(1)).alias("n_lines")))


def supplier_returns(lineitem: DataFrame) -> DataFrame:
    """Keyed slow source: every returned line of a supplier, dated by ship day."""
    return (lineitem.where(F.col("l_returnflag") == "R")
            .select(F.col("l_suppkey").alias("ticker"), _day("l_shipdate").alias("date"),
                    F.col("l_extendedprice").alias("ret_price"), F.col("l_quantity").alias("ret_qty"),
                    "l_orderkey", "l_linenumber"))


def return_spans(lineitem: DataFrame) -> DataFrame:
    """Spans per supplier: each returned line, from its ship day for as many days as its
    quantity; the last lines of large orders stay open.  They overlap and repeat."""
    day = _day("l_shipdate")
    still_open = (F.col("l_linenumber") == 7) & (F.col("l_quantity") >= 49)
    return (lineitem.where(F.col("l_returnflag") == "R")
            .select(F.col("l_suppkey").alias("ticker"), day.alias("start"),
                    F.when(~still_open, F.date_add(day, F.col("l_quantity").cast("int"))).alias("end")))


def order_reports(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Restated reports per supplier: each line speaks of its order's quarter and becomes known on
    its ship day, in no order of quarters."""
    od = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.trunc(_day("o_orderdate"), "quarter").alias("quarter"))
    lines = lineitem.select(F.col("l_suppkey").alias("ticker"), _day("l_shipdate").alias("date"), "l_orderkey", "l_linenumber",
                            F.col("l_extendedprice").alias("price"))        # days, not times, are shuffled
    return lines.join(od, "l_orderkey").select("ticker", "date", "quarter", "l_orderkey", "l_linenumber", "price")


def lineitem_market(bars: DataFrame) -> DataFrame:
    """Market-wide daily source rolled up from the supplier bars."""
    return bars.groupBy("date").agg(F.sum("n_lines").alias("lines"), F.max("price").alias("top_price"))


def lineitem_calendar(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(_day("l_shipdate").alias("date")).distinct()


def supplier_universe(supplier: DataFrame) -> DataFrame:
    return supplier.select(F.col("s_suppkey").alias("ticker"))


# -------------------------------------------------------------- landed sources
def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one that ``spark.checkpoint.dir`` names;
    where it is unset, in local mode only, below a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required on a cluster")
        base = "file://" + tempfile.mkdtemp(prefix="pitlake-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def land_sources(lineitem: DataFrame, orders: DataFrame, landing: str) -> None:
    """A landing table of five registered sources, one of each kind, under
    their documented column names: prices per supplier and day (daily, keyed by the
    task), the market's day (daily), order reports of a quarter (restated,
    keyed), returned lines (event, keyed) and a monthly order summary (event, market-wide).
    A folder that holds most rows (``static``) is written by the many tasks that make them, without a shuffle for it; reports are
    dealt by quarter as numbers and written out as text after.  The shuffle files of each source are deleted when it has landed."""
    static = F.lit("static")
    prices = lineitem_bars(lineitem).select(ticker_of(F.col("ticker")).alias("ticker"), F.col("date").alias("data_date"), F.col("price").alias("收盘"),
                                            F.col("n_lines").alias("成交量"), F.col("price").alias("后复权价"), static.alias("date"))
    # sorted, a file holds each ticker once
    prices = prices.sortWithinPartitions("ticker", "data_date")
    market = lineitem.groupBy(_day("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("lines"), F.max("l_extendedprice").alias("top_price"))
    market = market.select(F.date_format("day", "yyyyMMdd").alias("信用交易日期"), "lines", "top_price", F.date_format("day", "yyyy0101").alias("date"))
    reports = order_reports(lineitem, orders).hint("rebalance", "quarter").select(
        F.col("ticker").cast("string").alias("股票代码"), F.date_format("date", "yyyy/M/d").alias("最新公告日期"), "l_orderkey", "l_linenumber",
        "price", F.date_format("quarter", "yyyyMMdd").alias("date"))
    returns = supplier_returns(lineitem).select(F.col("ticker").cast("string").alias("证券代码"), F.col("date").alias("变更日期"), "ret_price", "ret_qty",
                                                "l_orderkey", "l_linenumber", static.alias("date"))
    month_end = F.last_day(_day("o_orderdate"))
    macro = (orders.groupBy(month_end.alias("m")).agg(F.max("o_totalprice").alias("top_order"), F.count(F.lit(1)).alias("n_orders"))
             .select(F.date_format("m", "yyyy-MM-dd 18:00:00").alias("时间"), "top_order", "n_orders", static.alias("date")))
    with shuffles_freed(lineitem.sparkSession):
        # the reports, which shuffle most, while nothing else has landed
        for domain, interface, df in (("eastmoney.com", "stock_yjbb_em", reports), ("sina", "stock_zh_a_hist", prices),
                                      ("sse.com.cn", "stock_margin_sse", market.hint("rebalance", "date")),
                                      ("cninfo.com.cn", "stock_industry_change_cninfo", returns), ("wsj.com", "macro_info_ws", macro)):
            write_raw(df.withColumns({"source_domain": F.lit(domain), "interface": F.lit(interface)}), landing)


# ---------------------------------------------------------------- orders panel
def order_source(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_custkey").alias("ticker"), _day("o_orderdate").alias("date"),
                         "o_orderkey", "o_totalprice", "o_orderstatus")


def monthly_calendar(orders: DataFrame) -> DataFrame:
    """First order date of every month (one row per month)."""
    d = _day("o_orderdate")
    return orders.groupBy(F.trunc(d, "month").alias("m")).agg(F.min(d).alias("date")).select("date")


def customer_universe(customer: DataFrame) -> DataFrame:
    return customer.select(F.col("c_custkey").alias("ticker"))
