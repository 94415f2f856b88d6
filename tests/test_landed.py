"""One run over several landed sources; unions of frames whose types differ."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.operators.grid import base_grid
from pitlake.operators.normalise import common_type, union_sources
from pitlake.plans.landed import landed_interfaces, run_landed

D = dt.date.fromisoformat
DAYS = [D(f"2024-01-{d:02d}") for d in (2, 3, 4, 5, 8, 9, 10)]


def _land(spark, base, domain, interface, rows, schema, date="static", ticker=None):
    df = spark.createDataFrame(rows, schema)
    (df.withColumn("ticker", F.lit(ticker).cast("string")).withColumn("task_id", F.lit("t"))
     .coalesce(1).write.mode("append").parquet(f"{base}/source_domain={domain}/interface={interface}/date={date}/task=part-{ticker or date}"))


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("landing"))
    for t, p0 in (("600001.SH", 100.0), ("000002.SZ", 50.0)):
        _land(spark, base, "sina", "stock_zh_a_hist", [(d, p0 + i, 2 * (p0 + i)) for i, d in enumerate(DAYS)],
              "data_date date, `收盘` double, `后复权价` double", ticker=t)
    _land(spark, base, "sina", "tool_trade_date_hist_sina", [(d,) for d in DAYS], "trade_date date")
    # D, keyed: several reasons for one stock and day
    _land(spark, base, "sina.com.cn", "stock_lhb_detail_daily_sina", [("600001", "a"), ("600001", "b"), ("bad", "c")],
          "`股票代码` string, reason string", date="20240103")
    # D, market-wide, usable a trading day later; the last day never is
    _land(spark, base, "sse.com.cn", "stock_margin_sse", [("20240103", 7), ("20240105", 8), ("20240110", 9)],
          "`信用交易日期` string, balance int", date="20240110")
    # Q, restated: the older quarter's late restatement must not displace the newer quarter; two quarters on one day
    for quarter, rows in (("20230930", [("600001", "2024-01-02", 1), ("600001", "2024-01-09", 11), ("2", "2024-01-06", 5)]),
                          ("20231231", [("600001", "2024-01-04", 2), ("2", "2024-01-07", 6)])):
        _land(spark, base, "eastmoney.com", "stock_yjbb_em", rows, "`股票代码` string, `最新公告日期` string, eps int", date=quarter)
    # event, keyed by the task's symbol
    _land(spark, base, "cninfo.com.cn", "stock_allotment_cninfo", [("600001", "2024-01-06", 3)],
          "`证券代码` string, `上市公告日期` string, share int")
    # event, market-wide, with a time of day
    _land(spark, base, "wsj.com", "macro_info_ws", [("2024-01-04 09:30:00", "gdp"), ("2024-01-09 21:00:00", "cpi")],
          "`时间` string, news string", date="20240109")
    _land(spark, base, "x.com", "not_registered", [(1,)], "v int")
    return base


def test_all_kinds_of_landed_sources_reach_gold(spark, landed, tmp_path):
    assert len(landed_interfaces(spark, landed)) == 7
    uni = spark.createDataFrame([("600001.SH",), ("000002.SZ",)], "ticker string")
    cal = spark.createDataFrame([(d,) for d in DAYS], "date date")
    reports = run_landed(spark, landed, uni, cal, str(tmp_path), horizons=(1,))
    gold = spark.read.parquet(f"{tmp_path}/gold/gold")
    rows = {}
    for r in gold.collect():
        rows.setdefault((r.ticker, r.date.day), []).append(r)
    a = lambda d, c: rows[("600001.SH", d)][0][c]       # noqa: E731
    b = lambda d, c: rows[("000002.SZ", d)][0][c]       # noqa: E731
    assert a(3, "feat_adj_close_hfq_stock_zh_a_hist") == 202 and b(8, "feat_close_stock_zh_a_hist") == 54
    # two rows for one stock and day fan out on the next trading day, the label stays one a cell
    assert sorted(r.feat_reason_stock_lhb_detail_daily_sina for r in rows[("600001.SH", 4)]) == ["a", "b"]
    assert gold.count() == 15 and len(rows) == 14
    assert all(r.r_1d == pytest.approx((206 / 204 - 1) * 1e4) for r in rows[("600001.SH", 4)])
    margin = "feat_balance_stock_margin_sse"
    assert [a(d, margin) for d in (3, 4, 5, 8, 10)] == [None, 7, None, 8, None]
    eps, period = "feat_eps_stock_yjbb_em", "feat_report_period_stock_yjbb_em"
    assert [a(d, eps) for d in (2, 3, 4, 9, 10)] == [1, 1, 2, 2, 2] and a(10, period) == D("2023-12-31")
    assert [b(d, eps) for d in (5, 8)] == [None, 6]                     # both announced at the weekend: the newer quarter
    assert [a(d, "feat_share_stock_allotment_cninfo") for d in (5, 8, 10)] == [None, 3, 3]
    assert [b(d, "feat_news_macro_info_ws") for d in (3, 4, 8, 9)] == [None, "gdp", "gdp", "cpi"]
    assert all(r.passed for r in reports["lookahead"].collect())
    acc = {r.source: r for r in reports["accounting"].collect()}
    assert [s for s, r in acc.items() if r.fans_out] == ["stock_lhb_detail_daily_sina", "gold features"]
    lhb = acc["stock_lhb_detail_daily_sina"]
    assert (lhb.silver_rows, lhb.no_key, lhb.no_date, lhb.rows_before, lhb.rows_after) == (3, 1, 0, 14, 15)
    assert acc["stock_yjbb_em"].rows_after is None and acc["gold features"].rows_after == 15


def test_union_of_drifting_types(spark):
    a = spark.createDataFrame([(1, 1, "x", D("2024-01-02"), None)], T.StructType([
        T.StructField("n", T.IntegerType()), T.StructField("m", T.LongType()), T.StructField("s", T.StringType()),
        T.StructField("d", T.DateType()), T.StructField("v", T.NullType())]))
    b = spark.createDataFrame([(2.5, 7, 5, dt.datetime(2024, 1, 3, 9), 4)], "n double, m int, s int, d timestamp_ntz, v int")
    u = union_sources([a, b, a.select("m")])
    assert [t for _, t in u.dtypes] == ["double", "bigint", "string", "timestamp_ntz", "int"]
    assert [tuple(r) for r in u.collect()] == [(1.0, 1, "x", dt.datetime(2024, 1, 2), None),
                                               (2.5, 7, "5", dt.datetime(2024, 1, 3, 9), 4), (None, 1, None, None, None)]
    # text that is no number survives beside numbers, either way round
    t = spark.createDataFrame([("--",)], "n string")
    assert [r.n for r in union_sources([t, b]).collect()] == ["--", "2.5"] == [r.n for r in union_sources([b, t]).collect()][::-1]
    assert common_type([T.DecimalType(10, 2), T.DecimalType(12, 2)]) == T.DecimalType(12, 2)
    assert common_type([T.DecimalType(10, 2), T.IntegerType()]) == T.DoubleType()
    assert common_type([T.BooleanType(), T.IntegerType()]) == T.StringType() and common_type([T.NullType()]) == T.StringType()
    m = spark.createDataFrame([(Decimal("1.50"),)], "n decimal(5,2)")
    assert [r.n for r in union_sources([m, m]).collect()] == [Decimal("1.50")] * 2
    with pytest.raises(ValueError):
        union_sources([spark.createDataFrame([([1],)], "n array<int>"), b])
    with pytest.raises(ValueError):
        union_sources([])


def test_grid_is_untouched_without_sources(spark, tmp_path):
    uni = spark.createDataFrame([("A",)], "ticker string")
    cal = spark.createDataFrame([(DAYS[0],)], "date date")
    from pitlake.plans.landed import landed_panel
    counted = {}
    p = landed_panel(spark, str(tmp_path), [], base_grid(uni, cal), cal, counted=counted)
    assert p.count() == 1 and set(counted) == {"grid"}
