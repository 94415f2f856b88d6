"""Scans (S1-S5), normalisation (P1-P4, P8, P11, P12, U1), treatments."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paths import FIXTURES
from pitlake.functions.scalar import ticker_of
from pitlake.operators.calendar import calendar_index, enrich_calendar, shift_available
from pitlake.operators.normalise import (apply_schema, attach_key, date_report, normalise, normalise_date, pick_date_key,
                                         rename_by_map, union_sources)
from pitlake.operators.treat import assign_split, ffill, fill_missing, membership, winsorize
from pitlake.sources.files import read_calendar, read_prices, read_universe, read_window, window_bounds


def D(s):
    return dt.date.fromisoformat(s)


def test_read_prices_and_universe(spark):
    px = read_prices(spark, f"{FIXTURES}/price_*.csv")
    assert px.count() == 426
    assert {r.ticker for r in px.select("ticker").distinct().collect()} == {"600519.SH", "601318.SH"}
    u = read_universe(spark, f"{FIXTURES}/CSI300.csv", with_weight=True)
    rows = u.collect()
    assert len(rows) == 300
    t = {r.ticker for r in rows}
    assert "600519.SH" in t and "000651.SZ" in t and "000063.SZ" in t       # leading zeros kept (T3)
    assert {r.weight for r in rows if r.ticker == "600519.SH"} == {4.129}


def test_calendar_and_window(spark, tmp_path):
    p = tmp_path / "cal.csv"
    p.write_text("trade_date\n2024-01-03\n2024-01-02\n")
    cal = read_calendar(spark, str(p))
    assert [r.date for r in calendar_index(cal).orderBy("idx").collect()] == [D("2024-01-02"), D("2024-01-03")]
    assert window_bounds(read_window(spark, f"{FIXTURES}/smoke_dates.txt")) == (D("2025-08-11"), D("2025-08-15"))
    assert window_bounds(read_window(spark, str(tmp_path / "missing.txt"))) == (D("2024-12-30"), D("2025-08-15"))


def test_exchange_suffix(spark):
    df = spark.createDataFrame([(" 600519 ",), ("651",), ("300750",)], "c string")
    assert [r.t for r in df.select(ticker_of("c").alias("t")).collect()] == ["600519.SH", "000651.SZ", "300750.SZ"]


def test_normalise_steps(spark):
    raw = spark.createDataFrame([("2024-01-02", 1.0), ("bad", 2.0)], "`日期` string, `收盘` double")
    out = normalise(raw, {"日期": "date", "收盘": "close", "absent": "x"}, ticker="600519.SH")
    assert out.columns == ["close", "effective_date", "ticker"]
    assert [r.effective_date for r in out.collect()] == [D("2024-01-02"), None]
    assert pick_date_key(out).columns == ["close", "date", "ticker"]
    assert attach_key(out, "X").collect()[0].ticker == "600519.SH"
    assert normalise_date(spark.createDataFrame([(1,)], "a int")).columns == ["a"]
    assert rename_by_map(raw, {"nope": "x"}).columns == raw.columns
    u = union_sources([spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x",)], "b string")])
    assert u.columns == ["a", "b"] and u.count() == 2
    typed = apply_schema(spark.createDataFrame([("1.5", "7")], "v string, f string"), [("v", "float64"), ("f", "int8")])
    assert typed.schema["v"].dataType.typeName() == "double" and typed.collect()[0].f == 7


def test_treatments(spark):
    df = spark.createDataFrame([("A", D("2024-01-0%d" % i), float(i) if i != 3 else None) for i in range(1, 6)],
                               "ticker string, date date, x double")
    ff = {r.date.day: r.x for r in ffill(df, ["x"]).collect()}
    assert ff[3] == 2.0
    fz = {r.date.day: r.x for r in fill_missing(df, {"x": "fill_zero"}).collect()}
    assert fz[3] == 0.0
    w = {r.date.day: r.x for r in winsorize(df, {"x": (0.25, 0.75)}).collect()}
    assert w[1] == pytest.approx(1.75) and w[5] == pytest.approx(4.25) and w[3] is None
    sp = spark.createDataFrame([(D(d),) for d in ("2024-01-01", "2024-01-02", "2024-01-03", "2025-01-01",
                                                    "2025-08-15", "2019-12-29")], "date date")
    assert [r.split for r in assign_split(sp).collect()] == [None, None, "validation", "test", "test", None]
    m = membership(df, spark.createDataFrame([("A",), ("A",)], "ticker string"))
    assert {r.is_member for r in m.collect()} == {1} and m.count() == 5


def test_calendar_enrich_and_shift(spark):
    cal = spark.createDataFrame([(D(d),) for d in ("2024-01-02", "2024-01-03", "2024-01-05")], "date date")
    e = {r.date.day: r for r in enrich_calendar(cal).collect()}
    assert e[2].prev_trade_date is None and e[3].next_trade_date == D("2024-01-05") and e[5].next_trade_date is None
    src = spark.createDataFrame([(D("2024-01-02"), D("2024-01-04")), (D("2024-01-05"), D("2024-01-06"))],
                                "date date, ann date")
    t1 = {r.date.day: r.effective_date for r in shift_available(src, cal, "T_plus_1").collect()}
    assert t1 == {2: D("2024-01-03"), 5: None}
    an = {r.date.day: r.effective_date for r in shift_available(src, cal, "announcement_date", avail_col="ann").collect()}
    assert an == {2: D("2024-01-05"), 5: None}


def test_ffill_split_equals_whole(spark):
    import random
    rnd = random.Random(5)
    rows = [(rnd.choice("AB"), dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randint(0, 24 * 9)),
             rnd.choice([None, None, float(rnd.randint(0, 99))])) for _ in range(200)]
    rows = list({(k, t): (k, t, v) for k, t, v in rows}.values())       # unique (key, time)
    df = spark.createDataFrame(rows, "ticker string, ts timestamp_ntz, x double")
    a = sorted(map(tuple, ffill(df, ["x"], order="ts").collect()))
    b = sorted(map(tuple, ffill(df, ["x"], order="ts", split="day").collect()))
    assert a == b


def test_normalise_registered_sources(spark):
    from pitlake.operators.normalise import normalise_source
    from pitlake.operators.panel import assemble
    from pitlake.sources.registry import KEY_COLUMNS, SOURCES

    assert set(KEY_COLUMNS) == {s[0] for s in SOURCES}
    # quarterly report: code column + announcement date -> keyed as-of source
    raw = spark.createDataFrame([("600519", "2024-01-02", 1.5), ("000651", "2024-01-04", 2.5)],
                                "`股票代码` string, `最新公告日期` string, `每股收益` double")
    silver = normalise_source(raw, "stock_yjbb_em")
    assert {r.ticker for r in silver.collect()} == {"600519.SH", "000651.SZ"}
    assert "effective_date" in silver.columns
    # market-wide daily summary without a date column: dated by the fetch date
    summ = spark.createDataFrame([("股票", 10)], "`证券类别` string, `数量` bigint")
    s2 = normalise_source(summ, "stock_szse_summary", fetch_date="20240103")
    assert s2.collect()[0].effective_date == D("2024-01-03") and "ticker" not in s2.columns
    grid = spark.createDataFrame([("600519.SH", D("2024-01-03")), ("000651.SZ", D("2024-01-03"))],
                                 "ticker string, date date")
    panel = assemble(grid, [("stock_yjbb_em", silver), ("stock_szse_summary", s2)])
    r = {x.ticker: x for x in panel.collect()}
    assert r["600519.SH"]["feat_每股收益_stock_yjbb_em"] == 1.5 and r["000651.SZ"]["feat_每股收益_stock_yjbb_em"] is None
    assert r["000651.SZ"]["feat_数量_stock_szse_summary"] == 10


def test_declared_feature_schema(spark):
    from pitlake.operators.treat import apply_feature_schema
    df = spark.createDataFrame([("A", D("2024-01-02"), "1.5", None, 7), ("A", D("2024-01-03"), "bad", 1, None)],
                               "ticker string, date date, o string, m int, v bigint")
    out = apply_feature_schema(df, {"open": "o", "is_member": "m", "volume": "v"})
    types = {f.name: f.dataType.typeName() for f in out.schema.fields}
    assert types["o"] == "double" and types["m"] == "byte" and types["v"] == "double"
    rows = {r.date.day: r for r in out.collect()}
    assert rows[2].o == 1.5 and rows[3].o is None            # unparseable -> null, no failure
    assert rows[2].m == 0 and rows[3].m == 1                  # is_member: fill_zero
    assert rows[3].v is None                                  # volume: keep_nan


def test_date_key_cast_and_trade_date(spark):
    from pitlake.operators.normalise import pick_date_key, to_date_key
    ts = spark.createDataFrame([(dt.datetime(2025, 8, 11, 15, 0),)], "date timestamp_ntz")
    assert to_date_key(ts).collect()[0].date == D("2025-08-11")          # P11: timestamp -> day
    cal = spark.createDataFrame([(D("2024-01-02"),)], "trade_date date")
    assert pick_date_key(cal).columns == ["date"]                          # P4: calendar's trade_date
    both = spark.createDataFrame([(D("2024-01-01"), D("2024-01-02"))], "date date, effective_date date")
    assert pick_date_key(both).collect()[0].date == D("2024-01-02")        # effective_date wins


def test_empty_window_file_means_whole_calendar(spark, tmp_path):
    from pitlake.operators.grid import base_grid
    p = tmp_path / "empty.txt"
    p.write_text("\n")
    lo, hi = window_bounds(read_window(spark, str(p)))
    assert (lo, hi) == (None, None)
    cal = spark.createDataFrame([(D("2024-01-02"),), (D("2024-01-03"),)], "date date")
    assert base_grid(spark.createDataFrame([("A",)], "ticker string"), cal, lo, hi).count() == 2


def test_date_forms(spark):
    forms = {"20240930": "2024-09-30", "2024-09-30": "2024-09-30", "2024/9/3 15:00": "2024-09-03", "2024-09-30T08:00:00": "2024-09-30",
             "202409": "2024-09-01", "2024-09": "2024-09-01", "2024年9月30日": "2024-09-30", "2024年09月份": "2024-09-01", " 2024.01.05 ": "2024-01-05",
             "20240230": None, "2024-13-01": None, "上午": None, "24-01-05": None, "2024": None, "": None, None: None}
    df = spark.createDataFrame([(k,) for k in forms], "date string")
    out = normalise_date(df.withColumn("raw", F.col("date")))
    assert {r.raw: r.effective_date and r.effective_date.isoformat() for r in out.collect()} == forms
    numbers = spark.createDataFrame([(20240930, 20240930.0)], "a bigint, b double")
    assert [normalise_date(numbers, c).collect()[0].effective_date for c in "ab"] == [D("2024-09-30")] * 2
    got = {(r.column, r.form): (r.rows, r.parsed, r.percent) for r in date_report(df, ["date"]).collect()}
    assert got[("date", "yyyymmdd")] == (2, 1, 12.5) and got[("date", "separated")] == (5, 4, 31.25)
    assert got[("date", None)] == (5, 0, 31.25) and sum(v[0] for v in got.values()) == 16
    assert date_report(df.limit(0), ["date"]).count() == 0
