"""Whole grids by spans of days against the step-by-step joins, and the landing table's large folders."""

import datetime as dt
import glob
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pitlake.functions.scalar import DATE_FORMS, parse_date, with_date
from pitlake.operators.gold import LabelSpec, assemble_gold
from pitlake.operators.grid import base_grid
from pitlake.operators.joins import AsofSource
from pitlake.operators.panel import assemble
from pitlake.plans import tables as tb


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def sources(spark):
    cal = spark.createDataFrame([(day(n),) for n in (1, 2, 3, 6, 7, 9)], "date date")
    uni = spark.createDataFrame([("a",), ("b",), ("c",), ("c",)], "ticker string")
    # repeated days, a day off the calendar, an entity outside the universe, no key
    px = spark.createDataFrame([("a", day(2), 1.0), ("a", day(2), 2.0), ("a", day(7), 3.0), ("b", day(9), 4.0), ("b", day(4), 5.0), ("x", day(2), 6.0),
                                (None, day(2), 7.0)], "ticker string, date date, p double")
    slow = spark.createDataFrame([("a", day(0), 1), ("a", day(4), 2), ("a", day(5), 3), ("c", day(7), None), ("c", day(20), 5), ("x", day(1), 6)],
                                 "ticker string, date date, v int")
    late = spark.createDataFrame([("a", day(1), day(-50), 1), ("a", day(3), day(-90), 2), ("a", day(7), day(-50), 3), ("b", day(2), None, 4)],
                                 "ticker string, date date, period date, q int")
    mkt = spark.createDataFrame([(day(n), n) for n in (1, 3, 9)], "date date, m int")
    return cal, uni, [("slow", slow), ("mkt", mkt), ("px", px), ("late", late), ("px2", px.withColumnRenamed("p", "p2"))]


def test_by_spans_gives_the_rows_of_the_joins(spark):
    cal, uni, srcs = sources(spark)
    for avail in (None, {"px": "T_plus_1", "slow": "T_day_1500", "mkt": "T_plus_1", "late": "T_plus_1"}):
        args = dict(freqs={"slow": "event", "mkt": "D", "px": "D", "late": "Q", "px2": "D"}, calendar=cal, avail=avail, periods={"late": "period"})
        want = assemble(base_grid(uni, cal), srcs, **args)
        got = assemble(base_grid(uni, cal), srcs, universe=uni, **args)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
        assert want.count() > 24


def test_by_spans_of_no_days_and_no_sources(spark):
    cal, uni, srcs = sources(spark)
    args = dict(freqs={"slow": "event"}, calendar=cal)
    assert assemble(base_grid(uni, cal), [], universe=uni, **args).count() == 24
    none = cal.where("date IS NULL")
    assert assemble(base_grid(uni, none), srcs[:1], freqs={"slow": "event"}, calendar=none, universe=uni).count() == 0


def test_static_folder_is_written_by_many_tasks(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10k"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        tb.land_sources(tb.load(spark, sf, "lineitem"), tb.load(spark, sf, "orders"), f"{tmp_path}/landing")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(glob.glob(f"{tmp_path}/landing/*/interface=stock_zh_a_hist/date=static/*.parquet")) > 1


def test_with_date_reads_every_form(spark):
    vals = ["20240930", "202409", "2024/9/30 15:00", "2024-09", "2024年9月30日", "2024年09月份", "20240930.0", "2024-02-30", "static", "2024-09-30\n", "-5", None]
    rows = with_date(spark.createDataFrame([(v,) for v in vals], "v string"), "d", "v").withColumn("e", parse_date("v")).collect()
    want = [dt.date(2024, 9, 30), dt.date(2024, 9, 1)]
    assert [r.d for r in rows] == [want[0], want[1], want[0], want[1], want[0], want[1], want[0], None, None, want[0], None, None]
    assert [r.e for r in rows] == [r.d for r in rows] and len(DATE_FORMS) == 5


def test_fused_gold_by_spans_gives_the_rows_of_the_stack(spark):
    cal, uni, srcs = sources(spark)
    srcs = dict(srcs)
    px = srcs["px"].where("ticker IS NOT NULL AND p <> 2").withColumn("n", F.lit(1))
    args = dict(daily=[AsofSource("px", px, unique=True)], slow=[AsofSource("slow", srcs["slow"]), AsofSource("late", srcs["late"], period="period")],
                market_daily=[("mkt", srcs["mkt"])], labels=LabelSpec(px, "p", horizons=(1, 2)))
    want = assemble_gold(base_grid(uni, cal), cal, **args)
    plan = assemble_gold(base_grid(uni, cal), cal, universe=uni, **args)
    assert plan.schema.simpleString() == want.schema.simpleString()
    assert Counter(map(tuple, plan.collect())) == Counter(map(tuple, want.collect()))
    twice = {**args, "labels": LabelSpec(px.unionByName(px.where("p = 1")), "p")}
    with pytest.raises(Exception, match="several prices"):
        assemble_gold(base_grid(uni, cal), cal, universe=uni, **twice).collect()
