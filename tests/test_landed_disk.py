"""The landed panel's disk: silver in buckets is joined without a shuffle of its rows, and writes leave no shuffle files."""

import datetime as dt
import re
import time
from collections import Counter

from paths import final_plan
from pyspark.sql import functions as F

from pitlake.operators.grid import base_grid
from pitlake.operators.panel import assemble
from pitlake.plans import landed
from pitlake.plans import tables as tb
from pitlake.plans.queries import q_panel_landed
from pitlake.sources.sinks import FREE_SHUFFLES, read_silver, shuffles_freed, write_silver

SF = "/root/testdata/sf0.001"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(n)


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def sources(spark):
    """Several rows a key and day, several source days to one trading day, ties, nulls, no key, no date, keys outside the universe."""
    cal = spark.createDataFrame([(day(n),) for n in (1, 2, 5, 6, 8)], "date date")
    uni = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "ticker string")
    px = spark.createDataFrame([("a", day(3), 1.0), ("a", day(4), 2.0), ("a", day(4), 3.0), ("a", day(6), 4.0), ("b", day(0), 5.0), ("b", day(1), None),
                                ("b", day(9), 6.0), ("x", day(2), 7.0), (None, day(2), 8.0), ("c", None, 9.0)], "ticker string, date date, p double")
    at = lambda n, h: dt.datetime.combine(day(n), dt.time(h))
    slow = spark.createDataFrame([("a", at(3, 9), 1, 7), ("a", at(4, 8), 2, 1), ("a", at(4, 7), 3, 9), ("a", at(8, 1), None, 0), ("b", at(2, 1), 4, 1),
                                  ("b", at(2, 1), 4, 2), ("x", at(2, 1), 5, 1), (None, at(1, 1), 6, 1), (None, at(1, 2), 7, 1), ("c", None, 8, 1)],
                                 "ticker string, date timestamp, v int, t int")
    late = spark.createDataFrame([("a", day(1), day(-50), 1), ("a", day(3), day(-90), 2), ("a", day(4), day(-90), 3), ("a", day(6), day(-50), 4),
                                  ("b", day(2), None, 5), ("b", day(2), None, 6), ("c", day(7), day(-9), 7), (None, day(3), day(-9), 8)],
                                 "ticker string, date date, period date, q int")
    return cal, uni, {"px": px, "slow": slow, "late": late, "px2": px.withColumnRenamed("p", "p2")}


def test_rows_that_are_not_reduced_before_the_shuffle_give_the_same_panel(spark):
    cal, uni, srcs = sources(spark)
    for rule in ("T_day_1500", "T_plus_1"):
        for ties in ({}, {"slow": ["t"], "late": ["q"]}):
            args = dict(freqs={"px": "D", "slow": "event", "late": "Q", "px2": "D"}, calendar=cal, avail=dict.fromkeys(srcs, rule),
                        periods={"late": "period"}, tie_breaks=ties)
            want = assemble(base_grid(uni, cal), srcs, **args)
            for hot in (None, {}, {"slow": (["a", None], srcs["slow"]), "late": (["b"], srcs["late"])}):
                got = assemble(base_grid(uni, cal), srcs, universe=uni, hot=hot, parts=3 if hot else None, **args)
                assert got.schema.simpleString() == want.schema.simpleString()
                assert rows_of(got) == rows_of(want)


def test_landed_panel_does_not_shuffle_silver_again(spark, monkeypatch):
    out = q_panel_landed(spark, SF)
    plan = final_plan(out)
    deals = re.findall(r"Exchange hashpartitioning\(([^)]*)\), (\w+)", plan)
    # by entity: the universe alone, once made distinct and once dealt like the buckets
    assert [how for keys, how in deals if "ticker" in keys or "__k" in keys] == ["REPARTITION_BY_NUM", "ENSURE_REQUIREMENTS"], deals
    want = rows_of(out)
    monkeypatch.setattr(landed, "HOT_ROWS", 300)        # every key of the larger sources counts as crowded
    monkeypatch.setattr(landed, "BUCKET_ROWS", 100)
    assert rows_of(q_panel_landed(spark, SF)) == want


def test_crowded_keys(spark, monkeypatch):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)] * 4, "ticker string")
    assert landed.crowded_keys(df) == []
    monkeypatch.setattr(landed, "HOT_ROWS", 3)
    assert set(landed.crowded_keys(df)) == {"a", None}
    assert landed.crowded_keys(df.limit(3)) == []


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_landing_and_silver_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    tb.land_sources(tb.load(spark, SF, "lineitem"), tb.load(spark, SF, "orders"), f"{tmp_path}/landing")
    landed.write_landed_silver(spark, f"{tmp_path}/landing", f"{tmp_path}/silver", buckets=4)
    ours = re.compile(r"shuffle_\d+_\d+_\d+\.data")
    until = time.time() + 20
    while (left := {f for f in shuffle_files(spark) - before if ours.match(f)}) and time.time() < until:
        time.sleep(0.5)
    assert not left
    assert spark.conf.get(FREE_SHUFFLES) == "false"


def test_setting_is_put_back_after_a_failure(spark):
    was = spark.conf.get(FREE_SHUFFLES)
    try:
        with shuffles_freed(spark):
            assert spark.conf.get(FREE_SHUFFLES) == "true"
            raise KeyError
    except KeyError:
        assert spark.conf.get(FREE_SHUFFLES) == was


def test_buckets_hold_every_row_once(spark, tmp_path):
    df = spark.range(2000).select(F.when(F.col("id") % 3 > 0, (F.col("id") % 7).cast("string")).alias("ticker"), F.col("id"))
    path = write_silver(df, f"{tmp_path}/s", "many", buckets=5)
    table, loose = read_silver(spark, f"{tmp_path}/s", "many"), read_silver(spark, f"{tmp_path}/s", "many", bucketed=False)
    assert rows_of(table) == rows_of(loose) == rows_of(df)
    assert "Bucketed: true" in final_plan(table.groupBy("ticker").count()) and "Bucketed: true" not in final_plan(loose.groupBy("ticker").count())
    assert {f.rsplit("_", 1)[1][:5] for f in spark.read.parquet(path).inputFiles()} <= {f"{i:05d}" for i in range(5)}
