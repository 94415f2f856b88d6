"""T-S1 with state: late, repeated and out-of-order files give the batch result."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pitlake.plans.landed import read_landed
from pitlake.streaming.changes import VERSION, _follow, changes_path, latest, read_changes, stream_landed, versioned

PRICES, REPORTS = ("sina", "stock_zh_a_hist"), ("eastmoney.com", "stock_yjbb_em")
HOUR = 1_700_000_000


def put(spark, base, source, name, hour, rows, schema, date="static", ticker=None):
    """One landed file, dated ``hour`` hours after a fixed time."""
    folder = f"{base}/source_domain={source[0]}/interface={source[1]}/date={date}/task=part-{name}"
    spark.createDataFrame(rows, schema).withColumn("ticker", F.lit(ticker).cast("string")).coalesce(1).write.parquet(folder)
    for f in os.listdir(folder):
        if f.endswith(".parquet"):
            os.utime(f"{folder}/{f}", (HOUR + 3600 * hour,) * 2)


def expected(spark, base, source, keys=None):
    return latest(versioned(read_landed(spark, base, *source), source[1]), keys)


def plain(df):
    return sorted(str(tuple(r)) for r in df.drop(*VERSION).collect())        # text, since NaN differs from itself


def test_stream_equals_batch(spark, tmp_path):
    base, silver, checkpoint = (str(tmp_path / n) for n in ("landing", "silver", "checkpoint"))
    price = "data_date date, close double, volume long, seen timestamp"
    t = dt.datetime(2024, 1, 5, 9, 30, 0, 123457)
    row = lambda day, close, n=(1 << 53) + 1: (dt.date(2024, 1, day), close, n, t)
    report = "`股票代码` string, `最新公告日期` string, eps int"
    put(spark, base, PRICES, "a", 5, [row(2, 1.1), row(3, 1.2), row(31, float("nan"))], price, ticker="600001.SH")
    put(spark, base, PRICES, "b", 5, [row(2, 9.0, None), (None, 3.0, 1, None)], price, ticker="000002.SZ")
    put(spark, base, REPORTS, "q3", 5, [("600001", "2024-01-02", 1), ("bad", "2024-01-02", 7)], report, date="20230930")
    schemas = {s: read_landed(spark, base, *s).schema for s in (PRICES, REPORTS)}

    def check():
        stream_landed(spark, base, silver, checkpoint, schemas, max_files_per_trigger=2)
        for s in (PRICES, REPORTS):
            want = expected(spark, base, s)
            got = read_changes(spark, silver, s[1])
            assert plain(got.select(*want.columns)) == plain(want)
        return {(r.ticker, r.effective_date): (None if r.close != r.close else r.close, r.volume) for r in read_changes(spark, silver, PRICES[1]).collect()}

    logged = lambda: spark.read.parquet(changes_path(silver, PRICES[1])).count()
    first = check()
    assert len(first) == 5 and logged() == 5 and first[("600001.SH", dt.date(2024, 1, 2))] == (1.1, (1 << 53) + 1)
    assert check() == first and logged() == 5                                              # nothing new
    put(spark, base, PRICES, "a_again", 8, [row(2, 1.1), row(3, 1.2)], price, ticker="600001.SH")       # the same rows, landed later
    assert check() == first and logged() == 5
    put(spark, base, PRICES, "a_old", 7, [row(2, 5.5), row(4, 1.4)], price, ticker="600001.SH")         # out of order: older than the repeat
    after = check()
    assert after[("600001.SH", dt.date(2024, 1, 2))][0] == 1.1 and after[("600001.SH", dt.date(2024, 1, 4))][0] == 1.4 and logged() == 6
    put(spark, base, PRICES, "a_new", 9, [row(2, 6.5)], price, ticker="600001.SH")
    put(spark, base, PRICES, "a_late", -900, [row(2, 7.5), row(9, 2.5)], price, ticker="600001.SH")     # dated weeks before the rest
    put(spark, base, REPORTS, "q4", 6, [("600001", "2024-01-02", 2)], report, date="20231231")          # another period of that day
    put(spark, base, REPORTS, "q3b", 7, [("600001", "2024-01-02", 3)], report, date="20230930")         # restated
    after = check()
    assert after[("600001.SH", dt.date(2024, 1, 2))][0] == 6.5 and after[("600001.SH", dt.date(2024, 1, 9))][0] == 2.5
    assert sorted(r.eps for r in read_changes(spark, silver, REPORTS[1]).collect()) == [2, 3, 7]


class State:
    """Stand-in for the state of one group."""

    def __init__(self):
        self.get, self.exists, self.hasTimedOut = None, False, False

    def update(self, value):
        self.get, self.exists = value, True

    def remove(self):
        self.exists = False

    def setTimeoutTimestamp(self, ms):
        assert ms == 5000


def test_state_let_go_writes_what_the_log_lacks(spark):
    """A landed, B newer, A again newest and then state let go: an old B that comes late must not win."""
    run, state = _follow(["ticker", "effective_date", "v"], ["ticker"], "effective_date"), State()

    def feed(*rows):
        f = pd.DataFrame([(10, ["k", "1970-01-11", v], at, 0, p, 5000) for v, at, p in rows], columns=["__day", "__row", *VERSION, "__ms"])
        return [tuple(r) for out in run(("k", "1970-01-01"), iter([f]), state) for r in out.itertuples(index=False)]

    log = feed(("a", 1, 100))
    log += feed(("a", 3, 100))
    assert len(log) == 1 and feed(("b", 2, 200)) == []
    state.hasTimedOut = True
    log += [tuple(r) for out in run(("k", "1970-01-01"), iter([]), state) for r in out.itertuples(index=False)]
    state.hasTimedOut = False
    assert len(log) == 2 and not state.exists
    log += feed(("b", 2, 200))                  # nothing is known any more
    rows = [(r[0], r[1], r[2], at, f, p, touch) for r, at, f, p, touch in log]
    frame = spark.createDataFrame(rows, "ticker string, effective_date string, v string, __at long, __in long, __print long, __touch boolean")
    assert [r.v for r in latest(frame).collect()] == ["a"]


def test_nested_columns_are_refused(spark, tmp_path):
    base = str(tmp_path / "landing")
    put(spark, base, PRICES, "a", 1, [(dt.date(2024, 1, 2), [1])], "data_date date, v array<int>", ticker="600001.SH")
    with pytest.raises(ValueError, match="nested"):
        stream_landed(spark, base, str(tmp_path / "s"), str(tmp_path / "c"), {PRICES: read_landed(spark, base, *PRICES).schema})
