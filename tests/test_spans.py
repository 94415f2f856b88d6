"""Suspension flags from spans (D5) and as-of in two times (J4 with a period)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pitlake.operators.joins import AsofSource, asof_join
from pitlake.operators.treat import open_spans, suspension

D = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)


def brute_open(rows, spans):
    return [sum(1 for k, s, e in spans if k is not None and k == t and s is not None and s <= d and (e is None or d <= e)) if d else 0 for t, d in rows]


@pytest.mark.parametrize("split", [None, "month"])
def test_suspension_equals_range_join(spark, split):
    rng = random.Random(3)
    spans = [(rng.choice("abc"), D(rng.randint(-30, 90)), None) for _ in range(4)]
    for _ in range(300):
        s = D(rng.randint(-30, 120))
        spans.append((rng.choice("abcx"), s, s + dt.timedelta(days=rng.randint(-3, 20))))
    spans += spans[:5] + [(None, D(3), D(9)), ("a", None, D(5)), ("a", None, None), ("b", D(9), D(8))]
    rows = [(t, D(k)) for t in "abcd" for k in range(100)] + [("a", D(4)), (None, D(4)), ("a", None)]
    df = spark.createDataFrame(rows, "ticker string, date date").withColumn("extra", F.lit(1))
    got = suspension(df, spark.createDataFrame(spans, "ticker string, start date, end date"), count="n", split=split)
    assert got.columns == ["ticker", "date", "extra", "is_suspended", "n"] and dict(got.dtypes)["is_suspended"] == "tinyint"
    want = [(t, d, 1, int(n > 0), n) for (t, d), n in zip(rows, brute_open(rows, spans))]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_spans_that_touch_and_empty_spans(spark):
    spans = spark.createDataFrame([("a", D(0), D(2)), ("a", D(3), D(3)), ("a", D(2), D(2))], "ticker string, start date, end date")
    got = {(r.date): r.n_open for r in open_spans(spans).collect()}
    assert got == {D(0): 1, D(2): 2, D(3): 1, D(4): 0}
    df = spark.createDataFrame([("a", D(1))], "ticker string, date date")
    assert suspension(df, spans.limit(0)).collect()[0].is_suspended == 0
    assert suspension(df.limit(0), spans).count() == 0


def test_suspension_on_times(spark):
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 3, 23, 59)), ("a", dt.datetime(2024, 1, 4, 0, 0))], "ticker string, ts timestamp")
    spans = spark.createDataFrame([("a", D(0), D(2))], "ticker string, start date, end date")
    assert [r.is_suspended for r in suspension(df, spans, date="ts").orderBy("ts").collect()] == [1, 0]


def test_hot_key_of_spans_is_one_row_a_day(spark):
    """A third of all spans on one key: the changes are summed before the window."""
    spans = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("ticker"),
                                       F.lit(D(0)).alias("start"), F.lit(D(5)).alias("end"))
    rows = open_spans(spans).where("ticker = 'hot'").collect()
    assert {(r.date, r.n_open) for r in rows} == {(D(0), 10_000), (D(6), 0)}


def brute_restated(left, reports):
    out = []
    for t, d in left:
        known = [r for r in reports if r[0] == t and r[1] is not None and d is not None and r[1] <= d]
        best = max(known, key=lambda r: (r[2] is not None, r[2] or 0, r[1], r[3]), default=None)
        out.append((t, d, *(best[2:] if best else (None, None)), best[1] if best else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [None, "month"])
def test_restatement_of_an_old_period_does_not_displace(spark, split):
    rng = random.Random(8)
    reports = [("a", D(10), 1, 100), ("a", D(20), 2, 200), ("a", D(30), 1, 300), ("a", D(40), 2, 400), ("a", D(5), None, 50)]
    reports += [(rng.choice("bcd"), D(rng.randint(0, 90)), rng.choice([None, 1, 2, 3, 4]), k) for k in range(200)] + [("b", None, 9, 900)]
    left = [(t, D(k)) for t in "abcde" for k in range(95)]
    src = AsofSource("rep", spark.createDataFrame(reports, "ticker string, date date, quarter int, version int"), period="quarter", tie_break=["version"])
    got = asof_join(spark.createDataFrame(left, "ticker string, date date"), src, split=split)
    assert got.columns == ["ticker", "date", "feat_quarter_rep", "feat_version_rep", "effective_date_rep"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_restated(left, reports)
    a = {r.date: r.feat_version_rep for r in got.where("ticker = 'a'").collect()}
    assert (a[D(7)], a[D(15)], a[D(25)], a[D(35)], a[D(45)]) == (50, 100, 200, 200, 400)


def test_restated_market_source(spark):
    reports = [(D(10), 1, 100), (D(20), 2, 200), (D(30), 1, 300)]
    left = spark.createDataFrame([("a", D(k)) for k in (5, 12, 25, 35)], "ticker string, date date")
    src = AsofSource("rep", spark.createDataFrame(reports, "date date, quarter int, v int"), period="quarter", tie_break=["v"])
    got = asof_join(left, src, by=None).orderBy("date").collect()
    assert [r.feat_v_rep for r in got] == [None, 100, 200, 200]
    with pytest.raises(ValueError):
        asof_join(left, AsofSource("rep", src.df, period="quarter", unique=True))
