"""Audit reports (A1-A4, A7, A8) and exact quantiles."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pitlake.operators.audit import (accounting, describe_numeric, label_na_report, lookahead_audit,
                                     missing_report, stats_summary)
from pitlake.operators import quantiles
from pitlake.operators.quantiles import exact_quantiles


def test_describe_matches_pandas(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice([None, rnd.uniform(-5, 5)]), rnd.randint(0, 9)) for _ in range(301)]
    df = spark.createDataFrame(rows, "x double, k bigint")
    got = {r.column: r for r in describe_numeric(df).collect()}
    pdf = pd.DataFrame(rows, columns=["x", "k"]).describe().transpose()
    for c in ("x", "k"):
        for stat, col in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                          ("25%", "25%"), ("50%", "50%"), ("75%", "75%"), ("max", "max")):
            assert got[c][col] == pytest.approx(pdf.loc[c, stat], rel=1e-12), (c, stat)


def test_exact_quantiles_take_several_digits(spark, monkeypatch):
    """Coarse digits take several passes."""
    monkeypatch.setattr(quantiles, "STEPS", 1)
    monkeypatch.setattr(quantiles, "PLACES", 4)
    rnd = random.Random(3)
    vals = [float(rnd.randint(0, 500)) for _ in range(5000)]   # many ties
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = (0.001, 0.25, 0.5, 0.75, 0.999)
    got = exact_quantiles(df, ["v"], probs)
    want = pd.Series(vals).quantile(list(probs))
    for p in probs:
        assert got[("v", p)] == pytest.approx(want[p], rel=1e-12)


def test_missing_label_lookahead_accounting(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 2), dt.date(2024, 1, 1), 1, float("nan")),
         (dt.date(2024, 1, 3), dt.date(2024, 1, 4), 0, 1.0),
         (dt.date(2024, 1, 4), None, 1, None)],
        "date date, effective_date_src date, label_na_1d int, x double")
    m = {r.column: (r.missing_count, r.missing_percentage) for r in missing_report(df).collect()}
    assert m["x"] == (2, 66.67) and m["effective_date_src"] == (1, 33.33) and m["date"] == (0, 0.0)
    assert [(r.label_horizon, r.na_label_count) for r in label_na_report(df).collect()] == [("label_na_1d", 2)]
    la = lookahead_audit(df).collect()
    assert [(r.column, r.violations, r.passed) for r in la] == [("effective_date_src", 1, False)]
    s = {r.column: r for r in stats_summary(df).collect()}
    assert s["date"]["count"] is None and s["x"]["count"] == 1 and s["x"]["missing_count"] == 2
    obs_df, obs = accounting(df)
    obs_df.collect()
    assert obs.get["rows"] == 3


def test_approx_mode(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    r = describe_numeric(df, exact=False).collect()[0]
    assert r["50%"] == 50.0 and r["count"] == 101


def test_exact_quantiles_property(spark, monkeypatch):
    """Random columns with nulls, NaN and ties; coarse digits force further
    passes.  Always equal to pandas' linear quantiles."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    vals = st.one_of(st.none(), st.just(float("nan")), st.integers(-5, 5).map(float),
                     st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False))

    @settings(max_examples=12, deadline=None)
    @given(st.lists(vals, min_size=1, max_size=120), st.integers(2, 40))
    def check(xs, places):
        monkeypatch.setattr(quantiles, "PLACES", places)
        df = spark.createDataFrame([(x,) for x in xs], "v double")
        probs = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
        got = exact_quantiles(df, ["v"], probs)
        s = pd.Series([x for x in xs if x is not None], dtype="float64").dropna()
        for p in probs:
            if s.empty:
                assert got[("v", p)] is None
            else:
                assert got[("v", p)] == pytest.approx(s.quantile(p), rel=1e-12, abs=1e-9)

    check()


def test_exact_quantiles_of_any_doubles_in_four_passes(spark, monkeypatch):
    """Values over the whole range of doubles, neighbours a bit apart, and several columns at once."""
    import math
    import struct

    rnd = random.Random(11)
    wild = [struct.unpack("<d", struct.pack("<Q", rnd.getrandbits(64)))[0] for _ in range(4000)]
    wild = [x for x in wild if math.isfinite(x)][:3000] + [0.0, 5e-324, -5e-324, 1.7e308, -1.7e308] * 3
    close = [1.0]
    while len(close) < len(wild):
        close.append(math.nextafter(close[-1], 2.0))
    rnd.shuffle(close)
    df = spark.createDataFrame(list(zip(wild, close)), "a double, b double").repartition(3)
    passes = []
    pick = quantiles._pick
    monkeypatch.setattr(quantiles, "_pick", lambda *x: passes.append(1) or pick(*x))
    probs = [k / (len(wild) - 1) for k in (0, 1, 700, 1500, 2222, len(wild) - 1)]
    got = exact_quantiles(df, ["a", "b"], probs)
    for c, xs in (("a", sorted(wild)), ("b", sorted(close))):
        for p in probs:
            pos = (len(xs) - 1) * p
            assert got[(c, p)] in {xs[math.floor(pos)], xs[math.ceil(pos)]} or xs[math.floor(pos)] <= got[(c, p)] <= xs[math.ceil(pos)]
    assert len(passes) <= 4


def test_leading_digit_never_falls(spark):
    import math

    rnd = random.Random(5)
    xs = sorted({s * math.ldexp(1 + rnd.random(), rnd.randint(-1074, 1022)) for s in (1, -1) for _ in range(2000)} | {
        s * y for e in range(-1074, 1024, 7) for s in (1, -1) for y in (math.ldexp(1, e), math.nextafter(math.ldexp(1, e), 0.0))} | {0.0, math.inf, -math.inf})
    rows = spark.createDataFrame([(x,) for x in xs], "v double").select("v", quantiles._leading(F.col("v")).alias("d")).collect()
    digits = [r.d for r in sorted(rows, key=lambda r: r.v)]
    assert digits == sorted(digits)
