"""Hot keys cut by rows (as-of join, forward fill with ``split="rows"``)."""

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from pitlake.operators import joins
from pitlake.operators.joins import AsofSource, asof_join
from pitlake.operators.slices import MOST, hot_keys, tag
from pitlake.operators.treat import ffill
from pitlake.plans import tables as tb
from paths import SF_SMALL

BASE = dt.datetime(2024, 1, 1)


def _rows(df):
    return Counter(map(str, df.collect()))


def test_cut_by_rows_equals_uncut(spark):
    """Null keys and times, one instant with many rows, bursts, keys without source rows, two sources."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    keys, minute = st.sampled_from(["A", "A", "A", "B", None]), st.one_of(st.none(), st.just(7), st.integers(0, 400))

    def times(rows, head):
        data = [(*r, None if m is None else BASE + dt.timedelta(minutes=m)) for *r, m in rows]
        return spark.createDataFrame(data, f"{head}, ts timestamp_ntz")

    @settings(max_examples=6, deadline=None)
    @given(st.lists(st.tuples(keys, st.integers(0, 9), minute), max_size=25),
           st.lists(st.tuples(st.sampled_from("AC"), st.integers(0, 9), minute), max_size=10),
           st.lists(st.tuples(keys, st.one_of(st.none(), st.integers(0, 3)), minute), max_size=40))
    def check(one, two, left):
        l = times([(i, *r) for i, r in enumerate(left)], "id int, ticker string, x int")
        made = lambda: [AsofSource("one", times(one, "ticker string, v int"), tie_break=["v"]),
                        AsofSource("two", times(two, "ticker string, w int"), tie_break=["w"])]
        assert _rows(asof_join(l, made(), date="ts", split="rows")) == _rows(asof_join(l, made(), date="ts"))
        once = l.groupBy("ticker", "ts").agg(F.max("x").alias("x"))          # one row a time: the fill is unambiguous
        assert _rows(ffill(once, ["x"], order="ts", split="rows")) == _rows(ffill(once, ["x"], order="ts"))

    check()


def test_dates_and_repeated_instant_are_dealt(spark):
    """A date-typed left side whose one day holds most rows: its rows go to several copies of the slice."""
    left = spark.range(4000).select(F.lit("HOT").alias("ticker"), "id",
                                    F.when(F.col("id") < 3000, F.lit("2024-01-05")).otherwise("2024-01-09").cast("date").alias("date"))
    src = spark.createDataFrame([("HOT", dt.date(2024, 1, 2), 1), ("HOT", dt.date(2024, 1, 5), 2), ("HOT", dt.date(2024, 1, 8), 3)],
                                "ticker string, date date, v int")
    hot = hot_keys(left, "ticker", "date", parts=8)
    h = hot.collect()
    assert len(h) == 1 and h[0]["__m"] == 8 and sum(h[0]["__copies"]) == 7
    got = asof_join(left, AsofSource("s", src), split="rows").groupBy("feat_v_s").count().collect()
    assert {r.feat_v_s: r["count"] for r in got} == {2: 3000, 3: 1000}


def test_tag_counts_starts_in_blocks(spark):
    """More slices than one block of starts: the place of each time equals a plain count."""
    rows = spark.range(20000).select(F.lit(1).alias("k"), F.timestamp_micros(F.col("id") * F.col("id")).alias("t"))
    hot = hot_keys(rows, "k", "t", parts=300)
    starts = sorted(hot.collect()[0]["__starts"])
    assert 250 < len(starts) <= 299 and hot.collect()[0]["__m"] == 300 < MOST
    sizes = [r["count"] for r in tag(rows, hot, "k", "t").groupBy("__P").count().orderBy("__P").collect()]
    assert len(sizes) == len(starts) + 1 and max(sizes) < 2.5 * 20000 / 300
    import bisect
    sample = tag(rows, hot, "k", "t").collect()
    assert all(r["__P"] == bisect.bisect_right(starts, r.t) for r in sample)


def test_half_of_all_events_under_one_key_gives_even_tasks(spark, monkeypatch):
    """The window's groups: without the cut one holds over half of all rows, with it none much more than a share."""
    ev = tb.stream_events(tb.load(spark, SF_SMALL, "events"))
    src = ev.where("value >= 90").select("stream", "ts", F.col("value").alias("v"))
    seen = {}

    def kept(*args):
        seen["body"], w = real(*args)
        return seen["body"], w

    real = joins._sliced_stack
    monkeypatch.setattr(joins, "_sliced_stack", kept)
    monkeypatch.setattr(joins, "hot_keys", lambda rows, k, t: hot_keys(rows, k, t, parts=16))
    joined = asof_join(ev.select("event_id", "stream", "ts"), AsofSource("s", src), by="stream", date="ts", split="rows")
    sizes = [r["count"] for r in seen["body"].groupBy("__k", "__P", "__z").count().collect()]
    n = ev.count()
    assert ev.where("stream = 'shared'").count() > n / 2 and max(sizes) < 1.6 * (n + src.count()) / 16
    plain = asof_join(ev.select("event_id", "stream", "ts"), AsofSource("s", src), by="stream", date="ts")
    assert _rows(joined) == _rows(plain)


def test_empty_sides(spark):
    left = spark.createDataFrame([], "ticker string, date date")
    src = spark.createDataFrame([], "ticker string, date date, v int")
    assert asof_join(left, AsofSource("s", src), split="rows").count() == 0
    one = spark.createDataFrame([("A", dt.date(2024, 1, 1))], "ticker string, date date")
    assert asof_join(one, AsofSource("s", src), split="rows").collect()[0].feat_v_s is None
