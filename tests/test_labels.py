"""Forward-return labels (W1, W2, F1, F2, A6) incl. the reference's unit test."""

import datetime as dt

import pytest

from paths import final_plan
from pitlake.operators.labels import dedupe_last, forward_labels


def D(s):
    return dt.date.fromisoformat(s)


def _labels(spark, grid_rows, price_rows, cal, base=True, horizons=(1, 5, 20)):
    grid = spark.createDataFrame(grid_rows, "ticker string, date date, adj_close_hfq double")
    prices = spark.createDataFrame(price_rows, "ticker string, date date, adj_close_hfq double")
    calendar = spark.createDataFrame([(D(d),) for d in cal], "trade_date date").withColumnRenamed("trade_date", "date")
    out = forward_labels(grid, prices, calendar, "adj_close_hfq", horizons=horizons,
                         base_col="adj_close_hfq" if base else None)
    return {(r["ticker"], r["date"].isoformat()): r.asDict() for r in out.collect()}


def test_reference_unit_case(spark):
    """Two gold rows, three price days: +200 bps, -200 bps, 5d/20d NA."""
    gold = [("TICKER_A", D("2024-01-02"), 100.0), ("TICKER_A", D("2024-01-03"), 102.0)]
    prices = gold + [("TICKER_A", D("2024-01-04"), 99.96)]
    res = _labels(spark, gold, prices, ["2024-01-02", "2024-01-03", "2024-01-04"])
    r1, r2 = res[("TICKER_A", "2024-01-02")], res[("TICKER_A", "2024-01-03")]
    assert r1["label_na_1d"] == 0 and r1["r_1d"] == pytest.approx(200.0)
    assert r2["label_na_1d"] == 0 and r2["r_1d"] == pytest.approx(-200.0)
    assert r2["label_na_5d"] == 1 and r2["r_5d"] is None
    assert r2["label_na_20d"] == 1 and r2["r_20d"] is None


def test_missing_day_does_not_skip_ahead(spark):
    """Suspended on day 2: r_1d of day 1 is NA, not the day-3 return (lead would be wrong)."""
    cal = ["2024-01-02", "2024-01-03", "2024-01-04"]
    prices = [("A", D("2024-01-02"), 100.0), ("A", D("2024-01-04"), 110.0)]
    grid = [("A", D("2024-01-02"), 100.0)]
    res = _labels(spark, grid, prices, cal, horizons=(1, 2))
    r = res[("A", "2024-01-02")]
    assert r["r_1d"] is None and r["label_na_1d"] == 1
    assert r["r_2d"] == pytest.approx(1000.0) and r["label_na_2d"] == 0


def test_zero_null_price_unknown_date_and_clip(spark):
    cal = ["2024-01-02", "2024-01-03"]
    prices = [("Z", D("2024-01-02"), 0.0), ("Z", D("2024-01-03"), 5.0),
              ("N", D("2024-01-03"), 5.0),
              ("C", D("2024-01-02"), 1.0), ("C", D("2024-01-03"), 10.0),
              ("L", D("2024-01-02"), 10.0), ("L", D("2024-01-03"), 1.0)]
    grid = [("Z", D("2024-01-02"), 0.0), ("N", D("2024-01-02"), None), ("C", D("2024-01-02"), 1.0),
            ("L", D("2024-01-02"), 10.0), ("C", D("2024-01-05"), 1.0)]
    res = _labels(spark, grid, prices, cal, horizons=(1,))
    assert res[("Z", "2024-01-02")]["label_na_1d"] == 1 and res[("Z", "2024-01-02")]["r_1d"] is None
    assert res[("N", "2024-01-02")]["label_na_1d"] == 1
    assert res[("C", "2024-01-02")]["r_1d"] == 2000.0           # +90000 bps clipped
    assert res[("L", "2024-01-02")]["r_1d"] == -2000.0          # -9000 bps clipped
    assert res[("C", "2024-01-05")]["label_na_1d"] == 1         # date not in calendar


def test_forward_prices_come_from_full_history(spark):
    """The last grid day still gets a label from a price after the window."""
    cal = ["2024-01-02", "2024-01-03"]
    res = _labels(spark, [("A", D("2024-01-02"), 100.0)],
                  [("A", D("2024-01-02"), 100.0), ("A", D("2024-01-03"), 101.0)], cal, horizons=(1,))
    assert res[("A", "2024-01-02")]["r_1d"] == pytest.approx(100.0)


def test_base_price_from_price_table(spark):
    cal = ["2024-01-02", "2024-01-03"]
    res = _labels(spark, [("A", D("2024-01-02"), None)],
                  [("A", D("2024-01-02"), 100.0), ("A", D("2024-01-03"), 101.0)], cal, base=False, horizons=(1,))
    assert res[("A", "2024-01-02")]["r_1d"] == pytest.approx(100.0)


def test_dedupe_last_keeps_last_by_order(spark):
    df = spark.createDataFrame([("A", D("2024-01-02"), 1, 10.0), ("A", D("2024-01-02"), 2, 11.0),
                                ("A", D("2024-01-03"), 1, 12.0)], "ticker string, date date, seq int, px double")
    out = {(r.ticker, r.date.isoformat()): r.px for r in dedupe_last(df, ["ticker", "date"], ["seq"]).collect()}
    assert out == {("A", "2024-01-02"): 11.0, ("A", "2024-01-03"): 12.0}


def test_single_exchange_for_all_horizons(spark):
    """All horizons share one window: one hash Exchange on the key."""
    cal = spark.createDataFrame([(D("2024-01-02"),), (D("2024-01-03"),)], "date date")
    grid = spark.createDataFrame([("A", D("2024-01-02"))], "ticker string, date date")
    px = spark.createDataFrame([("A", D("2024-01-02"), 1.0)], "ticker string, date date, p double")
    plan = final_plan(forward_labels(grid, px, cal, "p"))
    assert plan.count("Exchange hashpartitioning(ticker") == 1


def test_label_properties_and_fused_equals_unfused(spark):
    """|r| <= 2000, flag = 1 <=> return null, and the fused gold equals the
    step-by-step operators on random panels with gaps."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from pitlake.operators.gold import LabelSpec, assemble_gold
    from pitlake.operators.grid import base_grid
    from pitlake.operators.joins import AsofSource, gold, join_daily

    days = [D("2024-01-01") + dt.timedelta(days=i) for i in range(12)]

    @settings(max_examples=8, deadline=None)
    @given(st.dictionaries(st.tuples(st.sampled_from("AB"), st.integers(0, 11)),
                           st.one_of(st.just(0.0), st.floats(0.5, 500, allow_nan=False)), min_size=1, max_size=20))
    def check(px):
        prices = spark.createDataFrame([(k, days[i], v) for (k, i), v in px.items()],
                                       "ticker string, date date, p double")
        cal = spark.createDataFrame([(d,) for d in days], "date date")
        grid = base_grid(spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string"), cal, days[2], days[9])
        lab = forward_labels(grid, prices, cal, "p", horizons=(1, 3))
        rows = lab.collect()
        assert len(rows) == 3 * 8
        for r in rows:
            for h in (1, 3):
                v, na = r[f"r_{h}d"], r[f"label_na_{h}d"]
                assert (na == 1) == (v is None)
                assert v is None or -2000.0 <= v <= 2000.0
        fused = assemble_gold(grid, cal, daily=[AsofSource("px", prices, unique=True)], labels=LabelSpec(prices, "p",
                                                                                                       horizons=(1, 3)))
        unfused = gold(join_daily(grid, prices, "px"), lab)
        cols = sorted(fused.columns)
        assert sorted(unfused.columns) == cols
        key = lambda t: tuple(str(x) for x in t)
        assert sorted(fused.select(cols).collect(), key=key) == sorted(unfused.select(cols).collect(), key=key)

    check()


def test_fused_market_source_must_be_one_row_per_day(spark):
    from pitlake.operators.gold import assemble_gold
    cal = spark.createDataFrame([(D("2024-01-02"),), (D("2024-01-03"),)], "date date")
    grid = spark.createDataFrame([("A", D("2024-01-02")), ("A", D("2024-01-03"))], "ticker string, date date")
    ok = spark.createDataFrame([(D("2024-01-02"), 1.0)], "date date, m double")
    out = {r.date.day: r.feat_m_mkt for r in assemble_gold(grid, cal, market_daily=[("mkt", ok)]).collect()}
    assert out == {2: 1.0, 3: None}
    dup = spark.createDataFrame([(D("2024-01-02"), 1.0), (D("2024-01-02"), 2.0)], "date date, m double")
    with pytest.raises(Exception, match="several rows"):
        assemble_gold(grid, cal, market_daily=[("mkt", dup)]).collect()


def test_gold_from_bucketed_silver_needs_no_entity_shuffle(spark, tmp_path):
    """Silver bucketed by ticker: the fused gold windows run without an
    Exchange on the entity key (all remaining exchanges are per-date tables)."""
    import re

    from paths import final_plan
    from pitlake.operators.gold import LabelSpec, assemble_gold
    from pitlake.operators.grid import base_grid
    from pitlake.operators.joins import AsofSource
    from pitlake.sources.sinks import read_silver, write_silver

    rows = [(f"T{k}", D("2024-01-01") + dt.timedelta(days=d), float(10 + k + d)) for k in range(20) for d in range(15)
            if (k + d) % 4]
    px = spark.createDataFrame(rows, "ticker string, date date, p double")
    ev = spark.createDataFrame([(f"T{k}", D("2024-01-01") + dt.timedelta(days=2 * k % 15), float(k)) for k in range(20)],
                               "ticker string, date date, e double")
    base = str(tmp_path / "silver")
    write_silver(px, base, "px_src", buckets=4)
    write_silver(ev, base, "ev_src", buckets=4)
    b, e = read_silver(spark, base, "px_src"), read_silver(spark, base, "ev_src")
    cal = b.select("date").distinct()
    g = assemble_gold(base_grid(b.select("ticker").distinct(), cal), cal,
                      daily=[AsofSource("px", b, unique=True)], slow=[AsofSource("ev", e)],
                      labels=LabelSpec(b, "p"))
    keys = re.findall(r"Exchange hashpartitioning\(([a-z_]+)#", final_plan(g))
    assert "__k" not in keys and "ticker" not in keys, keys
    assert g.count() == 20 * 15


def test_slow_source_on_calendar_shortcut_is_equivalent(spark):
    from pitlake.operators.gold import assemble_gold
    from pitlake.operators.grid import base_grid
    from pitlake.operators.joins import AsofSource

    days = [D("2024-01-01") + dt.timedelta(days=i) for i in range(0, 20, 2)]      # trading days: every 2nd day
    cal = spark.createDataFrame([(d,) for d in days], "date date")
    grid = base_grid(spark.createDataFrame([("A",), ("B",)], "ticker string"), cal)
    src = spark.createDataFrame([(k, days[i], float(i)) for k in "AB" for i in (1, 4, 7) if not (k == "B" and i == 4)],
                                "ticker string, date date, v double")
    a = assemble_gold(grid, cal, slow=[AsofSource("s", src)])
    b = assemble_gold(grid, cal, slow=[AsofSource("s", src, on_calendar=True)])
    key = lambda r: (r.ticker, r.date)
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key)


def _odd_panel(spark):
    """Prices off the calendar, missing, NaN, zero, out of order, without a key and of an unknown entity (twice on a
    day); an entity that the universe repeats, one without a key, one without prices."""
    cal = spark.createDataFrame([(D(f"2024-01-{n:02d}"),) for n in (1, 2, 3, 6, 7, 9)] + [(None,), (D("2024-01-03"),)], "date date")
    uni = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), (None,), ("none",)], "ticker string")
    nan = float("nan")
    rows = [("a", 7, 3.0), ("a", 1, 1.0), ("a", 2, 2.0), ("a", 4, 9.0), ("a", 30, 8.0), ("b", 1, None), ("b", 2, nan), ("b", 3, 0.0), ("b", 6, 5.0), ("b", 7, 5.5),
            ("c", 6, 1.0), ("c", 9, 2.0), (None, 2, 7.0), (None, 3, 7.7), ("x", 2, 1.0), ("x", 2, 2.0), ("a", None, 1.0), ("c", 7, 3.0), ("c", 7, None)]
    px = spark.createDataFrame([(t, n and D(f"2024-01-{n:02d}"), p, i) for i, (t, n, p) in enumerate(rows)], "ticker string, date date, p double, o int")
    return cal, uni, px


def _same_rows(got, want):
    from collections import Counter
    assert got.schema.simpleString() == want.schema.simpleString()
    rows = [Counter(map(tuple, df.collect())) for df in (got, want)]
    assert rows[0] == rows[1]
    return sum(rows[0].values())


def test_labels_by_spans_give_the_rows_of_the_stack(spark):
    from pitlake.operators.grid import base_grid

    cal, uni, px = _odd_panel(spark)
    grid = base_grid(uni, cal)
    for order in (None, ["o"]):
        args = dict(horizons=(1, 2, 4), price_order=order)
        assert _same_rows(forward_labels(grid, px, cal, "p", universe=uni, **args), forward_labels(grid, px, cal, "p", **args)) == 36
    with pytest.raises(Exception, match="several prices"):
        forward_labels(grid, px.unionByName(px.where("p = 5.5")), cal, "p", universe=uni).collect()
    none = cal.where("date < '2000-01-01'")
    assert forward_labels(base_grid(uni, none), px, none, "p", universe=uni).count() == 0
    assert _same_rows(forward_labels(grid, px.limit(0), cal, "p", universe=uni), forward_labels(grid, px.limit(0), cal, "p")) == 36


def test_labels_by_spans_of_other_days(spark):
    """A grid of closed days too, of fewer days than the calendar's, of none in common."""
    from pitlake.operators.grid import base_grid

    cal, uni, px = _odd_panel(spark)
    for span, n in (((1, 2, 3, 4, 5, 6, 7, 8, 9), 54), ((2, 4, 7), 18), ((4, 5), 12), ((), 0)):
        days = spark.createDataFrame([(D(f"2024-01-{k:02d}"),) for k in span] + [(None,)], "date date")
        grid = base_grid(uni, days)
        args = dict(horizons=(1, 2), price_order=["o"])
        assert _same_rows(forward_labels(grid, px, cal, "p", universe=uni, days=days, **args), forward_labels(grid, px, cal, "p", **args)) == n
    named = forward_labels(grid, px.withColumnsRenamed({"ticker": "k", "date": "d"}), cal, "p", (1,), key="k", date="d", price_order=["o"],
                           universe=uni.withColumnRenamed("ticker", "k"), days=cal.unionByName(days))
    assert named.columns == ["k", "d", "r_1d", "label_na_1d"] and named.count() == 36


def _shuffled_rows(spark, df):
    """Rows of each shuffle of the final plan."""
    import re

    df.collect()
    plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    found = re.findall(r"ShuffleQueryStage \(\d+\), Statistics\(sizeInBytes=[^,]*, rowCount=([^)]*)\)", plan.split("== Initial Plan ==")[0])
    assert found
    return [int(float(n)) for n in found]


def test_whole_grid_is_not_shuffled(spark):
    """40 entities on 50 days with one price each: prices and entities are hashed, not 2000 grid rows."""
    from pitlake.operators.grid import base_grid

    uni = spark.range(40).selectExpr("cast(id AS string) AS ticker")
    days = [D("2024-01-01") + dt.timedelta(days=i) for i in range(50)]
    cal = spark.createDataFrame([(d,) for d in days], "date date")
    px = spark.createDataFrame([(str(k), days[k], float(k + 1)) for k in range(40)], "ticker string, date date, p double")
    out = forward_labels(base_grid(uni, cal), px, cal, "p", universe=uni)
    assert out.count() == 2000
    assert max(_shuffled_rows(spark, out)) <= 40 + 50


LABEL_QUERIES = ("labels_lineitem", "labels_dup", "labels_gapped")


@pytest.mark.parametrize("name", LABEL_QUERIES)
def test_label_queries_shuffle_prices_only(spark, tmp_path, name):
    """A price every fourth day for some suppliers, two on one day, one without a supplier, one of an unknown supplier."""
    from pitlake.plans.queries import QUERIES

    lines = [(n, 1, n % 4, day, float(100 + n)) for n in range(60) for day in [dt.datetime(2024, 1, 1) + dt.timedelta(days=n)]]
    lines += [(7, 2, 3, lines[7][3], 50.0), (8, 2, None, lines[8][3], 60.0), (9, 2, 77, lines[9][3], 70.0), (6, 2, 1, None, 80.0)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate timestamp, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(30).withColumnRenamed("id", "s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    price = {}
    for order, line, supplier, day, p in lines:        # the highest of a day, or the last by (order, line)
        if day:
            k = supplier, day.date()
            price[k] = p if name == "labels_dup" else max(p, price.get(k, p))
    days = sorted({l[3].date() for l in lines if l[3]})
    cal = [d for d in days if name != "labels_gapped" or d.weekday() < 5]
    out = QUERIES[name](spark, str(tmp_path))
    rows = out.collect()
    assert len({(r.ticker, r.date) for r in rows}) == len(rows) == 30 * len(days)
    for r in rows:
        for h in (1, 5, 20):
            at = cal.index(r.date) + h if r.date in cal else len(cal)
            p0, ph = price.get((r.ticker, r.date)), price.get((r.ticker, cal[at])) if at < len(cal) else None
            na = p0 is None or ph is None
            assert r[f"label_na_{h}d"] == int(na)
            assert r[f"r_{h}d"] == (None if na else pytest.approx(max(-2000.0, min(2000.0, 10000 * (ph / p0 - 1)))))
    assert any(r.label_na_20d == 0 for r in rows) and max(_shuffled_rows(spark, out)) <= 30 + 64


def test_price_order_is_shuffled_once(spark):
    """Of several prices a day only the price travels beside its order, and ties and null orders fall as they did."""
    cal, _, px = _odd_panel(spark)
    days = cal.where("date IS NOT NULL").distinct()
    two = px.unionByName(px).withColumn("o2", px.o % 3)
    out = forward_labels(days.selectExpr("'a' AS ticker", "date"), two, cal, "p", price_order=["o", "o2"])
    plan = final_plan(out)
    assert "partial_max_by(struct(__px, __px" in plan and plan.count("__o1, __o1") == plan.count("struct(__o0, __o0")
    value = plan.split("partial_max_by(", 1)[1].split("), struct(", 1)[0]
    assert "__o0" not in value, value
    order = spark.createDataFrame([("k", 1.0, None), ("k", 2.0, 1), ("k", 3.0, None), ("n", None, 2), ("n", 4.0, 1)], "ticker string, p double, o int")
    kept = {r.ticker: r.p for r in dedupe_last(order, ["ticker"], ["o"], cols=["p"]).collect()}
    assert kept == {r.ticker: r.p for r in dedupe_last(order, ["ticker"], ["o"]).collect()} == {"k": 2.0, "n": None}
    assert dedupe_last(order, ["ticker"], ["o"], cols=["p"]).columns == ["ticker", "p"]
