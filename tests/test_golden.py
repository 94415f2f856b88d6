"""Bundled-CSV end-to-end golden: each ticker its own file, and
the published numbers when both tickers get 601318's file (defect T4)."""

import os

import pytest

from paths import FIXTURES
from pitlake.operators.audit import label_na_report, stats_summary
from pitlake.plans.pipeline import build, run


def _stats(df):
    return {r["column"]: r.asDict() for r in stats_summary(df).collect()}


def test_golden_right_values(spark):
    r = build(spark, f"{FIXTURES}/price_*.csv", f"{FIXTURES}/CSI300.csv", f"{FIXTURES}/smoke_dates.txt")
    g = r.gold
    assert g.count() == 1500
    s = _stats(g)
    a = s["feat_adj_close_hfq_stock_zh_a_hist"]
    assert a["count"] == 10 and a["missing_count"] == 1490 and a["missing_percentage"] == 99.33
    assert a["mean"] == pytest.approx(4345.458) and a["std"] == pytest.approx(4412.159808279, rel=1e-10)
    assert (a["min"], a["25%"], a["50%"], a["75%"], a["max"]) == pytest.approx((158.69, 159.685, 4320.625, 8508.61, 8605.27))
    r1 = s["r_1d"]
    assert r1["count"] == 8 and r1["mean"] == pytest.approx(4.141348326, rel=1e-8)
    assert r1["std"] == pytest.approx(68.339049406, rel=1e-9)
    assert (r1["min"], r1["25%"], r1["50%"], r1["75%"], r1["max"]) == pytest.approx(
        (-99.681504866, -33.356551547, 2.389609893, 36.749836205, 127.068000252), rel=1e-9)
    assert s["r_5d"]["count"] == 0 and s["r_20d"]["count"] == 0
    assert s["feat_next_trade_date_tool_trade_date_hist_sina"]["missing_count"] == 300
    na = {x.label_horizon: x.na_label_count for x in label_na_report(g).collect()}
    assert na == {"label_na_1d": 1492, "label_na_5d": 1500, "label_na_20d": 1500}


def test_published_numbers_with_shared_file(spark, tmp_path):
    # both tickers read 601318's prices, as the reference's replay did
    d = tmp_path / "px"
    d.mkdir()
    src = open(os.path.join(FIXTURES, "price_601318SH.csv"), encoding="utf-8").read()
    for t in ("600519SH", "601318SH"):
        (d / f"price_{t}.csv").write_text(src, encoding="utf-8")
    r = build(spark, f"{d}/price_*.csv", f"{FIXTURES}/CSI300.csv", f"{FIXTURES}/smoke_dates.txt")
    s = _stats(r.gold)
    assert s["feat_adj_close_hfq_stock_zh_a_hist"]["mean"] == pytest.approx(159.85)
    assert s["feat_adj_close_hfq_stock_zh_a_hist"]["std"] == pytest.approx(1.157545295, rel=1e-9)
    assert s["r_1d"]["mean"] == pytest.approx(41.784037034, rel=1e-9)
    assert s["r_1d"]["std"] == pytest.approx(56.611827045, rel=1e-9)


def test_single_values_full_history(spark):
    r = build(spark, f"{FIXTURES}/price_*.csv", f"{FIXTURES}/CSI300.csv", None)
    from pitlake.operators.labels import forward_labels
    from pyspark.sql import functions as F
    px = r.silver_prices.select("ticker", F.col("effective_date").alias("date"), "adj_close_hfq")
    lab = {(x.ticker, x.date.isoformat()): x for x in forward_labels(px.select("ticker", "date"), px, r.calendar,
                                                                     "adj_close_hfq").collect()}
    a = lab[("600519.SH", "2024-09-30")]
    assert (a.r_1d, a.r_5d, a.r_20d) == pytest.approx((-127.286176044, -743.401120670, -1017.276144735), rel=1e-9)
    b = lab[("601318.SH", "2024-09-30")]
    assert (b.r_1d, b.r_5d, b.r_20d) == pytest.approx((615.058324496, 209.437963945, 106.044538706), rel=1e-9)
    c = lab[("600519.SH", "2025-08-14")]
    assert c.r_1d == pytest.approx(-28.984894501, rel=1e-9) and c.r_5d is None and c.label_na_5d == 1


def test_run_writes_all_outputs(spark, tmp_path):
    out = str(tmp_path / "out")
    rep = run(spark, f"{FIXTURES}/price_*.csv", f"{FIXTURES}/CSI300.csv", f"{FIXTURES}/smoke_dates.txt", out,
              buckets=4)
    assert rep["label_na"].count() == 3
    assert rep["gold_shape"] == (1500, 19)
    s = {r["column"]: r for r in rep["stats_summary"].collect()}
    assert s["r_1d"]["count"] == 8 and s["r_1d"]["mean"] == pytest.approx(4.141348326, rel=1e-8)
    for p in ("silver/interface=stock_zh_a_hist", "gold/features", "gold/labels", "gold/gold",
              "exports/cpt/dataset_cpt_smoke.jsonl", "exports/sft/dataset_sft_smoke.jsonl",
              "exports/txt/dataset_smoke_preview.txt", "exports/stats/stats_summary_smoke.csv",
              "exports/stats/stats_label_na_smoke.csv"):
        assert os.path.isdir(os.path.join(out, p)), p
    cpt = spark.read.json(f"{out}/exports/cpt/dataset_cpt_smoke.jsonl")
    assert cpt.count() == 1500 and cpt.columns == ["text"]
