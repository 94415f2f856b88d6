"""Export records (F3-F8) and sinks."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from pitlake.functions.scalar import target_text
from pitlake.operators.export import SFT_INSTRUCTION, to_cpt, to_sft, to_txt
from pitlake.sources.sinks import write_jsonl, write_txt


def _gold(spark):
    return spark.createDataFrame(
        [("600519.SH", dt.date(2025, 8, 11), 1.5, None, 1022768, -17.58, 0),
         ("601318.SH", dt.date(2025, 8, 12), None, 2.25, None, -0.5, 0),
         ("000001.SZ", dt.date(2025, 8, 13), 3.0, 4.0, 5, None, 1)],
        "ticker string, date date, feat_open_stock_zh_a_hist double, feat_close_stock_zh_a_hist double, "
        "feat_volume_stock_zh_a_hist bigint, r_1d double, label_na_1d int")


def test_cpt_text(spark):
    rows = [r.text for r in to_cpt(_gold(spark)).collect()]
    assert rows[0] == ("TICKER=600519.SH\nDATE=2025-08-11 00:00:00\nFEATURES:\nopen=1.500000\n"
                       "volume=1022768.000000\nTARGET_RETURN_BPS_NEXT_1D:\n-17")
    assert rows[1].endswith("FEATURES:\nclose=2.250000\nTARGET_RETURN_BPS_NEXT_1D:\n0")
    assert rows[2].endswith("TARGET_RETURN_BPS_NEXT_1D:\nLABEL_NA=1")


def test_sft_and_txt(spark):
    s = to_sft(_gold(spark)).collect()[0]
    assert s.Instruction == SFT_INSTRUCTION.format(h=1) and s.Output == "-17"
    assert s.Input == "TICKER=600519.SH\nDATE=2025-08-11 00:00:00\nFEATURES:\nopen=1.500000\nvolume=1022768.000000"
    t = to_txt(_gold(spark)).collect()[0].text
    assert t.startswith("TICKER=600519.SH\nDATE=2025-08-11 00:00:00\n\nFEATURES:\n")
    assert t.endswith("\n\nTARGET_RETURN_BPS_NEXT_1D:\n-17\n")


def test_target_truncates_toward_zero(spark):
    df = spark.createDataFrame([(-17.58, 0), (-0.5, 0), (17.9, 0), (None, 0), (3.0, 1)], "r double, na int")
    assert [r.t for r in df.select(target_text("r", "na").alias("t")).collect()] == \
        ["-17", "0", "17", "LABEL_NA=1", "LABEL_NA=1"]


def test_sinks_roundtrip(spark, tmp_path):
    g = spark.createDataFrame([("贵州茅台\nx",)], "text string")
    write_jsonl(g, str(tmp_path / "j"))
    line = "".join(open(os.path.join(tmp_path / "j", f), encoding="utf-8").read()
                   for f in sorted(os.listdir(tmp_path / "j")) if f.endswith(".json")).strip()
    assert "贵州茅台" in line and json.loads(line) == {"text": "贵州茅台\nx"}
    write_txt(spark.createDataFrame([("a\n",), ("b\n",)], "text string").coalesce(1), str(tmp_path / "t"))
    body = open([os.path.join(tmp_path / "t", f) for f in os.listdir(tmp_path / "t") if f.startswith("part-")][0],
                encoding="utf-8").read()
    assert body == "a\n\n---\n\nb\n\n---\n\n"


def test_raw_gold_and_stats_sinks(spark, tmp_path):
    import glob

    from pitlake.sources.sinks import write_gold, write_raw, write_stats
    raw = spark.createDataFrame([("sina", "stock_zh_a_hist", "20240102", 1.0), ("sina", "stock_zh_a_hist", "static", 2.0)],
                                "source_domain string, interface string, date string, v double")
    write_raw(raw, str(tmp_path / "raw"))
    assert glob.glob(str(tmp_path / "raw/source_domain=sina/interface=stock_zh_a_hist/date=20240102/*.parquet"))
    assert glob.glob(str(tmp_path / "raw/source_domain=sina/interface=stock_zh_a_hist/date=static/*.parquet"))
    g = spark.createDataFrame([(t, dt.date(2024, 1, d), float(d)) for t in ("B", "A", "C") for d in (3, 1, 2)],
                              "ticker string, date date, v double")
    path = write_gold(g, str(tmp_path / "gold"), "features")
    back = spark.read.parquet(path)
    # every file holds one key range, sorted by (ticker, date) inside
    parts = back.select("ticker", "date", F.spark_partition_id().alias("p")).collect()
    by_part = {}
    for r in parts:
        by_part.setdefault(r.p, []).append((r.ticker, r.date))
    for rows in by_part.values():
        assert rows == sorted(rows)
    write_stats(spark.createDataFrame([("a", 1)], "column string, n bigint"), str(tmp_path / "stats"))
    body = "".join(open(f, encoding="utf-8").read() for f in glob.glob(str(tmp_path / "stats/part-*.csv")))
    assert body.splitlines() == ["column,n", "a,1"]
