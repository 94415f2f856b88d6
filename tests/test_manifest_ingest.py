"""Manifest (M1-M3, F9-F11, J7, U2), replay ingest (M4), streaming ingest (T-S1)."""

import datetime as dt
import hashlib
import json


from paths import FIXTURES
from pitlake.operators.manifest import full_manifest, pending, read_done, record_done, replay_manifest, single_task
from pitlake.sources.files import PRICE_SCHEMA
from pitlake.sources.registry import SOURCES, registry
from pitlake.streaming.ingest import replay_ingest, stream_ingest


def _ref_id(iface, params):
    return hashlib.sha256(f"{iface}-{json.dumps(params, sort_keys=True)}".encode()).hexdigest()


def test_registry_counts(spark):
    reg = registry(spark)
    assert reg.count() == 49 == len(SOURCES)
    assert reg.where("scope = 'market_wide_single_day'").count() == 17


def test_task_id_and_path_match_python(spark):
    t = single_task(spark, "stock_gpzy_pledge_ratio_em", {"date": "20240906"}, "eastmoney.com").collect()[0]
    tid = _ref_id("stock_gpzy_pledge_ratio_em", {"date": "20240906"})
    assert t.task_id == tid
    assert t.output_path == (f"data_raw/source_domain=eastmoney.com/interface=stock_gpzy_pledge_ratio_em/"
                             f"date=20240906/part-{tid[:10]}.parquet")
    multi = single_task(spark, "x", {"b": "2", "a": 'q"1'}, "d").collect()[0]
    assert multi.task_id == _ref_id("x", {"b": "2", "a": 'q"1'})
    empty = single_task(spark, "x", {}, "d").collect()[0]
    assert empty.task_id == _ref_id("x", {}) and "/date=static/" in empty.output_path


def test_full_manifest_and_pending(spark, tmp_path):
    cal = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (2, 3, 4)], "date date")
    m = full_manifest(registry(spark), cal, "2024-01-03", "2024-01-04")
    assert m.count() == 17 * 2
    sse = m.where("interface_id = 'stock_sse_deal_daily'").select("params").collect()
    assert sorted(r.params["date"] for r in sse) == ["2024-01-03", "2024-01-04"]
    other = m.where("interface_id = 'stock_szse_summary'").collect()[0]
    assert other.task_id == _ref_id("stock_szse_summary", dict(other.params))
    done_path = str(tmp_path / "done")
    assert read_done(spark, done_path).count() == 0
    record_done(m.where("interface_id = 'stock_szse_summary'"), done_path)
    assert pending(m, read_done(spark, done_path)).count() == 16 * 2


def test_replay_ingest_and_stream(spark, tmp_path):
    tickers = spark.createDataFrame([("600519.SH",), ("601318.SH",)], "ticker string")
    man = replay_manifest(registry(spark), tickers, bootstrap_dir=FIXTURES).where("interface_id = 'stock_zh_a_hist'")
    ids = {r.task_id for r in man.collect()}
    assert len(ids) == 2                                        # ticker is part of the id (T4)
    landing, done = str(tmp_path / "landing"), str(tmp_path / "done")
    got = replay_ingest(spark, man, done, landing, f"{FIXTURES}/price_*.csv", PRICE_SCHEMA)
    assert {r.task_id for r in got.collect()} == ids
    raw = spark.read.parquet(landing)
    assert raw.count() == 426 and set(raw.columns) >= {"source_domain", "interface", "date", "ticker", "data_date"}
    # second run: nothing pending, nothing landed twice
    again = replay_ingest(spark, man, done, landing, f"{FIXTURES}/price_*.csv", PRICE_SCHEMA)
    assert again.count() == 0 and spark.read.parquet(landing).count() == 426
    # a run that landed but never recorded (crash) is replayed without duplicates
    lost = str(tmp_path / "done_lost")
    replay_ingest(spark, man, lost, landing, f"{FIXTURES}/price_*.csv", PRICE_SCHEMA)
    assert spark.read.parquet(landing).count() == 426
    # a pending task whose file is missing lands nothing -> the run fails
    import pytest
    ghost = replay_manifest(registry(spark), spark.createDataFrame([("000001.SZ",)], "ticker string"),
                            bootstrap_dir=FIXTURES).where("interface_id = 'stock_zh_a_hist'")
    with pytest.raises(RuntimeError):
        replay_ingest(spark, ghost, done, landing, f"{FIXTURES}/price_*.csv", PRICE_SCHEMA)
    # landing -> silver, incrementally
    schema = spark.read.parquet(landing).schema
    silver, ck = str(tmp_path / "silver"), str(tmp_path / "ck")
    stream_ingest(spark, landing, silver, ck, schema)
    s1 = spark.read.parquet(silver)
    assert s1.count() == 426 and "effective_date" in s1.columns and "date" not in s1.columns
    stream_ingest(spark, landing, silver, ck, schema)           # no new files -> no new rows
    assert spark.read.parquet(silver).count() == 426
    # a task landed again (new files, same rows) replaces its silver rows
    replay_ingest(spark, man, str(tmp_path / "done_again"), landing, f"{FIXTURES}/price_*.csv", PRICE_SCHEMA)
    stream_ingest(spark, landing, silver, ck, schema)
    assert spark.read.parquet(silver).count() == 426


def test_task_id_non_ascii_and_control_chars(spark):
    params = {"symbol": "当月", "x": 'a"b\\c\n\t\x01\x7f😀', "date": "2024-01-02"}
    t = single_task(spark, "stock_szse_sector_summary", params, "szse.cn").collect()[0]
    assert t.params_json == json.dumps(params, sort_keys=True)
    assert t.task_id == _ref_id("stock_szse_sector_summary", params)


def test_finished_files_are_not_opened(spark, tmp_path):
    """A finished task's file is spoiled so that opening it fails the run; names hold spaces and pattern signs."""
    from pyspark.sql import functions as F
    from pitlake.streaming.ingest import list_files
    src = tmp_path / "in put+[1]"
    src.mkdir()
    for i in range(4):
        (src / f"f {i}{{a}}%.csv").write_text(f"date,open\n2024-01-0{i + 1},{i}.5\n")
    man = spark.createDataFrame([(f"id{i}xxxxxxxxx", "stock_zh_a_hist", "sina", {"ticker": f"{i}"}, f"{src}/f {i}{{a}}%.csv") for i in range(5)],
                                "task_id string, interface_id string, source_domain string, params map<string,string>, replay_path string")
    landing, done, glob = str(tmp_path / "landing"), str(tmp_path / "done"), f"{tmp_path}/in*/*.csv"
    strict = {"header": "true", "mode": "FAILFAST"}
    run = lambda m, **kw: replay_ingest(spark, m, done, landing, glob, "date date, open double", options=strict, **kw)
    assert {r.length for r in list_files(spark, glob).collect()} == {25}
    assert run(man.where("params['ticker'] < '2'")).count() == 2
    for i in range(2):
        (src / f"f {i}{{a}}%.csv").write_text("date,open\nspoiled,row,too,long\n")
    # the fifth task has no file: it stays pending; two batches of about one file each
    assert {r.task_id[:3] for r in run(man, batch_files=1).collect()} == {"id2", "id3"}
    rows = {(r.ticker, r.open) for r in spark.read.parquet(landing).select(F.col("ticker").cast("string"), "open").collect()}
    assert rows == {(str(i), i + 0.5) for i in range(4)}
    assert run(man.where("params['ticker'] < '4'")).count() == 0
    import pytest
    with pytest.raises(RuntimeError):
        run(man)
