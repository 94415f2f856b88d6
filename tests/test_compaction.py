"""Packing of the landing table: the rows stay as they are, the files become few."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from pitlake.sources import compaction
from pitlake.sources.compaction import compact, generations, read_compacted

SOURCE = ("a.com", "stock_margin_sse")


def put(spark, base, day, task, rows, mode="overwrite", schema="code string, n int, note string"):
    folder = f"{base}/source_domain={SOURCE[0]}/interface={SOURCE[1]}/date={day}/task=part-{task}"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode(mode).parquet(folder)
    return folder


def plain(df):
    return sorted(str(tuple(r)) for r in df.select("code", "n", "note", "source_domain", "interface", "date", "task").collect())


def landed(spark, base):
    df = spark.read.option("mergeSchema", True).parquet(base)
    return plain(df.withColumns({c: F.col(c).cast("string") for c in ("date", "task")}))


def files(packed):
    return [f for f in glob.glob(f"{packed}/**/rows/**/*.parquet", recursive=True)]


def test_round_trip(spark, tmp_path):
    base, packed = str(tmp_path / "land ing+"), str(tmp_path / "packed")
    for k in range(24):
        put(spark, base, "static" if k == 5 else 20240101 + k, f"t{k}", [(f"c{k}", i, None) for i in range(k % 3 + 1)])
    before = landed(spark, base)
    assert plain(read_compacted(spark, base, *SOURCE, packed)) == before and generations(spark, packed, *SOURCE) == []
    size = sum(os.path.getsize(f) for f in glob.glob(f"{glob.escape(base)}/**/*.parquet", recursive=True))
    target = size // 3
    assert compact(spark, base, *SOURCE, packed, target) <= 4
    assert 1 <= len(files(packed)) <= 4 and plain(read_compacted(spark, base, *SOURCE, packed)) == before
    # nothing new: nothing is written
    assert compact(spark, base, *SOURCE, packed, target) == 0 and generations(spark, packed, *SOURCE) == [0]
    # a task landed again, one added, a file added to a folder, one with a further column
    put(spark, base, 20240103, "t2", [("again", 7, "x")])
    put(spark, base, 20240201, "late", [("late", 8, None)])
    put(spark, base, 20240104, "t3", [("more", 9, None)], mode="append")
    now = landed(spark, base)
    assert now != before and plain(read_compacted(spark, base, *SOURCE, packed)) == now
    # a run that was cut off before its commit is not seen, and is replaced
    shutil.copytree(f"{packed}/source_domain={SOURCE[0]}/interface={SOURCE[1]}/rows/generation=0", f"{packed}/source_domain={SOURCE[0]}/interface={SOURCE[1]}/rows/generation=1")
    assert plain(read_compacted(spark, base, *SOURCE, packed)) == now
    assert compact(spark, base, *SOURCE, packed, target) == 1 and generations(spark, packed, *SOURCE) == [0, 1]
    assert plain(read_compacted(spark, base, *SOURCE, packed)) == now
    # the owner clears a packed folder's files: its rows are read from the packed ones
    for f in glob.glob(f"{glob.escape(base)}/**/task=part-t7/*.parquet", recursive=True):
        os.remove(f)
    assert plain(read_compacted(spark, base, *SOURCE, packed)) == now


def test_batches_and_large_folders(spark, tmp_path):
    base, packed = str(tmp_path / "landing"), str(tmp_path / "packed")
    for k in range(9):
        put(spark, base, 20240101 + k, f"t{k}", [(f"c{k}", k, None)])
    put(spark, base, 20240201, "large", [(f"{i * 7919 % 10007}x{i}", i, "n") for i in range(5000)])
    compact(spark, base, *SOURCE, packed, 20_000, batch_files=4)
    assert len(generations(spark, packed, *SOURCE)) > 1
    assert spark.read.parquet(*files(packed)).count() == 9           # the large file needs no packing
    assert plain(read_compacted(spark, base, *SOURCE, packed)) == landed(spark, base)


def test_replaced_folders_beyond_the_broadcast_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(compaction, "BROADCAST_FOLDERS", 0)
    base, packed = str(tmp_path / "landing"), str(tmp_path / "packed")
    for k in range(3):
        put(spark, base, 20240101 + k, "t", [("a", k, None)])
    compact(spark, base, *SOURCE, packed)
    put(spark, base, 20240102, "t", [("b", 5, None)])
    assert plain(read_compacted(spark, base, *SOURCE, packed)) == landed(spark, base)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        compact(spark, base, "a.com", "no_such", packed)
