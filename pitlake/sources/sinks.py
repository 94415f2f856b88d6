"""Sinks S6-S11.

Writes are the only place rows are ordered or files are counted; every
stage before them is a lazy DataFrame.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_PARTITIONS = ("source_domain", "interface", "date")
CODEC = "zstd"          # of the landing table and silver, which are kept whole beside each other
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside delete their shuffle files as soon as they end, not when
    the driver happens to collect its garbage; the session's setting is put back."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def write_raw(df: DataFrame, base: str, mode: str = "append") -> None:
    """Hive-style landing table ``source_domain=/interface=/date=``."""
    df.write.mode(mode).option("compression", CODEC).partitionBy(*RAW_PARTITIONS).parquet(base)


def write_silver(df: DataFrame, base: str, interface_id: str, mode: str = "overwrite",
                 buckets: int | None = None, key: str = "ticker", date: str = "date") -> str:
    """One dataset per interface at ``base/interface=<id>``.

    ``buckets`` stores a keyed source bucketed (and sorted) by entity as the
    catalog table of that folder (see :func:`read_silver`).  Gold assembly
    over sources bucketed alike -- same key, same bucket count -- runs its
    entity windows without shuffling them: the shuffle is paid once, when
    silver is written, not on every gold build.  It deals the rows by bucket,
    an oversized one to several tasks.
    """
    path = f"{base.rstrip('/')}/interface={interface_id}"
    if buckets and key in df.columns:
        sort = [c for c in (key, date) if c in df.columns]
        (df.hint("rebalance", buckets, key).write.mode(mode).option("compression", CODEC).bucketBy(buckets, key).sortBy(*sort).option("path", path)
         .saveAsTable(silver_table(base, interface_id)))
        return path
    name = silver_table(base, interface_id)
    if df.sparkSession.catalog.tableExists(name):
        if mode != "overwrite":
            raise ValueError(f"{path} is a bucketed table; write to it with its buckets")
        # the folder's files are replaced by unbucketed ones: its table entry goes with them
        df.sparkSession.sql(f"DROP TABLE {name}")
    df.write.mode(mode).option("compression", CODEC).parquet(path)
    return path


def silver_table(base: str, interface_id: str) -> str:
    """Catalog name of one folder's bucketed table: another base, or an id
    that differs in its signs only, has another name."""
    place = hashlib.md5(f"{base.rstrip('/')}\n{interface_id}".encode()).hexdigest()[:12]
    return "silver_" + "".join(ch if ch.isalnum() else "_" for ch in interface_id) + "_" + place


def read_silver(spark, base: str, interface_id: str, bucketed: bool = True):
    """Silver of one interface: the bucketed catalog table when there is one
    (it carries the bucketing), else the plain parquet folder."""
    name = silver_table(base, interface_id)
    if bucketed and spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.read.parquet(f"{base.rstrip('/')}/interface={interface_id}")


def write_gold(df: DataFrame, base: str, kind: str, sort_keys=("ticker", "date"),
               mode: str = "overwrite") -> str:
    """Gold features / labels, range-partitioned and sorted by key (O1).

    Sorting happens here only: ``repartitionByRange`` gives each file a key
    range and ``sortWithinPartitions`` orders it, without a global single-task
    sort.
    """
    path = f"{base.rstrip('/')}/{kind}"
    keys = [k for k in sort_keys if k in df.columns]
    out = df
    if keys:
        out = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    out.write.mode(mode).parquet(path)
    return path


def write_stats(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A report CSV with header.

    Reports are one row per column of the audited table, so one file is safe.
    """
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, UTF-8, non-ASCII kept as is."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_txt(df: DataFrame, path: str, col: str = "text", sep: str = "\n---\n\n",
              mode: str = "overwrite") -> None:
    """Text blocks each followed by ``sep``."""
    df.select(F.col(col).alias("value")).write.mode(mode).option("lineSep", sep).text(path)
