"""Task manifest and resumable ingest: M1-M4, J7, U2.

A manifest row is one atomic fetch: interface, parameters, a stable task id
(sha256 of interface and canonical JSON parameters), landing path and status.
Building it is a join of the registry with the calendar; resuming is an
anti-join with the completed-task table -- both plain Spark jobs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.functions.scalar import canonical_params_json, date_param, landing_path, task_id
from pitlake.operators.grid import between_dates
from pitlake.sources.registry import BOOTSTRAP_SOURCE

MANIFEST_COLS = ("interface_id", "params", "params_json", "task_id", "source_domain", "output_path", "status")


def enrich(tasks: DataFrame, raw_base: str) -> DataFrame:
    """Task id, landing path and default status for rows with
    ``interface_id``, ``source_domain``, ``params`` (map<string,string>)."""
    tid = task_id(F.col("interface_id"), F.col("params"))
    out = (tasks.withColumn("params_json", canonical_params_json(F.col("params")))
           .withColumn("task_id", tid)
           .withColumn("output_path", landing_path(raw_base, F.col("source_domain"), F.col("interface_id"),
                                                   F.col("params"), F.col("task_id"))))
    if "status" not in out.columns:
        out = out.withColumn("status", F.lit("pending"))
    return out


def full_manifest(registry: DataFrame, calendar: DataFrame, lo=None, hi=None, raw_base: str = "data_raw",
                  scope: str = "market_wide_single_day") -> DataFrame:
    """M1: every source of ``scope`` x every trading day in [lo, hi], with the
    date parameter styled per source (F11).

    The registry is a few dozen rows, so it is the broadcast side; the
    calendar streams.
    """
    cal = between_dates(calendar.select(F.col("date").cast("date").alias("date")).distinct(), lo, hi)
    regs = registry.where(F.col("scope") == scope).select("interface_id", "source_domain")
    tasks = cal.crossJoin(F.broadcast(regs))
    tasks = tasks.withColumn("params", F.create_map(F.lit("date"), date_param(F.col("interface_id"), F.col("date"))))
    return enrich(tasks.drop("date"), raw_base).select(*MANIFEST_COLS)


def replay_manifest(registry: DataFrame, tickers: DataFrame, raw_base: str = "data_raw",
                    bootstrap_dir: str | None = None) -> DataFrame:
    """M2: one price task per ticker (file name from the ticker without its
    dot) plus one calendar task.  The ticker is part of the parameters, so
    every ticker gets its own id and landing file (T4)."""
    boot = bootstrap_dir or f"{raw_base.rstrip('/')}/bootstrap"
    price = "stock_zh_a_hist"
    cal = "tool_trade_date_hist_sina"
    reg = registry.select("interface_id", "source_domain")
    pattern = BOOTSTRAP_SOURCE[price]
    pre, post = pattern.split("{ticker}")
    px = (tickers.select("ticker").distinct()
          .crossJoin(F.broadcast(reg.where(F.col("interface_id") == price)))   # one registry row
          .select("interface_id", "source_domain", "ticker", F.lit("smoke_test_price_hist").alias("scope"),
                  F.concat(F.lit(f"{boot}/{pre}"), F.regexp_replace("ticker", r"\.", ""), F.lit(post)).alias("replay_path"),
                  F.create_map(F.lit("ticker"), F.col("ticker")).alias("params")))
    cl = (reg.where(F.col("interface_id") == cal)
          .select("interface_id", "source_domain", F.lit(None).cast("string").alias("ticker"),
                  F.lit("market_wide_calendar").alias("scope"),
                  F.lit(f"{boot}/{BOOTSTRAP_SOURCE[cal]}").alias("replay_path"),
                  F.create_map().cast("map<string,string>").alias("params")))
    return enrich(px.unionByName(cl), raw_base)


def single_task(spark: SparkSession, interface_id: str, params: dict[str, str], source_domain: str,
                raw_base: str = "data_raw") -> DataFrame:
    """M3: a one-task manifest (the online smoke task)."""
    df = spark.createDataFrame([(interface_id, source_domain, params)],
                               "interface_id string, source_domain string, params map<string,string>")
    return enrich(df, raw_base).select(*MANIFEST_COLS)


def pending(manifest: DataFrame, done: DataFrame) -> DataFrame:
    """Tasks whose id is not yet recorded as done (left anti join)."""
    return manifest.join(done.select("task_id").distinct(), "task_id", "left_anti")


def record_done(task_ids: DataFrame, checkpoint_path: str, run_id: str | None = None) -> str:
    """Add finished task ids to the completed-task table.

    Each run writes its own ``run=<id>`` folder, so concurrent or repeated
    runs never rewrite each other's records; readers take ``distinct`` ids.
    Returns the run's folder.
    """
    run_path = f"{checkpoint_path.rstrip('/')}/run={run_id or uuid.uuid4().hex}"
    task_ids.select("task_id").write.mode("overwrite").parquet(run_path)
    return run_path


def read_done(spark: SparkSession, checkpoint_path: str) -> DataFrame:
    """Completed task ids (empty when nothing was recorded yet)."""
    try:
        return spark.read.parquet(checkpoint_path).select("task_id").distinct()
    except Exception as exc:  # path missing -> nothing done
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        return spark.createDataFrame([], "task_id string")
