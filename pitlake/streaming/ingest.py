"""Incremental ingest: M4 (batch resume) and T-S1 (Structured Streaming).

M4 replays landed source files: the pending tasks (manifest anti-join done)
are matched by path to the listing of the files, only the matched files are
opened, written to the hive-style landing table and recorded as done, a batch
at a time.  A task that produced no rows is not recorded, so the next run retries
it.

T-S1 turns the landing table into silver incrementally: new landing files are
tracked by the stream's checkpoint (which replaces the reference's
lock-protected checkpoint file), and each of their tasks is written as a whole.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.operators.manifest import pending, read_done, record_done
from pitlake.operators.normalise import normalise_date, rename_by_map
from pitlake.sources.sinks import RAW_PARTITIONS

log = logging.getLogger(__name__)

SILVER_PARTITIONS = ("interface", "task")


def list_files(spark: SparkSession, files_glob: str) -> DataFrame:
    """Files of a glob as a table (``path``, ``length``); none is opened."""
    return spark.read.format("binaryFile").load(files_glob).select("path", "length")


def _plain(path: Column, encoded: bool = False) -> Column:
    """A path in one form: no ``file:`` mark, and no URL escapes where it has them."""
    if encoded:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, "^file:/*", "/")


def replay_ingest(spark: SparkSession, manifest: DataFrame, done_path: str, landing: str,
                  files_glob: str, schema: T.StructType, file_format: str = "csv",
                  options: Mapping[str, str] | None = None, batch_files: int = 10_000) -> DataFrame:
    """M4 (batch): land every pending task's replay file and record it.

    The landing table is ``source_domain=/interface=/date=/task=part-<id[:10]>``
    (the task level plays the role of the per-task file name).

    ``files_glob`` names all replay files.  They are listed as a table, the
    pending tasks are matched to it by ``replay_path``, and only the matched
    files are opened: a resumed run reads nothing of finished tasks.  About
    ``batch_files`` files are landed and recorded at a time, so a run that is
    cut off keeps the batches before, and only a batch's paths pass through
    the driver.  Returns the task ids recorded in this run.
    """
    todo = pending(manifest, read_done(spark, done_path)).select(
        "task_id", "interface_id", "source_domain", "params", _plain(F.col("replay_path")).alias("__rp"))
    files = list_files(spark, files_glob).select("path", _plain(F.col("path")).alias("__rp"))
    n_todo = todo.count()                       # A8: tasks this run should land
    runs = []
    if n_todo:
        matched = todo.join(files, "__rp").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            batches = max(1, -(-matched.count() // batch_files))
            for b in range(batches):
                tasks = matched.where(F.pmod(F.xxhash64("__rp"), F.lit(batches)) == b)
                paths = [r.path for r in tasks.select("path").distinct().collect()]         # a batch at most
                if paths:
                    runs.append(_land(spark, tasks.drop("path"), paths, done_path, landing, schema, file_format, options))
        finally:
            matched.unpersist()
    landed = spark.read.parquet(*runs).select("task_id") if runs else spark.createDataFrame([], "task_id string")
    n_done = landed.count()
    log.info("replayed %d of %d pending tasks", n_done, n_todo)
    if n_todo and not n_done:
        raise RuntimeError(f"none of the {n_todo} pending tasks produced rows")
    return landed


def _land(spark: SparkSession, tasks: DataFrame, paths: list[str], done_path: str, landing: str, schema: T.StructType,
          file_format: str, options: Mapping[str, str] | None) -> str:
    """Land the tasks of these files and record those that gave rows; returns the record's folder."""
    literal = [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths]           # names, not patterns
    reader = spark.read.schema(schema).options(**(options or {"header": "true"})).format(file_format)
    rows = reader.load(literal).withColumn("__rp", _plain(F.col("_metadata.file_path"), encoded=True))
    landed = rows.join(tasks, "__rp", "inner")
    if "date" in landed.columns:
        landed = landed.withColumnRenamed("date", "data_date")
    date_part = F.regexp_replace(F.coalesce(F.element_at("params", F.lit("date")), F.lit("static")), "-", "")
    out = (landed.withColumn("interface", F.col("interface_id"))
           .withColumn("ticker", F.element_at("params", F.lit("ticker")))
           .withColumn("date", date_part)
           # "part-<id[:10]>": a value that is never read back as a number
           .withColumn("task", F.concat(F.lit("part-"), F.substring("task_id", 1, 10)))
           .drop("__rp", "params", "interface_id")
           .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        # one folder per task, replaced as a whole: a run that failed after
        # landing but before recording lands the same task again without
        # duplicating it
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*RAW_PARTITIONS, "task").parquet(landing))
        # only tasks that landed rows are recorded; empty ones are retried
        return record_done(out.select("task_id").distinct(), done_path)
    finally:
        out.unpersist()


def stream_ingest(spark: SparkSession, landing: str, silver: str, checkpoint: str, schema: T.StructType,
                  columns_map: Mapping[str, str] | None = None, date_col: str = "data_date",
                  max_files_per_trigger: int = 1000):
    """T-S1: landing -> silver for files not yet processed, then stop.

    ``trigger(availableNow=True)`` processes everything present at start in
    micro-batches of at most ``max_files_per_trigger`` files and ends;
    rerunning picks up only new files.  Silver has one folder per interface
    and task, and a batch rewrites the folders of its tasks as a whole, from
    all their landed files: a task that is landed again, or whose files fall
    into two batches, or a batch that is run again replaces its rows.
    Returns the finished ``StreamingQuery``.
    """
    src = (spark.readStream.schema(schema).option("basePath", landing)
           .option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing))

    def rewrite(batch: DataFrame, _: int) -> None:
        tasks = batch.select(*SILVER_PARTITIONS).distinct()         # a batch's files at most
        df = (batch.sparkSession.read.schema(schema).option("basePath", landing).parquet(landing)
              .join(F.broadcast(tasks), list(SILVER_PARTITIONS), "left_semi"))
        df = rename_by_map(df, dict(columns_map or {}))
        if date_col in df.columns and date_col != "date":
            df = df.drop("date").withColumnRenamed(date_col, "date")
        (normalise_date(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*SILVER_PARTITIONS).parquet(silver))

    q = (src.writeStream.foreachBatch(rewrite).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
