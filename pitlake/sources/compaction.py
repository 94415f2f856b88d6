"""Small files of the landing table packed into files of a target size.

The landing table has a folder per task, so a source fetched daily for years is
a great many tiny files.  A compaction packs one interface's small files that no
earlier one has packed; what is packed is not written again.  It writes the rows,
then the list of files they came from, and last a one-row commit; readers see a
generation only by its commit, so it appears as a whole or not at all, and a
run that was cut off is replaced by the next.  Landing files are left in place.

:func:`read_compacted` gives the rows of the landing table as they are now: a
folder that has changed since it was packed (a task landed again, or a file
added) is read from the landing table, all others from their last generation.
The packed files may be cleared from a folder by their owner as long as the
folder is from then on only replaced as a whole.  One compaction of an
interface may run at a time.
"""

from __future__ import annotations

import math
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.operators.normalise import union_sources
from pitlake.sources.sinks import RAW_PARTITIONS

TARGET_BYTES = 256 << 20
FILES = "path string, length bigint, modified timestamp, folder string"
#: replaced folders that are sent to the readers of packed rows; beyond, they are joined by shuffle
BROADCAST_FOLDERS = 200_000


def _folder(path: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(path, r"^(.*)/[^/]*$", 1), "^file:/*", "/")


def landed_files(spark: SparkSession, landing: str, domain: str, interface: str) -> DataFrame:
    """Files of one interface (FILES); none is opened."""
    own = f"{landing.rstrip('/')}/source_domain={domain}/interface={interface}"
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(own))
    return found.select("path", "length", F.col("modificationTime").alias("modified"), _folder(F.col("path")).alias("folder"))


def _table(packed: str, domain: str, interface: str, name: str) -> str:
    return f"{packed.rstrip('/')}/source_domain={domain}/interface={interface}/{name}"


def generations(spark: SparkSession, packed: str, domain: str, interface: str) -> list[int]:
    """Committed generations, one a compaction."""
    try:
        found = spark.read.schema("files bigint, generation int").parquet(_table(packed, domain, interface, "commits"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(r.generation for r in found.select("generation").distinct().collect())


def _packed(spark: SparkSession, packed: str, domain: str, interface: str, name: str, live: list[int], schema: str | None = None) -> DataFrame:
    base = _table(packed, domain, interface, name)
    reader = spark.read.option("basePath", base)
    reader = reader.schema(f"{schema}, generation int") if schema else reader.option("mergeSchema", True)
    return reader.parquet(*[f"{base}/generation={g}" for g in live])


def _read_paths(spark: SparkSession, landing: str, paths: list[str]) -> DataFrame:
    literal = [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths]
    df = spark.read.option("basePath", landing.rstrip("/")).option("mergeSchema", True).parquet(*literal)
    # read as text whatever the names look like, so that tasks agree
    return df.withColumns({c: F.col(c).cast("string") for c in (*RAW_PARTITIONS, "task") if c in df.columns})


def changed_folders(files: DataFrame, known: DataFrame | None) -> DataFrame:
    """Folders (``folder``) that hold a file which no generation has packed."""
    if known is None:
        return files.select("folder").distinct()
    return files.join(known, ["path", "length", "modified"], "left_anti").select("folder").distinct()


def compact(spark: SparkSession, landing: str, domain: str, interface: str, packed: str,
            target_bytes: int = TARGET_BYTES, batch_files: int = 10_000) -> int:
    """Pack what is new in one interface; returns the number of files written.

    Folders whose mean file reaches ``target_bytes`` need no packing and are
    left out.  Rows are ranged by folder, so a packed file covers few dates;
    there are at most as many files as the packed bytes fill, rounded up.  Some
    ``batch_files`` files are packed at a time, each batch a generation.
    """
    files = landed_files(spark, landing, domain, interface)
    live = generations(spark, packed, domain, interface)
    known = _packed(spark, packed, domain, interface, "files", live, FILES) if live else None
    small = files.groupBy("folder").agg(F.avg("length").alias("mean")).where(F.col("mean") < target_bytes).select("folder")
    todo = files.join(changed_folders(files, known).join(small, "folder"), "folder").select("path", "length", "modified", "folder").persist()
    written = 0
    try:
        count = todo.count()
        batches = math.ceil(count / batch_files)
        for b in range(batches):
            own = todo if batches == 1 else todo.where(F.pmod(F.xxhash64("folder"), F.lit(batches)) == b)
            listed = [(r.path, r.length) for r in own.select("path", "length").collect()]           # a batch's names
            if listed:
                bins = max(1, math.ceil(sum(n for _, n in listed) / target_bytes))
                written += _pack(spark, landing, packed, domain, interface, own, [p for p, _ in listed], bins, max(live, default=-1) + 1)
                live.append(max(live, default=-1) + 1)
    finally:
        todo.unpersist()
    return written


def _pack(spark: SparkSession, landing: str, packed: str, domain: str, interface: str, own: DataFrame, paths: list[str], bins: int,
          generation: int) -> int:
    to = lambda name: f"{_table(packed, domain, interface, name)}/generation={generation}"
    file = F.col("_metadata.file_path")
    rows = (_read_paths(spark, landing, paths).drop("source_domain", "interface").withColumn("__file", F.xxhash64(file))
            .withColumn("__folder", F.url_decode(F.replace(_folder(file), F.lit("+"), F.lit("%2B")))))
    (rows.repartitionByRange(bins, "__folder", "__file").sortWithinPartitions("__folder").drop("__file")
     .write.mode("overwrite").parquet(to("rows")))
    own.write.mode("overwrite").parquet(to("files"))
    spark.createDataFrame([(len(paths),)], "files bigint").coalesce(1).write.mode("overwrite").parquet(to("commits"))
    return bins


def read_compacted(spark: SparkSession, landing: str, domain: str, interface: str, packed: str) -> DataFrame:
    """One interface's landed rows, packed ones from their files; partition columns are text.

    The folders changed since the last compaction pass through the driver as
    names; compact as often as keeps them few.
    """
    live = generations(spark, packed, domain, interface)
    if not live:
        return _read_paths(spark, landing, [f"{landing.rstrip('/')}/source_domain={domain}/interface={interface}"])
    known = _packed(spark, packed, domain, interface, "files", live, FILES)
    changed = changed_folders(landed_files(spark, landing, domain, interface), known)
    held = known.select("folder", "generation").distinct()
    newest = held.groupBy("folder").agg(F.max("generation").alias("newest")).join(changed.withColumn("new", F.lit(True)), "folder", "left")
    stale = (held.join(newest, "folder").where((F.col("generation") < F.col("newest")) | F.col("new"))
             .select(F.col("folder").alias("__folder"), "generation"))
    rows = _packed(spark, packed, domain, interface, "rows", live)
    replaced = stale.count()
    if replaced:
        rows = rows.join(F.broadcast(stale) if replaced <= BROADCAST_FOLDERS else stale, ["__folder", "generation"], "left_anti")
    rows = rows.drop("__folder", "generation").withColumns({"source_domain": F.lit(domain), "interface": F.lit(interface)})
    loose = [r.folder for r in changed.collect()]
    return union_sources([rows, _read_paths(spark, landing, loose)]) if loose else rows
