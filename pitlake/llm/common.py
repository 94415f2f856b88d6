"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: a key is hot when it holds more than 1/HOT_SHARE of all rows; at most HOT_SHARE keys can be
HOT_SHARE = 1000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; in local mode, where
    it may be unset, a temporary one is made and set for the session."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required on a cluster")
    made = "file://" + tempfile.mkdtemp(prefix="pitlake-llm-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def attach(rows: DataFrame, table: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Inner join of ``rows`` with ``table`` (one row per key; ``weight`` is the
    number of rows that have the key), safe against hot keys.

    Keys holding more than 1/HOT_SHARE of all rows, of which there can be
    HOT_SHARE at most, are joined by broadcast; all other keys have a small
    share and are joined by shuffle.  Both inputs are read more than once:
    pass scans or written tables.
    """
    total, most = table.agg(F.sum(weight), F.max(weight)).first()
    limit = (total or 0) / HOT_SHARE
    if not most or most <= limit:
        return rows.join(table, keys)
    hot = F.broadcast(table.filter(F.col(weight) > limit))
    return (rows.join(hot, keys)
            .unionByName(rows.join(hot, keys, "left_anti").join(table.filter(F.col(weight) <= limit), keys)))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def keep_documents(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is in ``ids`` (one doc_id column, a null
    id matching a null id)."""
    ids = ids.select(F.col("doc_id").alias("__id"))
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["__id"]), "left_semi")
