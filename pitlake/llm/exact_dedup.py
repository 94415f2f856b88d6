"""Exact dedup: group by 128-bit content hash, keep the smallest stable id,
compare bytes inside groups.

Built-in functions only.  Texts are equal when they are the same after each
run of ASCII white space is replaced by one space.  The texts are shuffled
once, for the byte comparison, with copies merged before the shuffle; the
rows that learn their group carry hashes only.

Defined cases: a null text counts as empty; empty texts form one group; very
long texts are hashed and compared whole; a
group whose ids are all null has a null ``keep_id`` and its rows count as
kept; rows that repeat a doc_id and a text are all marked alike (the pipeline
stage keeps one row of each group); an empty table gives no rows; extra columns
are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm.common import attach, written

SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: str | Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    base = docs.select(F.col(id_col).alias("__id"), normalised(F.col(text_col)).alias("__text"))
    hashes = [F.unhex(F.md5("__text")).alias("__h"), F.sha2("__text", 256).alias("text_sha256")]
    rows = written(base.select("__id", *hashes), "exact-rows")
    # grouping by hash and text compares the bytes of all rows that share a hash
    groups = written(base.groupBy(hashes[0], "__text")
                     .agg(F.min("__id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
                     .select("__h", hashes[1], "keep_id", "group_size"), "exact-groups")
    return (attach(rows, groups, ["__h", "text_sha256"], "group_size")
            .select(F.col("__id").alias(id_col), "keep_id", "group_size",
                    F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"))


def exact_dedup_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return exact_groups(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one row of each group of equal texts: the smallest id's, or any if all ids are null.

    Null and empty texts are one group; of rows that repeat the smallest id one
    stays; very long texts are compared whole; no rows give no rows.  The texts are
    shuffled once, copies of a task merged before: the kept row travels with
    its group, its own text only where white space sets it apart.
    """
    plain = normalised(F.col("text"))
    rest = F.struct(*(F.col(c) for c in docs.columns if c != "text")).alias("r")
    rows = docs.select(plain.alias("__plain"), rest, F.when(~F.col("text").eqNullSafe(plain), F.struct("text")).alias("own"))
    order = F.struct(F.col("r.doc_id").isNull().alias("none"), F.col("r.doc_id").alias("id"), F.hash("r", "own").alias("h"))
    kept = rows.groupBy(F.unhex(F.md5("__plain")).alias("__h"), "__plain").agg(F.min_by(F.struct("r", "own"), order).alias("k"))
    text = F.when(F.col("k.own").isNull(), F.col("__plain")).otherwise(F.col("k.own.text")).alias("text")
    return kept.select(*(text if c == "text" else F.col(f"k.r.{c}").alias(c) for c in docs.columns))


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents),
     g AS (SELECT x, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.x) AS text_sha256
FROM t JOIN g USING (x)
"""
