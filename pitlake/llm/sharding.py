"""Sharding by bytes: minimax contiguous partition of ordered atomic groups.

Groups of equal texts are atomic.  They are ordered (giants first, then by
content hash) and cut into contiguous shards whose largest size is the
smallest feasible one.  That capacity is found by search: each round tries
many capacities at once, and a capacity is feasible if greedy filling, one
aggregate job per shard over the prefix sums, needs no further shard.  A
shard is then a range of hashes, so rows learn theirs without a join.  A
group larger than an even share of what is left gets a shard of its own;
there are fewer such groups than shards.

Texts are never shuffled.  Prefix sums are taken inside 4096 hash buckets and
offset by the bucket totals; slots likewise inside cells of ids, so no task
holds a group or a shard.

Defined cases: a null text has no bytes (size 1) and belongs to the group of
empty texts; with fewer groups than shards the last shards stay empty; rows
that repeat an id get a slot each; a null id is an id; an empty table gives
no rows; extra columns are never read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitlake.llm.common import written

#: capacities tried at once, rows in a cell
TRIED, CELL_ROWS = 48, 50_000


def _furthest(prefix: DataFrame, targets: list[int], largest: int) -> list[int]:
    """For each target the greatest ``end`` that is not beyond it (0 if none), in one job."""
    ordered = sorted(set(targets))
    # a group ends within `largest` bytes before each target, so other rows need not be read
    near = prefix.filter((F.col("end") > ordered[0] - largest) & (F.col("end") <= ordered[-1]))
    beyond = F.size(F.filter(F.array(*map(F.lit, ordered)), lambda t: t < F.col("end")))
    found = dict(near.groupBy(beyond.alias("k")).agg(F.max("end")).collect())
    out, best = {}, 0
    for k, t in enumerate(ordered):
        best = max(best, found.get(k, 0))
        out[t] = best
    return [out[t] for t in targets]


def _greedy(prefix: DataFrame, capacities: list[int], shards: int, total: int, largest: int) -> list[list[int] | None]:
    """For each capacity the cut positions that greedy filling makes, None if it needs more shards."""
    cuts: list[list[int]] = [[] for _ in capacities]
    at = [0] * len(capacities)
    for _ in range(shards - 1):
        at = _furthest(prefix, [a + c for a, c in zip(at, capacities)], largest)
        for own, a in zip(cuts, at):
            own.append(a)
    return [own if total - a <= c else None for own, a, c in zip(cuts, at, capacities)]


def minimax_cuts(prefix: DataFrame, shards: int) -> tuple[int, list[int]]:
    """Smallest feasible capacity and its cut positions for ``prefix`` (bytes, end)."""
    total, largest = prefix.agg(F.max("end"), F.max("bytes")).first()
    if not total:
        return 0, []
    low = max(math.ceil(total / shards), largest)
    high = low + largest          # always feasible: a shard is closed only when over total / shards
    best = _greedy(prefix, [high], shards, total, largest)[0]
    while low < high:
        step = max(1, math.ceil((high - low) / (TRIED + 1)))
        tried = list(range(low, high, step))[:TRIED + 1]
        answers = _greedy(prefix, tried, shards, total, largest)
        k = next((k for k, x in enumerate(answers) if x is not None), None)
        if k is None:
            low = tried[-1] + 1
        else:
            high, best = tried[k], answers[k]
            low = tried[k - 1] + 1 if k else low
    return high, best


def _prefix(groups: DataFrame) -> DataFrame:
    """groups (h, bytes) with ``end``, the running total in order of h."""
    g = groups.withColumn("bucket", F.substring("h", 1, 3))
    sums = g.groupBy("bucket").agg(F.sum("bytes").alias("b"))      # 4096 rows at most
    before = sums.select("bucket", (F.sum("b").over(W.orderBy("bucket")) - F.col("b")).alias("before"))
    run = F.sum("bytes").over(W.partitionBy("bucket").orderBy("h"))
    return g.withColumn("run", run).join(F.broadcast(before), "bucket").select("h", "bytes", (F.col("before") + F.col("run")).alias("end"))


def shard_by_bytes(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, h (content hash), shard and gapless slot."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                               F.crc32(text).alias("text_crc32"), F.md5(text).alias("h")), "shard-rows")
    groups = rows.groupBy("h").agg(F.sum("size").alias("bytes"))
    largest = groups.orderBy(F.desc("bytes"), "h").limit(shards - 1).collect()      # fewer than `shards` can be giants
    left, giants = groups.agg(F.sum("bytes")).first()[0] or 0, []
    for g in largest:
        if g["bytes"] * (shards - len(giants)) <= left:
            break
        giants.append(g["h"])
        left -= g["bytes"]
    own = F.lit(None).cast("int")
    for k, h in enumerate(giants):
        own = F.when(F.col("h") == h, k).otherwise(own)
    prefix = written(_prefix(groups.filter(~F.col("h").isin(giants)) if giants else groups), "shard-prefix")
    _, cuts = minimax_cuts(prefix, shards - len(giants))
    shard: Column = F.lit(len(giants))
    if cuts:
        at = {r["end"]: r["h"] for r in prefix.filter(F.col("end").isin(cuts)).collect()}
        for c in cuts:
            shard = shard + (F.col("h") > at[c]).cast("int") if c else shard
    rows = rows.withColumn("shard", F.coalesce(own, shard).cast("int"))
    return _slots(rows, shards)


def _slots(rows: DataFrame, shards: int) -> DataFrame:
    """Gapless number of each row in its shard, counted inside cells of ids."""
    cells = max(16, math.ceil(rows.count() / shards / CELL_ROWS))
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("doc_id", "h"), F.lit(cells)))
    sums = rows.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))     # shards * cells rows
    before = sums.select("shard", "cell", (F.sum("n").over(W.partitionBy("shard").orderBy("cell")) - F.col("n")).alias("before"))
    in_cell = F.row_number().over(W.partitionBy("shard", "cell").orderBy("doc_id", "h"))
    return (rows.withColumn("k", in_cell - 1).join(before, ["shard", "cell"])
            .withColumn("slot", F.col("before") + F.col("k")).drop("k", "before", "cell"))


def sharding_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return shard_by_bytes(docs, 8).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                                          F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
