"""Exact top-k inner-product search: tiled matrix products of query blocks and
candidate shards, partial selection per tile, tree merging of the lists.

Vectors become integers, floor(scale * x), so scores are exact.  Distinct
queries and all candidates are dealt into tiles of TILE_BYTES of vectors, and every
query tile meets every candidate tile in a task of its own: rows go to
executors only, and a task holds two tiles whatever the number of queries.  A
task keeps a running list of k per query.  Lists are then merged in a tree of
fan-in FAN_IN, so no task sees more than FAN_IN lists of a query.  Candidates are dealt
by their place in the table, so rows that repeat do not meet in one tile.

Defined cases: a vector that is null or empty, or holds a null or non-finite
component, takes no part; a query sees candidates of its own length only;
candidates with the query's id are its own rows and are left out; repeated
query rows run once, rows of one id with different vectors run each,
repeated candidate rows count each; ties go to the
smaller id; a score beyond 64 bits counts as the nearest 64-bit number but the least;
rows with a null id take no part; no queries or no candidates give
no rows; extra columns are never read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm.common import written

#: bytes of a tile's vectors; candidates and queries that are multiplied at once; lists merged at once
TILE_BYTES, TILE, ROWS_AT_ONCE, FAN_IN = 32 << 20, 4096, 256, 32
CELL = ["dim", "query_tile", "tile"]
FOUND = "query_id long, query_key long, tile int, vec_id long, score long"


def integer_matrix(vectors: pa.ChunkedArray, scale: float) -> np.ndarray:
    """Vectors of one length and without nulls, as rows."""
    flat = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat.astype(np.float64).reshape(len(vectors), -1) * scale)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T, exact: in doubles while every sum stays below 2^53, else in Python integers."""
    if a.shape[1] * np.abs(a).max() * np.abs(b).max() < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    as_int = lambda m: np.array([[int(x) for x in r] for r in m], dtype=object)
    limit = 2 ** 63 - 1
    return np.clip(as_int(a) @ as_int(b).T, -limit, limit).astype(np.int64)


def select(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query among (query, id, score) entries: higher score first, then smaller id."""
    order = np.lexsort((ids, -scores, q))
    q, ids, scores = q[order], ids[order], scores[order]
    first = np.r_[True, q[1:] != q[:-1]]
    rank = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
    best = rank < k
    return q[best], ids[best], scores[best]


def tile_best(queries: np.ndarray, query_ids: np.ndarray, tile: np.ndarray, ids: np.ndarray, k: int):
    """Entries of one tile that can be among a query's k best; a query's own id is left out."""
    out = []
    for at in range(0, len(queries), ROWS_AT_ONCE):
        s = products(queries[at:at + ROWS_AT_ONCE], tile)
        other = query_ids[at:at + ROWS_AT_ONCE, None] != ids[None, :]
        low = np.iinfo(np.int64).min
        s = np.where(other, s, low)
        kth = np.partition(s, len(ids) - k, axis=1)[:, len(ids) - k] if len(ids) > k else np.full(len(s), low)
        r, c = np.nonzero((s >= kth[:, None]) & other)
        out.append(select(r + at, ids[c], s[r, c], k))
    return [np.concatenate(x) for x in zip(*out)]


def _searcher(scale: float, k: int):
    names = [c.split()[0] for c in FOUND.split(", ")]

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not (len(queries) and len(candidates)):
            return pa.table([pa.array([], pa.int64() if c != "tile" else pa.int32()) for c in names], names)
        q_ids, q_keys, q_matrix = queries["id"].to_numpy(), queries["key"].to_numpy(), integer_matrix(queries["v"], scale)
        best = None
        for at in range(0, len(candidates), TILE):
            part = candidates.slice(at, TILE)
            found = tile_best(q_matrix, q_ids, integer_matrix(part["v"], scale), part["id"].to_numpy(), k)
            best = found if best is None else select(*(np.concatenate(x) for x in zip(best, found)), k)
        tile = np.full(len(best[0]), candidates["tile"][0].as_py(), np.int32)
        return pa.table([q_ids[best[0]], q_keys[best[0]], tile, best[1], best[2]], names)

    return run


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest inner products."""
    spark = candidates.sparkSession

    def usable(df):
        v = F.col(vec_col)
        v = v if df.schema[vec_col].dataType.simpleString() in ("array<float>", "array<double>") else v.cast("array<double>")
        finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return (df.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).filter((F.size(v) > 0) & finite)
                .select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.size(v).alias("dim")))

    rows = usable(candidates)
    asked = written(usable(queries).distinct().withColumn("key", F.xxhash64("id", "v")), "topk-queries")
    # one row per length of vectors: d lengths take d * d / 2 components at least, so they are few
    count = lambda df: {r["dim"]: r["count"] for r in df.groupBy("dim").count().collect()}
    n_queries, n_rows = count(asked), count(rows)
    plan, cores = [], spark.sparkContext.defaultParallelism
    for dim in sorted(n_queries.keys() & n_rows.keys()):
        fit = max(1, TILE_BYTES // (8 * dim))
        query_tiles = math.ceil(n_queries[dim] / fit)
        plan.append((dim, query_tiles, max(math.ceil(n_rows[dim] / fit), math.ceil(cores / query_tiles))))
    if not plan:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    tiles = F.broadcast(spark.createDataFrame(plan, "dim int, query_tiles int, tiles int"))

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def dealt(by, n):
        return F.pmod(F.xxhash64(by), F.col(n)).cast("int")

    left = (asked.join(tiles, "dim").withColumn("query_tile", dealt("key", "query_tiles")).withColumn("tile", every("tiles"))
            .select(*CELL, "id", "key", "v"))
    right = (rows.withColumn("place", F.monotonically_increasing_id()).join(tiles, "dim").withColumn("tile", dealt("place", "tiles"))
             .withColumn("query_tile", every("query_tiles")).select(*CELL, "id", "v"))
    cells = left.groupBy(*CELL).cogroup(right.groupBy(*CELL)).applyInArrow(_searcher(scale, k), FOUND).withColumnRenamed("tile", "part")
    best = cells.groupBy("query_id", "query_key", "part").agg(F.collect_list(F.struct((-F.col("score")).alias("neg"), "vec_id")).alias("top"))
    groups = max(c for _, _, c in plan)
    while groups > 1:
        groups = math.ceil(groups / FAN_IN)
        merged = F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, k)
        best = best.groupBy("query_id", "query_key", F.floor(F.col("part") / FAN_IN).alias("part")).agg(merged.alias("top"))
    best = best.withColumn("top", F.slice(F.array_sort("top"), 1, k))
    return (best.select("query_id", F.posexplode("top").alias("pos", "e"))
            .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("e.vec_id").alias("vec_id"), (-F.col("e.neg")).alias("score")))


def topk_query(spark: SparkSession, embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, embeddings.filter(F.col("vec_id") % 100 == 0), 10)


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
     r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
