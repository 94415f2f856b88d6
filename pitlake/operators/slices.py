"""Hot keys of an ordered scan, cut by their rows: range partitions over (key, time).

A window on a key is one task per key, and a window on (key, period) one per
period, however many rows that holds.  Here a key with more than its share of
all rows is cut at quantiles of its own times, so a slice holds about a share;
the scan then runs per (key, slice), seeded with what the slices before it
carry over (``joins.asof_join`` and ``treat.ffill`` with ``split="rows"``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 1024             # slices of one key at most; the sketch's error is a tenth of one of them
BLOCK = 32              # slice starts compared at a time (MOST = BLOCK * BLOCK)


def hot_keys(rows: DataFrame, key: str, time: str, parts: int | None = None) -> DataFrame:
    """``__h`` (key), ``__m`` (slices), ``__starts`` (sorted times at which its
    slices 1, 2, ... begin) and ``__copies`` of every key with more than
    1 / ``parts`` of ``rows`` (default: the session's shuffle partitions).

    A time that fills several shares alone starts one slice, which may be
    dealt over that many copies.  Two passes over key and time run at once.
    There are fewer than ``parts`` hot keys and 2 * ``parts`` starts, whatever
    the data: they come to the driver, so that every later use, and every
    retry of a task, cuts at the same times.
    """
    spark = rows.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select(F.col(key).alias("__h"), F.col(time).alias("__t"))
    total = rows.count()
    n = F.col("__n") * parts
    hot = (rows.groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).where(n > total)
           .select(F.col("__h").alias("__k"), F.least(F.ceil(n / total), F.lit(MOST)).cast("int").alias("__m")))
    sketch = F.percentile_approx("__t", [i / MOST for i in range(1, MOST)], 10 * MOST)
    cuts = (rows.join(F.broadcast(hot), F.col("__h").eqNullSafe(F.col("__k")))
            .groupBy("__h", "__m").agg(sketch.alias("__q")))
    at = F.transform(F.sequence(F.lit(1), F.col("__m") - 1),
                     lambda i: F.element_at("__q", F.round(i * MOST / F.col("__m")).cast("int")))
    none = F.array().cast(cuts.schema["__q"].dataType)
    out = (cuts.withColumn("__a", F.when(F.col("__q").isNull(), none).otherwise(at))     # no time at all: one slice
           .withColumn("__starts", F.array_distinct("__a"))
           .withColumn("__copies", F.transform("__starts", lambda s: F.size(F.filter("__a", lambda a: a == s))))
           .select("__h", "__m", "__starts", "__copies"))
    return spark.createDataFrame(out.toArrow(), out.schema)


def tag(rows: DataFrame, hot: DataFrame, key: str, time: str) -> DataFrame:
    """``rows`` with their slice ``__P`` (0 for keys that are not hot, -1 for a
    missing time) and the number of its copies ``__n``."""
    joined = rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("__h")), "left")
    t = F.col(time)
    place = F.when(t.isNull(), -1).otherwise(F.coalesce(_before("__starts", t), F.lit(0)))
    copies = (F.when(F.col("__P") < 0, F.col("__m")).when(F.col("__P") > 0, F.get("__copies", F.col("__P") - 1)))
    return (joined.withColumn("__P", place).withColumn("__n", F.coalesce(copies, F.lit(1)))
            .drop("__h", "__m", "__starts", "__copies"))


def _before(starts: str, t: Column) -> Column:
    """How many of the sorted starts are not after ``t``: first among every
    ``BLOCK``-th of them, then inside one block."""
    firsts = F.filter(starts, lambda s, i: i % BLOCK == 0)
    block = F.size(F.filter(firsts, lambda s: s <= t)) - 1
    inside = F.slice(F.col(starts), block * BLOCK + 1, F.lit(BLOCK))
    return F.when(F.col(starts).isNotNull(),
                  F.when((F.size(starts) == 0) | (F.get(starts, F.lit(0)) > t), 0)
                  .otherwise(block * BLOCK + F.size(F.filter(inside, lambda s: s <= t))))


def heads(hot: DataFrame) -> DataFrame:
    """One row per slice of a hot key that has another before it: ``__k``, ``__P``, ``__n``."""
    each = hot.select(F.col("__h").alias("__k"), F.posexplode("__copies").alias("__i", "__n"))
    return each.select("__k", (F.col("__i") + 1).alias("__P"), "__n")
