"""Exact quantiles (linear interpolation) without one task holding a column.

Spark's exact ``percentile`` keeps every distinct value of a column in one
aggregation buffer -- for a global aggregate that is the whole column in one
task.  Here the k-th smallest value is found digit by digit:

1. Every value has a leading digit: its sign and its logarithm in steps of a
   ``STEPS``-th of a doubling, some 68,000 digits for all doubles.  One pass counts
   all columns' values per digit, with each digit's least and greatest value.
2. Running counts tell which digit holds a wanted rank.  Where its least and
   greatest value are one, or the rank is the first or last of it, that is the value.
3. Otherwise the next digit is the value's place between the two, in ``PLACES``
   equal parts; only values between them are counted, and step 2 follows.

Both digits never fall as values rise (a logarithm, a difference and a quotient
round that way), so they sort as the values do.  A digit of step 1 spans 2^48
doubles and step 3 divides by 2^16 each time: four passes in all for doubles of
any size, and fewer for short ones.  A pass is a partial aggregate of all columns
and ranks together; only the wanted digits' bounds, a few numbers per column,
reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

#: leading digits per doubling (2^52 doubles), and parts of a later digit
STEPS, PLACES = 16, 1 << 16


def _known(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x)


def _leading(x: Column) -> Column:
    """Sign and binary logarithm as a whole number, in the order of the values."""
    size = F.abs(x)
    # the least double is 2^-1074: all logarithms become positive; infinity comes after the greatest
    digit = F.when(size == float("inf"), F.lit(2200 * STEPS)).otherwise((F.floor(F.log2(size) * STEPS) + 1080 * STEPS).cast("int"))
    return F.when(x == 0, F.lit(0)).when(x > 0, digit).otherwise(-digit)


def _place(x: Column, lo: float, hi: float) -> Column:
    return F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(PLACES - 1))).cast("int")


def _digits(df: DataFrame, brackets: dict) -> DataFrame:
    """(b, d, v): the digit of every value that lies in a bracket; ``brackets``:
    id -> (column, least, greatest), or no bounds for the leading digit.  The
    brackets of a column do not overlap, so a value has one digit at most."""
    of: dict[str, list] = {}
    for b, (c, lo, hi) in brackets.items():
        of.setdefault(c, []).append((b, lo, hi))
    items, any_of = [], F.lit(False)
    for c, parts in of.items():
        x = F.col(f"`{c}`").cast("double")
        item = None
        for b, lo, hi in parts:
            inside = _known(x) if lo is None else _known(x) & x.between(F.lit(lo), F.lit(hi))
            row = F.struct(F.lit(b).alias("b"), (_leading(x) if lo is None else _place(x, lo, hi)).alias("d"), x.alias("v"))
            item = F.when(inside, row) if item is None else item.when(inside, row)
            any_of = any_of | inside
        items.append(item)
    return df.where(F.coalesce(any_of, F.lit(False))).select(F.explode(F.array_compact(F.array(*items))).alias("s")).select("s.b", "s.d", "s.v")


def _pick(df: DataFrame, brackets: dict, wanted: dict) -> list:
    """One pass: of each wanted rank (bracket id -> ranks inside the bracket)
    its digit's values below (lo_r), number, least and greatest value."""
    freq = (_digits(df, brackets).groupBy("b", "d")
            .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most")))
    # a bracket has PLACES digits at most
    w = W.partitionBy("b").orderBy("d").rowsBetween(W.unboundedPreceding, W.currentRow)
    cum = freq.select("b", "n", "least", "most", F.sum("n").over(w).alias("hi_r")).withColumn("lo_r", F.col("hi_r") - F.col("n"))
    tgt = df.sparkSession.createDataFrame([(b, int(k)) for b, ks in wanted.items() for k in sorted(ks)],
                                          T.StructType([T.StructField("b", T.IntegerType()), T.StructField("k", T.LongType())]))
    # the target table has one row per wanted rank: a handful per column
    hit = cum.join(F.broadcast(tgt), (cum.b == tgt.b) & (cum.lo_r <= tgt.k) & (tgt.k < cum.hi_r))
    return hit.select(tgt.b.alias("b"), "k", "lo_r", "n", "least", "most").collect()


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], counts: dict | None = None) -> dict:
    """Linear-interpolation quantiles (pandas ``describe`` / SQL
    ``quantile_cont``).  Returns ``{(col, prob): value or None}``; nulls and
    NaN do not count.  ``counts`` (non-null, non-NaN count per column) may be
    passed in when the caller already aggregated them.
    """
    cols = list(dict.fromkeys(cols))
    if not cols:
        return {}
    if counts is None:
        row = df.agg(*[F.count(F.when(_known(F.col(f"`{c}`").cast("double")), 1)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
        counts = {c: row[f"n{i}"] for i, c in enumerate(cols)}
    # targets: (col, rank) for the floor and ceiling rank of each prob
    ranks: dict[str, set] = {c: set() for c in cols}
    plan = {}
    for c in cols:
        n = counts[c] or 0
        for q in probs:
            if n == 0:
                plan[(c, q)] = None
                continue
            pos = (n - 1) * q
            lo_r, hi_r = int(math.floor(pos)), int(math.ceil(pos))
            plan[(c, q)] = (lo_r, hi_r, pos - lo_r)
            ranks[c].update({lo_r, hi_r})
    found: dict = {}
    brackets = {i: (c, None, None) for i, c in enumerate(cols) if ranks[c]}
    wanted = {i: {k: k for k in ranks[c]} for i, (c, _, _) in brackets.items()}     # rank inside the bracket -> rank of the column
    while brackets:
        ids, next_brackets, next_wanted = {}, {}, {}
        for r in _pick(df, brackets, wanted):
            c, rank = brackets[r["b"]][0], wanted[r["b"]][r["k"]]
            inside = r["k"] - r["lo_r"]
            if r["least"] == r["most"] or inside == 0 or inside == r["n"] - 1:
                found[(c, rank)] = r["least"] if inside == 0 else r["most"]
                continue
            b = ids.setdefault((c, r["least"]), len(ids))
            next_brackets[b] = (c, r["least"], r["most"])
            next_wanted.setdefault(b, {})[inside] = rank
        brackets, wanted = next_brackets, next_wanted
    return {(c, q): None if pl is None else _lerp(found[(c, pl[0])], found[(c, pl[1])], pl[2]) for (c, q), pl in plan.items()}


def _lerp(lo: float, hi: float, d: float) -> float:
    """``lo * (1 - d) + hi * d`` as one fused multiply-add -- the rounding
    SQL engines' ``quantile_cont`` uses, so values agree to the last bit."""
    if not d:
        return lo
    return math.fma(lo, 1.0 - d, hi * d)
