"""Audit A1-A4, A7, A8, J9: missing values, descriptive statistics, NA-label
counts, look-ahead check, combined summary, row accounting.

Every report is one global aggregate over the audited table (partial
aggregation on every partition, a few numbers per column cross the shuffle),
turned into rows afterwards -- the data itself is never unpivoted.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.functions.scalar import all_matching, numeric_columns, pct
from pitlake.operators.quantiles import exact_quantiles

PROBS = (0.25, 0.5, 0.75)
STAT_COLS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _missing(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    miss = _q(c).isNull()
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        miss = miss | F.isnan(_q(c))
    return F.sum(F.when(miss, 1).otherwise(0)).cast("bigint")


def _round_half_up(x: float, digits: int) -> float:
    """Same rounding as SQL ``round`` (F12) for values computed on the driver."""
    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


def _inline(pairs: list[Column]) -> Column:
    return F.inline(F.array(*pairs))


def missing_report(df: DataFrame) -> DataFrame:
    """A1: ``column, missing_count, missing_percentage`` (NaN counts as missing)."""
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[_missing(df, c).alias(f"__m{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"__m{i}").alias("missing_count"))
            for i, c in enumerate(df.columns)]
    return (agg.select("__n", _inline(rows))
            .select("column", "missing_count", pct(F.col("missing_count"), F.col("__n")).alias("missing_percentage")))


def _column_stats(df: DataFrame, exact: bool, accuracy: int, reuse: bool = True) -> tuple[list, list]:
    """One aggregate pass: rows, and per column missing count; per numeric
    column count, mean, std, min, max (plus an approximate quantile sketch
    when not exact).

    Exact quantiles take a few more passes over the numeric columns, so the
    passes run on a persisted projection holding only the numeric columns and
    one null flag per other column (memory, spilling to disk; lost blocks are
    recomputed from lineage), released afterwards.  An input that is already
    cached is used as is, and so is a stored table (``reuse=False``), whose
    passes read the needed columns only.
    """
    cols = numeric_columns(df.schema)
    others = [c for c in df.columns if c not in cols]
    src, cached = df, None
    if exact and reuse and cols and not df.is_cached:
        proj = df.select(*[_q(c) for c in cols], *[_q(c).isNull().alias(f"__null{i}") for i, c in enumerate(others)])
        src = cached = proj.persist(StorageLevel.MEMORY_AND_DISK)

    def miss(c):
        if src is not df and c in others:
            return F.sum(F.col(f"__null{others.index(c)}").cast("int")).cast("bigint")
        return _missing(df, c)

    aggs = [F.count(F.lit(1)).alias("__n")] + [miss(c).alias(f"__m{i}") for i, c in enumerate(df.columns)]
    for i, c in enumerate(cols):
        x = F.when(~F.isnan(_q(c).cast("double")), _q(c).cast("double"))
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        if not exact:
            aggs.append(F.percentile_approx(x, list(PROBS), accuracy).alias(f"p{i}"))
    try:
        first = src.agg(*aggs).first()
        if exact:
            qs = exact_quantiles(src, cols, PROBS, counts={c: first[f"c{i}"] for i, c in enumerate(cols)}) if cols else {}
            quant = {c: [qs[(c, p)] for p in PROBS] for c in cols}
        else:
            quant = {c: list(first[f"p{i}"]) if first[f"p{i}"] is not None else [None] * len(PROBS)
                     for i, c in enumerate(cols)}
    finally:
        if cached is not None:
            cached.unpersist()
    desc = [(c, first[f"c{i}"], first[f"m{i}"], first[f"s{i}"], first[f"lo{i}"], *quant[c], first[f"hi{i}"])
            for i, c in enumerate(cols)]
    n = first["__n"]
    miss_rows = [(c, first[f"__m{i}"], _round_half_up(100.0 * first[f"__m{i}"] / n, 2) if n else None)
                 for i, c in enumerate(df.columns)]
    return desc, miss_rows


DESC_SCHEMA = T.StructType([T.StructField("column", T.StringType())] +
                           [T.StructField(s, T.LongType() if s == "count" else T.DoubleType()) for s in STAT_COLS])


def describe_numeric(df: DataFrame, exact: bool = True, accuracy: int = 10_000) -> DataFrame:
    """A2: per numeric column count, mean, std (sample), min, 25/50/75 % (linear
    interpolation), max -- all as double except ``count``.

    The report has one row per column, so it is built from the few collected
    numbers.  ``exact=False`` uses ``percentile_approx`` (one pass, bounded
    sketch) instead of the exact counting passes.
    """
    desc, _ = _column_stats(df, exact, accuracy)
    return df.sparkSession.createDataFrame(desc, DESC_SCHEMA)


def stats_summary(df: DataFrame, exact: bool = True, accuracy: int = 10_000, reuse: bool = True) -> DataFrame:
    """A7 (= A2 full-outer-join A1 on ``column``, J9), ordered by column.

    Built from the same single aggregate pass as A1 and A2 (plus the exact
    quantile passes), not by re-reading the table per report."""
    desc, miss = _column_stats(df, exact, accuracy, reuse)
    # both halves are one small row per column: merge them here
    d = {r[0]: r[1:] for r in desc}
    m = {r[0]: r[1:] for r in miss}
    empty = (None,) * len(STAT_COLS)
    rows = [(c, *d.get(c, empty), *m.get(c, (None, None))) for c in sorted(set(d) | set(m))]
    schema = T.StructType(DESC_SCHEMA.fields + [T.StructField("missing_count", T.LongType()),
                                                T.StructField("missing_percentage", T.DoubleType())])
    return df.sparkSession.createDataFrame(rows, schema)


def label_na_report(df: DataFrame, needle: str = "label_na") -> DataFrame:
    """A3: ``label_horizon, na_label_count`` = sum of each ``label_na*`` column."""
    cols = all_matching(df.columns, needle)
    if not cols:
        schema = "label_horizon string, na_label_count bigint"
        return df.sparkSession.createDataFrame([], schema)
    agg = df.agg(*[F.sum(_q(c)).cast("bigint").alias(f"__s{i}") for i, c in enumerate(cols)])
    return agg.select(_inline([F.struct(F.lit(c).alias("label_horizon"), F.col(f"__s{i}").alias("na_label_count"))
                               for i, c in enumerate(cols)]))


def lookahead_audit(df: DataFrame, date: str = "date", needle: str = "effective_date") -> DataFrame:
    """A4: per ``*effective_date*`` column, rows whose availability date is after
    the row's date; ``passed`` is true when there are none."""
    cols = all_matching([c for c in df.columns if c != date], needle)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, violations bigint, passed boolean")
    d = _q(date).cast("date")
    agg = df.agg(*[F.sum(F.when(_q(c).cast("date") > d, 1).otherwise(0)).cast("bigint").alias(f"__v{i}")
                   for i, c in enumerate(cols)])
    return (agg.select(_inline([F.struct(F.lit(c).alias("column"), F.col(f"__v{i}").alias("violations"))
                                for i, c in enumerate(cols)]))
            .withColumn("passed", F.col("violations") == 0))


def accounting(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whatever action runs ``df``
    next (no extra job).  ``obs.get`` -> ``{"rows": n}`` after the action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def shape(df: DataFrame) -> tuple[int, int]:
    """Row and column count of a table (one count job)."""
    return df.count(), len(df.columns)
