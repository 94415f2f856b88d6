"""Normalisation raw -> silver: P1-P4, P11-P12, U1.

Stock codes and other identifiers stay strings; dates become ``DateType``
once, at this boundary, so later joins and filters compare dates, not text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from pitlake.functions.scalar import date_form, parse_date, pct, with_date


def rename_by_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns present in ``mapping``; others are untouched."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def normalise_date(df: DataFrame, date: str = "date", out: str = "effective_date") -> DataFrame:
    """``date`` -> ``effective_date`` (DateType), dropping ``date``.

    Written dates may have any of the forms of :func:`parse_date`.
    Unparseable values become null rather than failing the job
    (:func:`date_report` counts them); a frame without ``date`` is returned
    unchanged.
    """
    if date not in df.columns:
        return df
    c = F.col(date)
    dt = df.schema[date].dataType
    dated = (df.withColumn(out, c.cast("date")) if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType))
             else with_date(df, out, c))
    return dated.drop(date) if out != date else dated


def date_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per date column and form: rows, rows that parse, and the share of the
    column's rows (percent).  Form null: empty values (``parsed`` 0) and values
    of no known form.  One pass over all columns."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), date_form(F.col(f"`{c}`")).alias("form"),
                                        parse_date(F.col(f"`{c}`")).isNotNull().alias("ok")) for c in cols])).alias("x")
    counts = df.select(each).groupBy("x.column", "x.form").agg(F.count(F.lit(1)).alias("rows"), F.count_if("x.ok").alias("parsed"))
    whole = F.sum("rows").over(W.partitionBy("column"))             # a handful of rows a column
    return counts.withColumn("percent", pct(F.col("rows"), whole))


def attach_key(df: DataFrame, ticker, key: str = "ticker") -> DataFrame:
    """Add the task's ticker when the task has one and the data lacks it."""
    if ticker is None or key in df.columns:
        return df
    return df.withColumn(key, ticker if not isinstance(ticker, str) else F.lit(ticker))


def pick_date_key(df: DataFrame, date: str = "date") -> DataFrame:
    """Join key = ``effective_date`` if present (drop ``date``), else ``date``;
    a calendar-like ``trade_date`` is accepted too."""
    if "effective_date" in df.columns:
        return df.drop(date).withColumnRenamed("effective_date", date)
    if date not in df.columns and "trade_date" in df.columns:
        return df.withColumnRenamed("trade_date", date)
    return df


def to_date_key(df: DataFrame, date: str = "date") -> DataFrame:
    """Cast the join key to DateType (timestamps truncate to the day)."""
    return df.withColumn(date, F.col(date).cast("date"))


def apply_schema(df: DataFrame, schema: Sequence[tuple[str, str]]) -> DataFrame:
    """Cast named features to declared types; bad values become null.

    Declared ``float64`` -> double, ``int8`` -> tinyint.  Columns not in the
    schema pass through.
    """
    types = {"float64": "double", "int8": "tinyint", "int64": "bigint", "int32": "int",
             "str": "string", "object": "string"}
    want = {n: types.get(t, t) for n, t in schema}
    return df.select(*[F.col(f"`{c}`").try_cast(want[c]).alias(c) if c in want else F.col(f"`{c}`")
                       for c in df.columns])


def common_type(types: Sequence[T.DataType]) -> T.DataType:
    """Least type that holds every value of ``types``: whole numbers widen to
    the longest, any other mix of numbers to double (decimals of one scale
    stay decimal), dates and timestamps to the timestamp, whatever else
    differs to string.  An all-null (void) column takes the others' type."""
    kinds = [t for i, t in enumerate(types) if t not in types[:i] and not isinstance(t, T.NullType)]
    if len(kinds) <= 1:
        return kinds[0] if kinds else T.StringType()
    if all(isinstance(t, T.IntegralType) for t in kinds):
        return max(kinds, key=lambda t: ("tinyint", "smallint", "int", "bigint").index(t.simpleString()))
    if all(isinstance(t, T.DecimalType) for t in kinds) and len({t.scale for t in kinds}) == 1:
        return max(kinds, key=lambda t: t.precision)
    if all(isinstance(t, T.NumericType) for t in kinds):
        return T.DoubleType()
    if all(isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) for t in kinds):
        return next((t for t in kinds if isinstance(t, T.TimestampType)), T.TimestampNTZType())
    return T.StringType()


def union_sources(dfs: Sequence[DataFrame]) -> DataFrame:
    """Stack frames of one interface; columns = union, missing -> null.

    Fetches of one interface may disagree on a column's type (a column that
    was all whole numbers, empty, or held text one day): each frame is cast to
    the column's :func:`common_type` before the union, so no value is lost or
    read as another.  Nested columns have to agree.
    """
    if not dfs:
        raise ValueError("nothing to union")
    types: dict[str, list] = {}
    for d in dfs:
        for f in d.schema.fields:
            types.setdefault(f.name, []).append(f.dataType)
    want = {c: common_type(ts) for c, ts in types.items()}
    for c, ts in types.items():
        if len({t.simpleString() for t in ts}) > 1 and any(isinstance(t, (T.StructType, T.ArrayType, T.MapType)) for t in ts):
            raise ValueError(f"column {c!r} is nested and differs: {[t.simpleString() for t in ts]}")
    out = None
    for d in dfs:
        cast = d.select(*[F.col(f"`{f.name}`") if f.dataType == want[f.name] else F.col(f"`{f.name}`").cast(want[f.name]).alias(f.name)
                          for f in d.schema.fields])
        out = cast if out is None else out.unionByName(cast, allowMissingColumns=True)
    return out


def normalise(df: DataFrame, columns_map: Mapping[str, str] | None = None,
              ticker=None) -> DataFrame:
    """P1 -> P2 -> P3 for one raw frame."""
    out = rename_by_map(df, columns_map or {})
    out = normalise_date(out)
    return attach_key(out, ticker)


# --- fixed value: where an entity column holds its code: digits alone, after a
# two-letter market mark, or after the name and a slash; a market suffix may follow ---
CODE = r"^(?:.*/)?(?:[A-Za-z]{2})?(\d+)(?:\.[A-Za-z]{2})?$"


def normalise_source(df: DataFrame, interface_id: str, fetch_date=None, key: str = "ticker", ticker=None) -> DataFrame:
    """Raw frame of a registered source -> silver with ``ticker`` / ``effective_date``.

    Applies the source's column map, turns its entity-code column into an
    exchange-qualified ticker (P8) and its date column into
    ``effective_date`` (P2).  Sources without a date column are dated by
    ``fetch_date`` -- a literal, or a column such as the landing table's
    ``date`` partition (``yyyyMMdd``; ``static`` gives null).  A value of the
    entity column without a code in the documented place gives a null ticker.
    Sources without an entity column take the task's ``ticker`` (a literal or
    a column, P3) when there is one, else they stay market-wide.
    """
    from pitlake.functions.scalar import ticker_of
    from pitlake.sources.registry import COLUMNS_MAP, KEY_COLUMNS

    if interface_id not in KEY_COLUMNS:
        raise ValueError(f"unregistered source {interface_id!r}")
    out = rename_by_map(df, COLUMNS_MAP.get(interface_id, {}))
    code_col, date_col = KEY_COLUMNS[interface_id]
    if code_col is not None and code_col in out.columns and key not in out.columns:
        # a column of its own: the ticker reads it several times
        code = F.regexp_extract(F.trim(F.col(f"`{code_col}`").cast("string")), CODE, 1)
        out = out.withColumn("__code", code).withColumn(key, F.when(F.col("__code") != "", ticker_of(F.col("__code")))).drop("__code")
    elif ticker is not None and key not in out.columns:
        out = attach_key(out, ticker, key)
    if date_col is not None and date_col in out.columns:
        if date_col != "date":
            out = out.drop("date") if "date" in out.columns else out
            out = out.withColumnRenamed(date_col, "date")
    elif fetch_date is not None:
        fd = fetch_date if not isinstance(fetch_date, str) or fetch_date in out.columns else F.lit(fetch_date)
        if isinstance(fd, str):
            fd = F.col(fd)
        out = with_date(out, "date", fd)
    return normalise_date(out)
