"""Scans S1-S5: CSV price files, universe list, trading calendar, date window.

Schemas are declared, never inferred: inference costs an extra pass over the
data and would turn stock codes into integers (losing leading zeros).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.functions.scalar import ticker_of

PRICE_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("turnover", T.DoubleType()),
    T.StructField("adj_close_hfq", T.DoubleType()),
])

# price_<6-digit code><exchange>.csv, e.g. price_600519SH.csv -> 600519.SH
_PRICE_FILE = r"price_(\d{6})(SH|SZ)\.csv$"

# --- fixed values: window used when no date-window file exists ---
DEFAULT_WINDOW = ("2024-12-30", "2025-08-15")


def read_prices(spark: SparkSession, path: str, schema: T.StructType = PRICE_SCHEMA) -> DataFrame:
    """All per-ticker price CSVs under ``path`` in one scan.

    The ticker comes from each file's name (``_metadata.file_path``), so a
    thousand files are one parallel read rather than a thousand jobs; a file
    whose name holds no ticker fails the read.
    """
    df = (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
          .csv(path))
    fp = F.col("_metadata.file_path")
    code = F.regexp_extract(fp, _PRICE_FILE, 1)
    exch = F.regexp_extract(fp, _PRICE_FILE, 2)
    unknown = F.raise_error(F.concat(F.lit("no ticker in the name of price file "), fp)).cast("string")
    ticker = F.when(code == "", unknown).otherwise(F.concat(code, F.lit("."), exch))
    return df.select(ticker.alias("ticker"), *schema.fieldNames())


def read_universe(spark: SparkSession, path: str, with_weight: bool = False) -> DataFrame:
    """Index constituents (``;``-separated, BOM, CRLF), code = first column.

    All columns are read as strings so codes keep their leading zeros; the
    ticker gets its exchange suffix (P8).
    """
    raw = (spark.read.option("header", True).option("sep", ";").option("encoding", "UTF-8")
           .csv(path))
    code_col = raw.columns[0]
    out = [ticker_of(F.col(f"`{code_col}`")).alias("ticker"),
           F.trim(F.col(f"`{code_col}`")).alias("code")]
    if with_weight and len(raw.columns) >= 3:
        w = F.col(f"`{raw.columns[2]}`")
        out.append(F.regexp_replace(F.trim(w), ",", ".").try_cast("double").alias("weight"))
    return raw.select(*out)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """S3: trading calendar; accepts a ``date`` or ``trade_date`` column."""
    raw = spark.read.option("header", True).csv(path)
    name = "date" if "date" in raw.columns else "trade_date"
    return raw.select(F.to_date(F.trim(F.col(name))).alias("date")).where(F.col("date").isNotNull())


def read_window(spark: SparkSession, path: str | None) -> DataFrame:
    """Date window = first..last date listed in a text file.

    Returns a one-row DataFrame ``(lo, hi)``; falls back to the default window
    when the file is absent.  An empty file gives null bounds, which the grid
    reads as "no limit" (the whole calendar).
    """
    if path is not None:
        try:
            lines = spark.read.text(path)
            d = F.to_date(F.trim(F.col("value")))
            return (lines.where(F.trim(F.col("value")) != "")
                    .agg(F.min(d).alias("lo"), F.max(d).alias("hi")))
        except Exception as exc:  # AnalysisException: path does not exist
            if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
                raise
    lo, hi = DEFAULT_WINDOW
    return spark.range(1).select(F.lit(lo).cast("date").alias("lo"), F.lit(hi).cast("date").alias("hi"))


def window_bounds(window: DataFrame) -> tuple:
    """Two scalars (lo, hi) for use as literals, so the date filter reaches the scan."""
    row = window.first()
    return row["lo"], row["hi"]
