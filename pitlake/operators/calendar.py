"""Trading-calendar operators: W1 index, W3 enrichment, D4 availability shift.

A calendar has one row per trading day, so it is bounded by the number of
days it spans (about 250 a year), never by data volume.  That bound is what
makes the single-partition ordering windows here and the broadcasts of
date-keyed tables elsewhere safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def distinct_dates(df: DataFrame, date: str = "date") -> DataFrame:
    """A5: distinct trading dates (map-side partial aggregation, one row per date)."""
    return df.select(F.col(date).cast("date").alias("date")).where(F.col("date").isNotNull()).distinct()


def calendar_index(calendar: DataFrame, date: str = "date") -> DataFrame:
    """``(date, idx)``, idx = 0-based position of each distinct trading date."""
    cal = distinct_dates(calendar, date)
    return cal.select("date", (F.row_number().over(W.orderBy("date")) - 1).alias("idx"))


def enrich_calendar(calendar: DataFrame, date: str = "date") -> DataFrame:
    """``date, is_trade, prev_trade_date, next_trade_date``.

    The first date has no previous and the last no next trading date (null).
    """
    cal = distinct_dates(calendar, date)
    w = W.orderBy("date")
    return cal.select("date", F.lit(1).alias("is_trade"),
                      F.lag("date", 1).over(w).alias("prev_trade_date"),
                      F.lead("date", 1).over(w).alias("next_trade_date"))


# --- fixed values: trading-day offset of each availability rule ---
AVAIL_OFFSETS = {"T_day_1500": 0, "T_plus_1": 1, "T_plus_5": 5}
# rules whose availability date is a column of the source itself
AVAIL_COLUMN_RULES = ("announcement_date", "change_date")


def first_trading_index(days: DataFrame, calendar: DataFrame, day: str = "day", out: str = "idx") -> DataFrame:
    """``(day, out)``: calendar index of the first trading date on or after each
    distinct day of ``days`` (null past the calendar end).

    Works on the distinct days (partial aggregate) stacked with the calendar:
    a backward-ordered window over at most (days + trading days) rows -- one
    row per date, bounded by the time span, not by data volume.
    """
    cal = calendar_index(calendar)
    d = days.select(F.col(day).cast("date").alias("__day")).where(F.col("__day").isNotNull()).distinct()
    both = (d.select("__day", F.lit(0).alias("__s"), F.lit(None).cast("int").alias("__ci"))
            .unionByName(cal.select(F.col("date").alias("__day"), F.lit(1).alias("__s"), F.col("idx").alias("__ci"))))
    wf = W.orderBy(F.col("__day").desc(), F.col("__s").desc()).rowsBetween(W.unboundedPreceding, 0)
    return (both.withColumn("__n", F.last("__ci", ignorenulls=True).over(wf))
            .where(F.col("__s") == 0).select(F.col("__day").alias(day), F.col("__n").alias(out)))


def shift_available(df: DataFrame, calendar: DataFrame, rule: str, date: str = "date",
                    avail_col: str | None = None, out: str = "effective_date") -> DataFrame:
    """Earliest trading date on which a source row may be used.

    ``T_day_1500`` -> the row's own trading date; ``T_plus_n`` -> n trading
    days later (past the calendar end -> null, the row never becomes usable);
    ``announcement_date`` / ``change_date`` -> the date in ``avail_col``,
    moved to the first trading date on or after it.

    The day -> date map has one row per distinct source day (bounded by the
    time span), so it is broadcast; the data side is never shuffled.
    """
    if rule in AVAIL_OFFSETS:
        n = AVAIL_OFFSETS[rule]
        src_day = F.col(date).cast("date")
    elif rule in AVAIL_COLUMN_RULES:
        if avail_col is None:
            raise ValueError(f"rule {rule!r} needs avail_col")
        n = 0
        src_day = F.col(avail_col).cast("date")
    else:
        raise ValueError(f"unknown avail_rule {rule!r}")
    with_day = df.withColumn("_sd", src_day)
    first = first_trading_index(with_day.select("_sd"), calendar, "_sd", "_ni")
    target = calendar_index(calendar).select(F.col("idx").alias("_ni2"), F.col("date").alias(out))
    day_map = (first.withColumn("_ni2", F.col("_ni") + F.lit(n))
               .join(target, "_ni2", "left").select("_sd", out))
    return with_day.join(F.broadcast(day_map), "_sd", "left").drop("_sd")
