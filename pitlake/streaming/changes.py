"""T-S1 with state: each interface's landing folder is a stream of its own,
normalised by its registered columns, and ends as a log of changes.

The state of a key and month holds, for every day, which landing its newest
row came from and a print of that row.  A micro-batch gives at most one
row per key and day, and only if it is newer than what the state knows and
differs from it; outdated files, whenever they come, give nothing.  A newer
landing of the same row is kept in the state alone and written down ("touch"
row) when the state is let go after ``hold`` without news.  So the log
holds what is needed at any time, :func:`read_changes` gives exactly the last row
per key and day of all landed files, and state is bounded by what has been
landed within ``hold``.  Nothing landed before is read again.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.plans.landed import PERIOD, landed_silver

#: columns of a row's landing: time and name of the file, and a print of the row; newest is the greatest
VERSION = ("__at", "__in", "__print")
NO_DAY = -(1 << 31)
STATE = "day array<int>, at array<bigint>, file array<bigint>, print array<bigint>, touched array<boolean>"
CHANGE = "__row array<string>, __at bigint, __in bigint, __print bigint, __touch boolean"


def _text(name: str, t: T.DataType) -> Column:
    """A value as text that :func:`_value` reads back without loss."""
    if isinstance(t, (T.StructType, T.ArrayType, T.MapType, T.BinaryType)):
        raise ValueError(f"column {name!r} is nested or binary; make it flat before it is streamed")
    c = F.col(f"`{name}`")
    return F.unix_micros(c).cast("string") if isinstance(t, T.TimestampType) else c.cast("string")


def _value(c: Column, t: T.DataType) -> Column:
    return F.timestamp_micros(c.cast("bigint")) if isinstance(t, T.TimestampType) else c.cast(t)


def versioned(rows: DataFrame, interface: str) -> DataFrame:
    """Landed rows as silver, with the columns of VERSION."""
    out = rows.withColumn("__at", F.unix_micros("_metadata.file_modification_time")).withColumn("__in", F.xxhash64("_metadata.file_path"))
    out = landed_silver(out, interface)
    return out.withColumn("__print", F.xxhash64(*[F.col(f"`{c}`") for c in out.columns if c not in VERSION]))


def default_keys(columns: Sequence[str]) -> list[str]:
    return [c for c in ("ticker", PERIOD) if c in columns]


def latest(rows: DataFrame, keys: Sequence[str] | None = None, date: str = "effective_date") -> DataFrame:
    """Last row per key and day of versioned rows, or of a log with its touch rows.

    One exchange by key and day serves both steps: per print the newest
    landing, then the print that was landed last.  Null keys and days are
    values like others.
    """
    data = [c for c in rows.columns if c not in (*VERSION, "__touch")]
    by = [*(default_keys(data) if keys is None else keys), date]
    touch = F.col("__touch") if "__touch" in rows.columns else F.lit(False)
    one = (rows.repartition(*by).groupBy(*by, "__print")
           .agg(F.max(F.struct(*VERSION)).alias("__v"), F.max_by(F.struct(*[F.col(f"`{c}`") for c in data]), ~touch).alias("__row")))
    return one.groupBy(*by).agg(F.max_by("__row", "__v").alias("__row")).select("__row.*")


def _follow(names: list[str], keys: list[str], date: str):
    """State function of one key and month.  It is let go when the watermark, which
    stays ``hold`` behind the clock, passes the time of its last news."""
    columns = [c.split()[0] for c in CHANGE.split(", ")]

    def row_of(key: tuple, day: int) -> list:
        own = dict(zip(keys, key[:-1]))
        own[date] = None if day == NO_DAY else (datetime.date(1970, 1, 1) + datetime.timedelta(days=day)).isoformat()
        return [own.get(n) for n in names]

    def run(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held = {d: (tuple(v), bool(t)) for d, *v, t in zip(*state.get)} if state.exists else {}
        if state.hasTimedOut:
            state.remove()
            out = [(row_of(key, d), *v, True) for d, (v, touched) in held.items() if touched]
            yield pd.DataFrame(out, columns=columns)
            return
        news: dict = {}
        now = 0
        for f in frames:
            now = max(now, int(f["__ms"].max()))
            last = f.sort_values(["__day", *VERSION]).drop_duplicates("__day", keep="last")
            for day, row, *version in zip(last["__day"], last["__row"], *(last[c] for c in VERSION)):
                version = tuple(int(x) for x in version)
                if day not in news or version > news[day][0]:
                    news[int(day)] = version, row
        out = []
        for day, (version, row) in news.items():
            known = held.get(day)
            if known and version <= known[0]:
                continue
            same = known is not None and known[0][2] == version[2]
            held[day] = version, same
            if not same:
                out.append((list(row), *version, False))
        days = sorted(held)
        state.update((days, *([held[d][0][k] for d in days] for k in range(3)), [held[d][1] for d in days]))
        state.setTimeoutTimestamp(now)
        yield pd.DataFrame(out, columns=columns)

    return run


def stream_changes(spark: SparkSession, landing: str, domain: str, interface: str, silver: str, checkpoint: str, schema: T.StructType,
                   keys: Sequence[str] | None = None, date: str = "effective_date", hold: datetime.timedelta = datetime.timedelta(days=7),
                   max_files_per_trigger: int = 1000, max_file_age: str = "3650d"):
    """New landing files of one interface -> its log of changes, then stop.

    ``schema`` is that of the landing table (partition columns included) for
    this interface.  ``keys`` are the columns that tell rows of one day apart
    (by default the ticker, and the report period where there is one).  A
    batch that is run again replaces its own folder.  Files dated more than
    ``max_file_age`` before the newest are not taken by the file source.
    Returns the finished ``StreamingQuery``.
    """
    own = T.StructType([f for f in schema.fields if f.name not in ("source_domain", "interface")])      # partitions below the folder
    src = (spark.readStream.schema(own).option("maxFilesPerTrigger", max_files_per_trigger).option("maxFileAge", max_file_age)
           .parquet(f"{landing.rstrip('/')}/source_domain={domain}/interface={interface}"))
    rows = versioned(src, interface)
    fields = [f for f in rows.schema.fields if f.name not in VERSION]
    by = list(default_keys(rows.columns) if keys is None else keys)
    named = rows.select(*[_text(k, rows.schema[k].dataType).alias(f"__k{n}") for n, k in enumerate(by)],
                        F.coalesce(F.trunc(date, "month").cast("string"), F.lit("")).alias("__month"),
                        F.coalesce(F.unix_date(date), F.lit(NO_DAY)).alias("__day"),
                        F.array(*[_text(f.name, f.dataType) for f in fields]).alias("__row"), *VERSION,
                        F.current_timestamp().alias("__now"), F.unix_millis(F.current_timestamp()).alias("__ms"))
    named = named.withWatermark("__now", f"{int(hold.total_seconds())} seconds")        # a batch's time: no row is ever late
    run = _follow([f.name for f in fields], by, date)
    changes = (named.groupBy(*[f"__k{n}" for n in range(len(by))], "__month")
               .applyInPandasWithState(run, CHANGE, STATE, "update", "EventTimeTimeout"))
    log = changes.select(*[_value(F.get("__row", F.lit(n)), f.dataType).alias(f.name) for n, f in enumerate(fields)], *VERSION, "__touch")

    def append(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes_path(silver, interface)}/batch={number}")

    q = (log.writeStream.outputMode("update").foreachBatch(append).option("checkpointLocation", f"{checkpoint.rstrip('/')}/{interface}")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def changes_path(silver: str, interface: str) -> str:
    return f"{silver.rstrip('/')}/interface={interface}"


def read_changes(spark: SparkSession, silver: str, interface: str, keys: Sequence[str] | None = None,
                 date: str = "effective_date") -> DataFrame:
    """Silver of a streamed interface: the last row per key and day of its log.
    ``keys`` as in :func:`stream_changes`."""
    return latest(spark.read.parquet(changes_path(silver, interface)).drop("batch"), keys, date)


def stream_landed(spark: SparkSession, landing: str, silver: str, checkpoint: str, schemas: Mapping[tuple[str, str], T.StructType],
                  keys: Mapping[str, Sequence[str]] | None = None, **options) -> None:
    """T-S1 over several interfaces: ``schemas`` by (source domain, interface)."""
    for (domain, interface), schema in schemas.items():
        stream_changes(spark, landing, domain, interface, silver, checkpoint, schema, (keys or {}).get(interface), **options)
