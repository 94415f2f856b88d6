"""Several landed sources in one run: landing table -> silver per interface -> one gold table.

Every interface found in the landing table is read once (its own partitions
only), normalised by its registered columns, written as silver, and joined by
its registered frequency and availability rule.  Each stage reads the tables
the one before has written.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pitlake.functions.scalar import with_date
from pitlake.operators.audit import accounting
from pitlake.operators.calendar import AVAIL_COLUMN_RULES
from pitlake.operators.grid import base_grid
from pitlake.operators.labels import forward_labels
from pitlake.operators.normalise import normalise_source
from pitlake.operators.panel import assemble
from pitlake.plans.pipeline import PRICE, deliver
from pitlake.sources.registry import EQUI_FREQS, KEY_COLUMNS, avail_rule_of, freq_of, scope_of
from pitlake.sources.sinks import read_silver, shuffles_freed, write_gold, write_silver, write_stats

log = logging.getLogger(__name__)

# the rows of an as-of source's key are first reduced to one a day if they are more than this and than a thousandth of the source's
HOT_ROWS, HOT_KEYS = 500_000, 1000

# rows of the landing table a silver bucket
BUCKET_ROWS, LEAST_BUCKETS, MOST_BUCKETS = 500_000, 16, 20_000

# landing columns that describe the fetch, not the data
FETCH_COLUMNS = ("source_domain", "interface", "task", "task_id", "scope")
PERIOD = "report_period"


def landed_interfaces(spark: SparkSession, landing: str) -> list[tuple[str, str]]:
    """(source domain, interface) pairs of the landing table, by its partition
    columns alone; unregistered ones are logged and left out."""
    found = spark.read.parquet(landing).select("source_domain", "interface").distinct().collect()   # a few dozen
    for r in found:
        if r.interface not in KEY_COLUMNS:
            log.warning("no registry entry for landed %r; skipped", r.interface)
    return sorted((r.source_domain, r.interface) for r in found if r.interface in KEY_COLUMNS)


def read_landed(spark: SparkSession, landing: str, domain: str, interface: str) -> DataFrame:
    """One interface's landed rows; tasks may lack columns that others have."""
    base = landing.rstrip("/")
    return (spark.read.option("basePath", base).option("mergeSchema", True)
            .parquet(f"{base}/source_domain={domain}/interface={interface}"))


def landed_silver(raw: DataFrame, interface: str) -> DataFrame:
    """Landed rows of one interface -> silver: standard names, ``ticker``,
    ``effective_date``.

    The ticker is that of the source's own code column; only where there is none
    do fetches of a single stock give their rows the task's.  A source
    without a date column is dated by its fetch.  A source fetched by report
    date keeps that date as ``report_period``: its rows speak of that period
    and may be restated later.
    """
    scope = scope_of(interface)
    out = raw.drop(*FETCH_COLUMNS).withColumnRenamed("date", "fetch_date").withColumnRenamed("data_date", "date")
    if not scope.startswith("single_stock") or KEY_COLUMNS[interface][0] in out.columns:
        out = out.drop("ticker")
    if scope.endswith("by_report_date"):
        out = with_date(out, PERIOD, "fetch_date")
    return normalise_source(out, interface, fetch_date="fetch_date").drop("fetch_date")


def registered_rules(interfaces: Sequence[str]) -> dict:
    """Registered availability rules; those that name a column use the source's own date."""
    rules = {i: avail_rule_of(i) for i in interfaces}
    return {i: (r, "date") if r in AVAIL_COLUMN_RULES else r for i, r in rules.items()}


def write_landed_silver(spark: SparkSession, landing: str, silver: str, buckets: int | None = None) -> dict[str, dict]:
    """Landing -> one silver dataset per interface.  Returns each interface's
    counts of rows, and of rows without key and without date (A8, counted by
    the write itself)."""
    with shuffles_freed(spark):
        return {i: _write_interface(spark, landing, silver, domain, i, buckets) for domain, i in landed_interfaces(spark, landing)}


def _write_interface(spark: SparkSession, landing: str, silver: str, domain: str, interface: str, buckets: int | None) -> dict:
    out = landed_silver(read_landed(spark, landing, domain, interface), interface)
    counted, rows = accounting(out, f"{interface} rows")
    holes = [F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in ("ticker", "effective_date") if c in out.columns]
    missing = Observation(f"{interface} holes") if holes else None
    if missing:
        counted = counted.observe(missing, *holes)
    write_silver(counted, silver, interface, buckets=buckets, date="effective_date")
    return {**rows.get, **(missing.get if missing else {})}


def buckets_for(spark: SparkSession, landing: str) -> int:
    """Buckets that silver of this landing table needs to be read, sorted and joined bucket by bucket (rows by the files' footers)."""
    rows = spark.read.parquet(landing).count()
    return min(max(math.ceil(rows / BUCKET_ROWS), LEAST_BUCKETS), MOST_BUCKETS)


def crowded_keys(src: DataFrame, key: str = "ticker") -> list:
    """Keys of ``src`` that hold more than HOT_ROWS of its rows, HOT_KEYS at most; the rows without a key count as one."""
    rows = src.count()
    if rows <= HOT_ROWS:
        return []
    counts = src.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return [r[key] for r in counts.where(F.col("n") > max(HOT_ROWS, rows // HOT_KEYS)).collect()]


def landed_panel(spark: SparkSession, silver: str, interfaces: Sequence[str], grid: DataFrame, calendar: DataFrame,
                 avail: Mapping | str | None = "registry", tie_breaks: Mapping[str, Sequence[str]] | None = None,
                 counted: dict | None = None, universe: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """Silver of ``interfaces`` on the grid, each by its frequency and availability rule (J10);
    with the ``universe`` of a whole grid by spans of days (see :func:`assemble`), the rows of every source shuffled
    once, or not again if silver was written in ``buckets``."""
    sources = [(i, read_silver(spark, silver, i)) for i in interfaces]
    periods = {i: PERIOD for i, df in sources if PERIOD in df.columns}
    rules = registered_rules(interfaces) if avail == "registry" else avail
    hot = None
    if universe is not None:
        with shuffles_freed(spark):
            crowds = {i: crowded_keys(df) for i, df in sources if "ticker" in df.columns and freq_of(i) not in EQUI_FREQS}
        hot = {i: (keys, read_silver(spark, silver, i, bucketed=False)) for i, keys in crowds.items() if keys}
    return assemble(grid, sources, calendar=calendar, avail=rules, periods=periods, tie_breaks=tie_breaks, counted=counted,
                    universe=universe, hot=hot, parts=buckets)


def account(spark: SparkSession, silver: Mapping[str, Mapping], panel: Mapping, features: int) -> DataFrame:
    """A8 over all stages, one row a source: silver rows and those without key
    or date, panel rows before and after its equi join (null for as-of
    sources), and whether it fanned out; the last row is the whole table."""
    rows, before = [], panel["grid"].get["rows"]
    grid = before
    for i, c in silver.items():
        after = panel[i].get["rows"] if i in panel else None
        rows.append((i, c["rows"], c.get("no_ticker"), c.get("no_effective_date"), None if after is None else before, after,
                     after is not None and after > before))
        before = after if after is not None else before
    rows.append(("gold features", None, None, None, grid, features, features > grid))
    return spark.createDataFrame(rows, "source string, silver_rows bigint, no_key bigint, no_date bigint, rows_before bigint, "
                                       "rows_after bigint, fans_out boolean")


def run_landed(spark: SparkSession, landing: str, universe: DataFrame, calendar: DataFrame, out_dir: str, lo=None, hi=None,
               avail: Mapping | str | None = "registry", tie_breaks: Mapping[str, Sequence[str]] | None = None,
               buckets: int | None = None, price: str = PRICE, price_col: str = "adj_close_hfq", horizons=(1, 5, 20),
               suffix: str = "landed", name: str = "dataset") -> dict:
    """All landed sources to gold, exports and reports; the reports of
    :func:`pitlake.plans.pipeline.run`, and ``accounting`` over all stages."""
    silver = f"{out_dir}/silver"
    counts = write_landed_silver(spark, landing, silver, buckets)
    panel: dict = {}
    features = landed_panel(spark, silver, list(counts), base_grid(universe, calendar, lo, hi), calendar, avail, tie_breaks, panel)
    counted, total = accounting(features, "features")
    # written as it comes: ordering by range would run the plan a second time, and the counters with it
    feat_path = write_gold(counted, f"{out_dir}/gold", "features", sort_keys=())
    prices = read_silver(spark, silver, price).select("ticker", F.col("effective_date").alias("date"), price_col)
    # one label row per grid cell, whatever the sources fan out to
    labels = forward_labels(base_grid(universe, calendar, lo, hi), prices, calendar, price_col, horizons=horizons)
    lab_path = write_gold(labels, f"{out_dir}/gold", "labels")
    rows = account(spark, counts, panel, total.get["rows"])
    write_stats(rows, f"{out_dir}/exports/stats/accounting_{suffix}.csv")
    return {**deliver(spark, feat_path, lab_path, out_dir, suffix, name), "accounting": rows}
