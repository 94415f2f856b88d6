"""End-to-end replay: raw price files -> silver -> gold -> exports + audit.

``build`` gives the lazy stage DataFrames; ``run`` writes each stage and
feeds the next stage from the written table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.functions.scalar import first_matching
from pitlake.operators.audit import accounting, label_na_report, lookahead_audit, stats_summary
from pitlake.operators.calendar import enrich_calendar
from pitlake.operators.export import to_cpt, to_sft, to_txt
from pitlake.operators.grid import base_grid
from pitlake.operators.joins import gold as join_gold
from pitlake.operators.labels import forward_labels
from pitlake.operators.normalise import normalise
from pitlake.operators.panel import assemble
from pitlake.sources.files import read_prices, read_universe, read_window, window_bounds
from pitlake.sources.registry import COLUMNS_MAP
from pitlake.sources.sinks import read_silver, write_gold, write_jsonl, write_silver, write_stats, write_txt

PRICE = "stock_zh_a_hist"
CALENDAR = "tool_trade_date_hist_sina"


@dataclass
class Replay:
    silver_prices: DataFrame
    calendar: DataFrame
    features: DataFrame
    labels: DataFrame
    gold: DataFrame


def silver_prices(spark: SparkSession, prices_path: str) -> DataFrame:
    """Raw price files -> silver (standard names, ``effective_date``, ticker)."""
    return normalise(read_prices(spark, prices_path), COLUMNS_MAP[PRICE])


def build(spark: SparkSession, prices_path: str, universe_path: str, window_path: str | None,
          calendar: DataFrame | None = None, horizons=(1, 5, 20), silver: DataFrame | None = None,
          avail=None) -> Replay:
    """Silver prices, trading calendar (the price dates when none is given,
    T8), gold features over the window, labels over the full history, gold.
    ``silver`` replaces the raw read with an already written silver table."""
    if silver is None:
        silver = silver_prices(spark, prices_path)
    if calendar is None:
        calendar = silver.select(F.col("effective_date").alias("date")).distinct()
    cal = enrich_calendar(calendar)                               # W3 columns
    lo, hi = window_bounds(read_window(spark, window_path))
    grid = base_grid(read_universe(spark, universe_path), calendar, lo, hi)
    features = assemble(grid, [(PRICE, silver), (CALENDAR, cal)], calendar=calendar, avail=avail)
    px_col = first_matching(features.columns, "adj_close_hfq")
    prices = silver.select("ticker", F.col("effective_date").alias("date"), "adj_close_hfq")
    labels = forward_labels(features.select("ticker", "date", px_col), prices, calendar, "adj_close_hfq",
                            horizons=horizons, base_col=px_col)
    return Replay(silver, calendar, features, labels, join_gold(features, labels))


def run(spark: SparkSession, prices_path: str, universe_path: str, window_path: str | None,
        out_dir: str, suffix: str = "smoke", calendar: DataFrame | None = None,
        buckets: int | None = None, name: str = "dataset", avail=None) -> dict:
    """Build, write every stage and the reports; return the report frames.

    Each stage reads the previous stage's written table, never its lineage:
    gold is joined from the written features and labels (J6), written once,
    and both exports and the audit read that table.  Nothing is computed
    twice, and a lost executor costs a task retry, not a recomputation of
    upstream stages.  ``buckets`` stores silver bucketed by ticker, so the
    entity windows of gold read it without a shuffle.  ``avail`` gives the
    sources' availability rules, as in :func:`assemble`.
    """
    write_silver(silver_prices(spark, prices_path), f"{out_dir}/silver", PRICE, buckets=buckets)
    silver = read_silver(spark, f"{out_dir}/silver", PRICE)
    r = build(spark, prices_path, universe_path, window_path, calendar, silver=silver, avail=avail)
    feat_path = write_gold(r.features, f"{out_dir}/gold", "features")
    lab_path = write_gold(r.labels, f"{out_dir}/gold", "labels")
    return deliver(spark, feat_path, lab_path, out_dir, suffix, name)


def deliver(spark: SparkSession, feat_path: str, lab_path: str, out_dir: str, suffix: str = "smoke", name: str = "dataset") -> dict:
    """Written features and labels -> gold, exports and reports."""
    gold_df = join_gold(spark.read.parquet(feat_path), spark.read.parquet(lab_path))
    g = spark.read.parquet(write_gold(gold_df, f"{out_dir}/gold", "gold"))
    counted, obs = accounting(g, "gold")                    # A8: counted by the first export, no extra job
    write_jsonl(to_cpt(counted), f"{out_dir}/exports/cpt/{name}_cpt_{suffix}.jsonl")
    write_jsonl(to_sft(g), f"{out_dir}/exports/sft/{name}_sft_{suffix}.jsonl")
    write_txt(to_txt(g), f"{out_dir}/exports/txt/{name}_{suffix}_preview.txt")
    summary = stats_summary(g, reuse=False)      # g is a written table
    na = label_na_report(g)
    look = lookahead_audit(g)
    write_stats(summary, f"{out_dir}/exports/stats/stats_summary_{suffix}.csv")
    write_stats(na, f"{out_dir}/exports/stats/stats_label_na_{suffix}.csv")
    return {"stats_summary": summary, "label_na": na, "lookahead": look,
            "gold_shape": (obs.get["rows"], len(g.columns))}
