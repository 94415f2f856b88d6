"""Exports F3-F7: pre-training text (CPT), instruction records (SFT), preview (TXT).

Every record is built by column expressions (``concat``/``format_string``),
so export is a map-only stage: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.functions.scalar import date_text, feature_text, target_text

# --- fixed values: feature names and order of the text block ---
FEATURE_NAMES = ("open", "high", "low", "close", "volume", "amount", "turnover", "adj_close_hfq",
                 "is_member", "is_suspended")

# --- fixed values: instruction of the SFT record ({h} = horizon in days) ---
SFT_INSTRUCTION = ("Based on the provided market data for a stock on a given day, predict the future "
                   "return in basis points (bps) for the next {h} trading day(s).")

PRICE_IFACE = "stock_zh_a_hist"


def default_feature_map(columns: Sequence[str], iface: str = PRICE_IFACE) -> dict[str, str]:
    """Map each fixed feature name to its gold column: ``feat_<name>_<iface>``
    if present, else the bare name if present (T7)."""
    out = {}
    for n in FEATURE_NAMES:
        for cand in (f"feat_{n}_{iface}", n):
            if cand in columns:
                out[n] = cand
                break
    return out


def _features(gold: DataFrame, feature_map: Mapping[str, str] | None) -> Column:
    fmap = dict(feature_map) if feature_map is not None else default_feature_map(gold.columns)
    feats = [(n, F.col(fmap[n]), gold.schema[fmap[n]].dataType) for n in FEATURE_NAMES if n in fmap]
    feats += [(n, F.col(c), gold.schema[c].dataType) for n, c in fmap.items() if n not in FEATURE_NAMES]
    return feature_text(feats)


def _parts(gold, h, feature_map, key, date, date_with_time):
    return (F.col(key).cast("string"), date_text(F.col(date), date_with_time), _features(gold, feature_map),
            target_text(F.col(f"r_{h}d"), F.col(f"label_na_{h}d")))


def to_cpt(gold: DataFrame, h: int = 1, feature_map: Mapping[str, str] | None = None,
           key: str = "ticker", date: str = "date", date_with_time: bool = True) -> DataFrame:
    """one ``text`` column per gold row."""
    t, d, feats, out = _parts(gold, h, feature_map, key, date, date_with_time)
    text = F.concat(F.lit("TICKER="), t, F.lit("\nDATE="), d, F.lit("\nFEATURES:\n"), feats,
                    F.lit(f"\nTARGET_RETURN_BPS_NEXT_{h}D:\n"), out)
    return gold.select(text.alias("text"))


def to_sft(gold: DataFrame, h: int = 1, feature_map: Mapping[str, str] | None = None,
           key: str = "ticker", date: str = "date", date_with_time: bool = True) -> DataFrame:
    """``Instruction``, ``Input``, ``Output`` per gold row."""
    t, d, feats, out = _parts(gold, h, feature_map, key, date, date_with_time)
    inp = F.concat(F.lit("TICKER="), t, F.lit("\nDATE="), d, F.lit("\nFEATURES:\n"), feats)
    return gold.select(F.lit(SFT_INSTRUCTION.format(h=h)).alias("Instruction"), inp.alias("Input"),
                       out.alias("Output"))


def to_txt(gold: DataFrame, h: int = 1, feature_map: Mapping[str, str] | None = None,
           key: str = "ticker", date: str = "date", date_with_time: bool = True) -> DataFrame:
    """readable block (the sink appends the ``\\n---\\n\\n`` separator)."""
    t, d, feats, out = _parts(gold, h, feature_map, key, date, date_with_time)
    text = F.concat(F.lit("TICKER="), t, F.lit("\nDATE="), d, F.lit("\n\nFEATURES:\n"), feats,
                    F.lit(f"\n\nTARGET_RETURN_BPS_NEXT_{h}D:\n"), out, F.lit("\n"))
    return gold.select(text.alias("text"))
