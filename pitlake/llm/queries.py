"""Registered queries of the operators of this subpackage."""

from __future__ import annotations

from pitlake.llm import alignment, bpe, ctw, exact_dedup, minhash, mixing, pii, quality, sharding, simhash, spelling, substring, topk
from pitlake.llm.common import load


def _over(table, query):
    return lambda spark, sf_dir: query(spark, load(spark, sf_dir, table))


QUERIES = {
    "op1_substring_dedup": _over("documents", substring.substring_query),
    "op2_sharding": _over("documents", sharding.sharding_query),
    "op3_ctw": _over("documents", ctw.ctw_query),
    "op4_pii": _over("documents", pii.pii_query),
    "op5_topk_search": _over("embeddings", topk.topk_query),
    "op6_mixing": lambda spark, sf_dir: mixing.mixing_query(spark, load(spark, sf_dir, "documents"), sf_dir),
    "op7_quality_fm": lambda spark, sf_dir: quality.quality_query(spark, load(spark, sf_dir, "documents"), sf_dir),
    "op8_bpe": _over("documents", bpe.bpe_query),
    "op9_minhash_dedup": _over("documents", minhash.near_dedup_query),
    "op10_exact_dedup": _over("documents", exact_dedup.exact_dedup_query),
    "op11_simhash_dedup": _over("documents", simhash.simhash_query),
    "op12_spelling_variants": _over("documents", spelling.spelling_query),
    "op13_token_alignment": _over("documents", alignment.alignment_query),
}

SQL = {"op10_exact_dedup": exact_dedup.SQL, "op5_topk_search": topk.SQL}
