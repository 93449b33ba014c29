"""The queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from docketlake.llm import (
    byte_bpe,
    centroid_clusters,
    exact_dedup,
    jaccard_join,
    mixing,
    page_text,
    periodic_runs,
    quality,
    quality_rules,
    substring_dedup,
    toxicity,
    url_filter,
    warc_revisits,
)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_ngram_jaccard_join": jaccard_join.op2_ngram_jaccard_join,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_source_mixing": mixing.op6_source_mixing,
    "op7_byte_bpe": byte_bpe.op7_byte_bpe,
    "op8_quality_classifier": quality.op8_quality_classifier,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_warc_revisits": warc_revisits.op10_warc_revisits,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_centroid_clusters": centroid_clusters.op12_centroid_clusters,
    "op13_page_text": page_text.op13_page_text,
}

ORACLE_SQL = {
    "op1_exact_dedup": exact_dedup.OP1_SQL,
    "op2_ngram_jaccard_join": jaccard_join.OP2_SQL,
    "op3_url_filter": url_filter.OP3_SQL,
    "op4_quality_rules": quality_rules.OP4_SQL,
    "op9_substring_dedup": substring_dedup.OP9_SQL,
    "op10_warc_revisits": warc_revisits.OP10_SQL,
    "op12_centroid_clusters": centroid_clusters.OP12_SQL,
}
