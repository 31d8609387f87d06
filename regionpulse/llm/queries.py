"""Every query of the subpackage by name, and the SQL each is compared to."""

from __future__ import annotations

from regionpulse.llm import (
    bpe, decontamination, divergence, language, line_chunks, near_duplicates, pivots, sharding, substrings, token_counts, toxicity, warc, whitening,
)

QUERIES = {
    "op1_sharding": sharding.query,
    "op2_warc": warc.query,
    "op3_decontamination": decontamination.query,
    "op4_line_dedup": line_chunks.query,
    "op4_passages": line_chunks.passage_query,
    "op5_toxicity": toxicity.query,
    "op6_substring_dedup": substrings.query,
    "op7_bpe": bpe.query,
    "op8_near_duplicates": near_duplicates.query,
    "op9_pivots": pivots.query,
    "op10_language": language.query,
    "op11_token_counts": token_counts.query,
    "op12_divergence": divergence.query,
    "op13_whitening": whitening.query,
}

ORACLES = {
    "op2_warc": warc.ORACLE,
    "op4_line_dedup": line_chunks.ORACLE,
    "op6_substring_dedup": substrings.ORACLE,
    "op8_near_duplicates": near_duplicates.ORACLE,
    "op9_pivots": pivots.ORACLE,
    "op12_divergence": divergence.ORACLE,
}
