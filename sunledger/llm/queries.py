"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from sunledger.llm import (
    collocations,
    exact_dedup,
    knn,
    language_id,
    lexical,
    mixing,
    packing,
    quality,
    secrets,
    simhash,
    token_counts,
    toxicity,
    url_filter,
)

QUERIES = {
    "op1_toxicity": toxicity.query,
    "op2_quality": quality.query,
    "op3_packing": packing.query,
    "op4_exact_dedup": exact_dedup.query,
    "op5_mixing": mixing.query,
    "op6_url_filter": url_filter.query,
    "op7_knn": knn.query,
    "op8_language_id": language_id.query,
    "op9_secrets": secrets.query,
    "op10_simhash": simhash.query,
    "op11_collocations": collocations.query,
    "op12_token_counts": token_counts.query,
    "op13_lexical_search": lexical.query,
}

ORACLES = {
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op7_knn": knn.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op13_lexical_search": lexical.ORACLE,
}
