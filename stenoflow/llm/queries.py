"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from stenoflow.llm import decontaminate, html_text, jaccard_join, language_id, merkle, mixing, quality, runs, secrets, sharding, token_counts, topk_search, toxicity

QUERIES = {
    "op1_secrets": secrets.op1_secrets,
    "op2_decontamination": decontaminate.op2_decontamination,
    "op3_language_id": language_id.op3_language_id,
    "op4_mixing": mixing.op4_mixing,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_topk_search": topk_search.op6_topk_search,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op9_html_text": html_text.op9_html_text,
    "op10_quality": quality.op10_quality,
    "op11_merkle": merkle.op11_merkle,
    "op12_runs": runs.op12_runs,
    "op13_sharding": sharding.op13_sharding,
}

ORACLE_SQL: dict[str, str] = {
    "op1_secrets": secrets.OP1_SQL, "op4_mixing": mixing.OP4_SQL, "op6_topk_search": topk_search.OP6_SQL, "op8_jaccard_join": jaccard_join.OP8_SQL,
    "op11_merkle": merkle.OP11_SQL, "op12_runs": runs.OP12_SQL,
}
