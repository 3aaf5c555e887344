"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from skyflow.llm import alignment, conversation_trie, decontaminate, exact_dedup, html_extract, jaccard_join, line_dedup, packing, quality, secret_scan, tokens, toxicity, url_filter


def queries() -> dict:
    return {
        "op1_token_counts": tokens.query,
        "op2_packing": packing.query,
        "op3_exact_dedup": exact_dedup.query,
        "op4_html_extract": html_extract.query,
        "op5_quality": quality.query,
        "op6_decontaminate": decontaminate.query,
        "op7_jaccard_join": jaccard_join.query,
        "op8_toxicity": toxicity.query,
        "op9_url_filter": url_filter.query,
        "op10_line_dedup": line_dedup.query,
        "op11_conversation_trie": conversation_trie.query,
        "op12_secret_scan": secret_scan.query,
        "op13_alignment": alignment.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_exact_dedup": exact_dedup.ORACLE,
        "op6_decontaminate": decontaminate.ORACLE,
        "op7_jaccard_join": jaccard_join.ORACLE,
        "op9_url_filter": url_filter.ORACLE,
        "op10_line_dedup": line_dedup.ORACLE,
        "op11_conversation_trie": conversation_trie.ORACLE,
    }
