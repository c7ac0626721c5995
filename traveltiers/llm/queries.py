"""Queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from traveltiers.llm import (bpe_transducer, host_rules, html_cut, jaccard_join, line_dedup, period_runs, piece_counts, rans_ids, template_leaks,
                             token_align, toxicity, url_cascade, weak_labels)

QUERIES = {
    "op1_host_rules": host_rules.query,
    "op2_url_cascade": url_cascade.query,
    "op3_html_cut": html_cut.query,
    "op4_piece_counts": piece_counts.query,
    "op5_template_leaks": template_leaks.query,
    "op6_toxicity": toxicity.query,
    "op7_bpe_transducer": bpe_transducer.query,
    "op8_rans_ids": rans_ids.query,
    "op9_weak_labels": weak_labels.query,
    "op10_jaccard_join": jaccard_join.query,
    "op11_period_runs": period_runs.query,
    "op12_token_align": token_align.query,
    "op13_line_dedup": line_dedup.query,
}

ORACLE_SQL = {
    "op1_host_rules": host_rules.ORACLE_SQL,
    "op2_url_cascade": url_cascade.ORACLE_SQL,
    "op10_jaccard_join": jaccard_join.ORACLE_SQL,
    "op13_line_dedup": line_dedup.ORACLE_SQL,
}
