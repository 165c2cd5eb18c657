"""Queries of this package and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from rosterloom.llm import alignment, archives, credentials, decontaminate, divergence, html_text, licenses, lines, packing, quality, sentencepieces, simhash, substrings

QUERIES = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op10_license_scan": licenses.op10_license_scan,
    "op11_sentencepiece": sentencepieces.op11_sentencepiece,
    "op12_alignment": alignment.op12_alignment,
    "op13_divergence": divergence.op13_divergence,
    "op2_secret_links": credentials.op2_secret_links,
    "op3_warc": archives.op3_warc,
    "op4_simhash": simhash.op4_simhash,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_html_text": html_text.op6_html_text,
    "op7_packing": packing.op7_packing,
    "op8_line_dedup": lines.op8_line_dedup,
    "op9_substrings": substrings.op9_substrings,
}

ORACLES = {
    "op1_decontamination": decontaminate.OP1_SQL,
    "op13_divergence": divergence.OP13_SQL,
    "op3_warc": archives.OP3_SQL,
    "op8_line_dedup": lines.OP8_SQL,
    "op9_substrings": substrings.OP9_SQL,
}
