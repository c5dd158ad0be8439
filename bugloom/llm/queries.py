"""The queries that the entry module registers for this subpackage."""

from __future__ import annotations

from . import collocations, gam_quality, gbt_quality, html_template, icws, line_spread, packing, phrase_automata, qgram_decon, suffix_dedup, top_products, warc_revisit

QUERIES = {
    "op1_quality_rules": gbt_quality.op1_quality_rules,
    "op2_warc_revisit": warc_revisit.op2_warc_revisit,
    "op3_vector_packing": packing.op3_vector_packing,
    "op4_suffix_dedup": suffix_dedup.op4_suffix_dedup,
    "op5_html_template": html_template.op5_html_template,
    "op6_quality_classifier": gam_quality.op6_quality_classifier,
    "op7_phrase_automata": phrase_automata.op7_phrase_automata,
    "op8_qgram_decontamination": qgram_decon.op8_qgram_decontamination,
    "op9_line_spread": line_spread.op9_line_spread,
    "op10_near_duplicates": icws.op10_near_duplicates,
    "op11_phrase_collocations": collocations.op11_phrase_collocations,
    "op12_top_products": top_products.op12_top_products,
}

#: No entry where SQL can't express the operator; tests/llm compares those with brute force.
ORACLE_SQL: dict[str, str] = {"op2_warc_revisit": warc_revisit.OP2_SQL, "op9_line_spread": line_spread.OP9_SQL, "op11_phrase_collocations": collocations.OP11_SQL, "op12_top_products": top_products.OP12_SQL}
