"""The operators' queries over their whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from tapeflow.llm.attention import op2_lm_scoring
from tapeflow.llm.chat import OP1_SQL, op1_chat_formatting
from tapeflow.llm.decontaminate import OP3_SQL, op3_benchmark_decontamination
from tapeflow.llm.extract import op10_html_extraction
from tapeflow.llm.jaccard import OP8_SQL, op8_jaccard_join
from tapeflow.llm.langid import op13_language_id
from tapeflow.llm.lines import op4_line_dedup
from tapeflow.llm.merkle import OP12_SQL, op12_merkle_manifest
from tapeflow.llm.mixing import op7_mixing
from tapeflow.llm.negatives import OP11_SQL, op11_hard_negatives
from tapeflow.llm.quality import op5_quality_rules
from tapeflow.llm.urls import OP9_SQL, op9_url_filters
from tapeflow.llm.warc import OP6_SQL, op6_warc

QUERIES = {
    query.__name__: query
    for query in (
        op1_chat_formatting,
        op2_lm_scoring,
        op3_benchmark_decontamination,
        op4_line_dedup,
        op5_quality_rules,
        op6_warc,
        op7_mixing,
        op8_jaccard_join,
        op9_url_filters,
        op10_html_extraction,
        op11_hard_negatives,
        op12_merkle_manifest,
        op13_language_id,
    )
}

ORACLES = {
    "op1_chat_formatting": OP1_SQL,
    "op3_benchmark_decontamination": OP3_SQL,
    "op6_warc": OP6_SQL,
    "op8_jaccard_join": OP8_SQL,
    "op9_url_filters": OP9_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
