"""The registered queries of this subpackage, and the SQL that checks those SQL can express."""

from __future__ import annotations

from corpus_pipeline import run as pipeline
from tallymark.llm.alignment import op13_alignment
from tallymark.llm.decontamination import OP1_SQL, op1_decontamination
from tallymark.llm.exact_dedup import OP2_SQL, op2_exact_dedup
from tallymark.llm.filter_audit import OP12_SQL, op12_filter_audit
from tallymark.llm.html_text import op7_html_text
from tallymark.llm.metric_join import OP11_SQL, op11_metric_join
from tallymark.llm.mixing import op10_mixing
from tallymark.llm.near_dedup import OP9_SQL, op9_near_dedup
from tallymark.llm.pii import op5_pii
from tallymark.llm.quality import op3_quality
from tallymark.llm.substring_dedup import op4_substring_dedup
from tallymark.llm.tokens import op8_token_ids
from tallymark.llm.toxicity import op6_toxicity

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality": op3_quality,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_pii": op5_pii,
    "op6_toxicity": op6_toxicity,
    "op7_html_text": op7_html_text,
    "op8_token_ids": op8_token_ids,
    "op9_near_dedup": op9_near_dedup,
    "op10_mixing": op10_mixing,
    "op11_metric_join": op11_metric_join,
    "op12_filter_audit": op12_filter_audit,
    "op13_alignment": op13_alignment,
    "pipeline": pipeline,
}
ORACLES = {
    "op1_decontamination": OP1_SQL,
    "op2_exact_dedup": OP2_SQL,
    "op9_near_dedup": OP9_SQL,
    "op11_metric_join": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
}
