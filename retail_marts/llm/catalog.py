"""The subpackage's queries, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from retail_marts.llm.bm25_decontam import op7_bm25_decontam
from retail_marts.llm.chat_events import OP10_SQL, op10_chat_events
from retail_marts.llm.cnn_toxicity import op2_cnn_toxicity
from retail_marts.llm.feistel_pii import op9_feistel_pii
from retail_marts.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from retail_marts.llm.language_mixture import op3_language_mixture
from retail_marts.llm.maxent_lm import op6_maxent_lm
from retail_marts.llm.poisson_mix import OP4_SQL, op4_poisson_mix
from retail_marts.llm.probminhash import op5_probminhash_neardup
from retail_marts.llm.pu_quality import op8_pu_quality
from retail_marts.llm.recompression import OP11_SQL, op11_recompression
from retail_marts.llm.va_file import OP1_SQL, op1_va_file
from retail_marts.llm.whitening import op12_qd_whitening

QUERIES = {
    "op1_va_file": op1_va_file,
    "op2_cnn_toxicity": op2_cnn_toxicity,
    "op3_language_mixture": op3_language_mixture,
    "op4_poisson_mix": op4_poisson_mix,
    "op5_probminhash_neardup": op5_probminhash_neardup,
    "op6_maxent_lm": op6_maxent_lm,
    "op7_bm25_decontam": op7_bm25_decontam,
    "op8_pu_quality": op8_pu_quality,
    "op9_feistel_pii": op9_feistel_pii,
    "op10_chat_events": op10_chat_events,
    "op11_recompression": op11_recompression,
    "op12_qd_whitening": op12_qd_whitening,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op1_va_file": OP1_SQL,
    "op4_poisson_mix": OP4_SQL,
    "op10_chat_events": OP10_SQL,
    "op11_recompression": OP11_SQL,
    "op13_hard_negatives": OP13_SQL,
}
