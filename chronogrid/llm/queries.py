"""The queries of this subpackage and, where SQL can state them, their SQL."""

from __future__ import annotations

from . import ann, byte_bpe, exact_dedup, language_id, lm_score, near_dedup, packing, quality, suffix_dedup, toxicity

QUERIES = {"op1_lm_score": lm_score.op1_lm_score, "op2_ann": ann.op2_ann, "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup, "op4_exact_dedup": exact_dedup.op4_exact_dedup, "op5_toxicity": toxicity.op5_toxicity, "op6_byte_bpe": byte_bpe.op6_byte_bpe, "op7_near_dedup": near_dedup.op7_near_dedup, "op8_quality": quality.op8_quality, "op9_packing": packing.op9_packing, "op10_language_id": language_id.op10_language_id}
SQL = {"op2_ann": ann.SQL_OP2, "op4_exact_dedup": exact_dedup.SQL_OP4}
