"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline

from . import (chat_format, decontaminate, jaccard_join, line_dedup, mixing, packing, quality_classifier, quality_rules,
               sharding, suffix_dedup, token_alignment, token_files, vector_codes)

QUERIES = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_token_files": token_files.op2_token_files,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_jaccard_join": jaccard_join.op4_jaccard_join,
    "op4_jaccard_links": jaccard_join.op4_jaccard_links,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_quality_classifier": quality_classifier.op7_quality_classifier,
    "op8_chat_formatting": chat_format.op8_chat_formatting,
    "op9_sharding": sharding.op9_sharding,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_token_alignment": token_alignment.op12_token_alignment,
    "op13_mixing": mixing.op13_mixing,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op1_decontamination": decontaminate.ORACLE_SQL,
    "op4_jaccard_join": jaccard_join.ORACLE_SQL,
    "op4_jaccard_links": jaccard_join.LINKS_SQL,
    "op5_line_dedup": line_dedup.ORACLE_SQL,
    "op8_chat_formatting": chat_format.ORACLE_SQL,
    "op11_vector_codes": vector_codes.ORACLE_SQL,
}
