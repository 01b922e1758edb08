"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from plenum.llm.exact_dedup import OP1_SQL, op1_exact_dedup
from plenum.llm.language_model import op6_language_model
from plenum.llm.mixing import OP4_SQL, op4_mix
from plenum.llm.near_dedup import OP10_SQL, op10_near_dedup
from plenum.llm.personal_data import op5_personal_data
from plenum.llm.quality_rules import OP7_SQL, op7_quality_rules
from plenum.llm.sentence_pieces import op3_sentence_pieces
from plenum.llm.sharding import op8_shard
from plenum.llm.token_alignment import op12_align_tokens
from plenum.llm.token_files import op11_token_files
from plenum.llm.toxicity import op9_toxicity
from plenum.llm.vector_codes import OP13_SQL, op13_vector_codes
from plenum.llm.warc import OP2_SQL, op2_warc

QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_warc": op2_warc,
    "op3_sentence_pieces": op3_sentence_pieces,
    "op4_mix": op4_mix,
    "op5_personal_data": op5_personal_data,
    "op6_language_model": op6_language_model,
    "op7_quality_rules": op7_quality_rules,
    "op8_shard": op8_shard,
    "op9_toxicity": op9_toxicity,
    "op10_near_dedup": op10_near_dedup,
    "op11_token_files": op11_token_files,
    "op12_align_tokens": op12_align_tokens,
    "op13_vector_codes": op13_vector_codes,
}

#: DuckDB SQL where the contract's rows can be said in SQL.
ORACLES = {
    "op1_exact_dedup": OP1_SQL,
    "op2_warc": OP2_SQL,
    "op4_mix": OP4_SQL,
    "op7_quality_rules": OP7_SQL,
    "op10_near_dedup": OP10_SQL,
    "op13_vector_codes": OP13_SQL,
}
