"""Queries of the operators and their SQL."""

from __future__ import annotations

from tidemark.llm.dedup import OP2_SQL, op2_exact_dedup
from tidemark.llm.infill import OP13_SQL, op13_infill
from tidemark.llm.language_model import op5_lm_scoring
from tidemark.llm.licenses import OP12_SQL, op12_licenses
from tidemark.llm.mixing import OP9_SQL, op9_mixing
from tidemark.llm.packing import op6_packing
from tidemark.llm.periods import op11_period_runs
from tidemark.llm.pivots import op4_embedding_dedup
from tidemark.llm.quality import op7_line_quality
from tidemark.llm.sharding import op1_sharding
from tidemark.llm.simhash import op8_simhash
from tidemark.llm.token_files import op10_token_files
from tidemark.llm.url_filter import OP3_SQL, op3_url_filter

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_packing": op6_packing,
    "op7_line_quality": op7_line_quality,
    "op8_simhash": op8_simhash,
    "op9_mixing": op9_mixing,
    "op10_token_files": op10_token_files,
    "op11_period_runs": op11_period_runs,
    "op12_licenses": op12_licenses,
    "op13_infill": op13_infill,
}

ORACLES = {
    "op2_exact_dedup": OP2_SQL,
    "op3_url_filter": OP3_SQL,
    "op9_mixing": OP9_SQL,
    "op12_licenses": OP12_SQL,
    "op13_infill": OP13_SQL,
}
