"""Queries of this package and their DuckDB twins."""

from __future__ import annotations

import corpus_pipeline
from arrivals_star.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from arrivals_star.llm.fingerprints import op13_fingerprints
from arrivals_star.llm.merkle_manifest import op11_merkle_manifest, oracle_sql as op11_sql
from arrivals_star.llm.minhash_dedup import OP5_SQL, op5_minhash_dedup
from arrivals_star.llm.packing import op6_packing
from arrivals_star.llm.quality import op1_quality
from arrivals_star.llm.secrets import op8_secret_scan, oracle_sql as op8_sql
from arrivals_star.llm.sentence_pieces import op4_sentencepiece
from arrivals_star.llm.substring_dedup import OP3_SQL, op3_substring_dedup
from arrivals_star.llm.suffix_dedup import OP2_SQL, op2_suffix_dedup
from arrivals_star.llm.url_filter import op10_url_filter
from arrivals_star.llm.vector_codes import op12_vector_codes, oracle_sql as op12_sql
from arrivals_star.llm.vector_topk import OP7_SQL, op7_exact_topk

QUERIES = {
    "op1_quality": op1_quality,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_packing": op6_packing,
    "op7_exact_topk": op7_exact_topk,
    "op8_secret_scan": op8_secret_scan,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_vector_codes": op12_vector_codes,
    "op13_fingerprints": op13_fingerprints,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op2_suffix_dedup": OP2_SQL,
    "op3_substring_dedup": OP3_SQL,
    "op5_minhash_dedup": OP5_SQL,
    "op7_exact_topk": OP7_SQL,
    "op8_secret_scan": op8_sql(),
    "op9_exact_dedup": OP9_SQL,
    "op11_merkle_manifest": op11_sql(),
    "op12_vector_codes": op12_sql(),
}
