"""Registered queries of the training-data operators, and their oracle SQL."""

from __future__ import annotations

from lakeproof.llm import decontaminate, repeats, topk
from lakeproof.llm.manifest import op12_merkle_manifest
from lakeproof.llm.neardup import op10_minhash_near_dedup
from lakeproof.llm.packing import op5_best_fit_packing
from lakeproof.llm.privacy import op9_information_sanitisation
from lakeproof.llm.quality import op2_co_training_quality
from lakeproof.llm.sharding import op4_feistel_sharding
from lakeproof.llm.suffix import op1_suffix_dedup
from lakeproof.llm.tokenfiles import op7_token_files, op8_separator_scan
from lakeproof.llm.whitening import op11_incremental_whitening

QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_co_training_quality, topk.op3_bit_sliced_top_k, op4_feistel_sharding, op5_best_fit_packing,
    decontaminate.op6_positional_decontamination, op7_token_files, op8_separator_scan,
    op9_information_sanitisation, op10_minhash_near_dedup, op11_incremental_whitening,
    op12_merkle_manifest, repeats.op13_doubling_substring_dedup)}

ORACLES: dict[str, str] = {"op3_bit_sliced_top_k": topk.ORACLE,
                           "op6_positional_decontamination": decontaminate.ORACLE,
                           "op13_doubling_substring_dedup": repeats.ORACLE}
