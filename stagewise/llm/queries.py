"""Queries of the operators, for ``__spark_entry__``."""

from __future__ import annotations

from .codes import op13_walsh_vector_codes
from .decontamination import op5_spaced_seed_decontamination
from .jaccard import op8_ngram_jaccard_join
from .minhash import op11_minhash_near_dedup
from .negatives import op12_residue_hard_negatives
from .oracles import ORACLES  # noqa: F401
from .packing import op10_best_fit_packing
from .quality_classifier import op9_co_trained_quality
from .quality_rules import op4_risk_controlled_rules
from .sharding import op1_sharding
from .substrings import op3_chunk_substring_dedup
from .suffixes import op7_sparse_suffix_dedup
from .token_files import op6_token_files
from .toxicity import op2_kneser_ney_toxicity

QUERIES = {f.__name__: f for f in (
    op1_sharding, op2_kneser_ney_toxicity, op3_chunk_substring_dedup, op4_risk_controlled_rules,
    op5_spaced_seed_decontamination, op6_token_files, op7_sparse_suffix_dedup, op8_ngram_jaccard_join,
    op9_co_trained_quality, op10_best_fit_packing, op11_minhash_near_dedup, op12_residue_hard_negatives,
    op13_walsh_vector_codes)}
