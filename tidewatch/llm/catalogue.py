"""Registered queries of this subpackage, and the SQL that checks those SQL can express."""

from __future__ import annotations

from tidewatch.llm import (
    embeddings, exact, jaccard, language, mixing, packing, periods, quality, subwords, suffix, surrogates, toxicity, whitening,
)

QUERIES = {
    "op1_pivot_permutation": embeddings.op1_pivot_permutation,
    "op2_suffix_array": suffix.op2_suffix_array,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_exact_dedup": exact.op4_exact_dedup,
    "op5_quality": quality.op5_quality,
    "op6_language_id": language.op6_language_id,
    "op7_surrogates": surrogates.op7_surrogates,
    "op8_packing": packing.op8_packing,
    "op9_mixing": mixing.op9_mixing,
    "op10_ngram_jaccard": jaccard.op10_ngram_jaccard,
    "op11_periodic_runs": periods.op11_periodic_runs,
    "op12_subwords": subwords.op12_subwords,
    "op13_whitening": whitening.op13_whitening,
}
ORACLES = {"op4_exact_dedup": exact.ORACLE, "op10_ngram_jaccard": jaccard.ORACLE}
