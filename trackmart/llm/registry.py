"""The operators' queries and their SQL equivalents."""

import corpus_pipeline
from trackmart.llm import (
    chunking,
    exact_dedup,
    jaccard_join,
    language,
    line_dedup,
    minhash_dedup,
    mixing,
    negatives,
    packing,
    pii,
    prefix_trie,
    quality,
    toxicity,
)

QUERIES = {
    f.__name__: f
    for f in (
        jaccard_join.op1_ngram_jaccard_join,
        exact_dedup.op2_exact_dedup,
        packing.op3_best_fit_packing,
        quality.op4_quality_grade,
        toxicity.op5_toxicity,
        language.op6_language_id,
        chunking.op7_content_fingerprints,
        mixing.op8_curriculum_mix,
        pii.op9_pii,
        line_dedup.op10_line_dedup,
        minhash_dedup.op11_minhash_dedup,
        prefix_trie.op12_prefix_trie,
        negatives.op13_hard_negatives,
    )
} | {"pipeline": corpus_pipeline.run}

STATEMENTS = {
    "op1_ngram_jaccard_join": minhash_dedup.class_sql(4, 85, ""),
    "op2_exact_dedup": exact_dedup.SQL,
    "op8_curriculum_mix": mixing.SQL,
    "op10_line_dedup": line_dedup.SQL,
    "op11_minhash_dedup": minhash_dedup.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
    "op13_hard_negatives": negatives.SQL,
}
