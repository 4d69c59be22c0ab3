"""The queries of this folder, by name, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline

from . import alignment, bpe, decontaminate, jaccard, language, periodic, pieces, quality, simhash, suffixes, toxicity, url_rules, windows

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_suffix_array_dedup": suffixes.op2_suffix_array_dedup,
    "op3_substring_dedup": windows.op3_substring_dedup,
    "op4_url_filters": url_rules.op4_url_filters,
    "op5_quality_classifier": quality.op5_quality_classifier,
    "op6_document_fingerprints": simhash.op6_document_fingerprints,
    "op7_language_id": language.op7_language_id,
    "op8_ngram_jaccard_join": jaccard.op8_ngram_jaccard_join,
    "op9_bpe_coding": bpe.op9_bpe_coding,
    "op10_benchmark_decontamination": decontaminate.op10_benchmark_decontamination,
    "op11_cross_tokenizer_alignment": alignment.op11_cross_tokenizer_alignment,
    "op12_sentencepiece_coding": pieces.op12_sentencepiece_coding,
    "op13_periodic_run_detection": periodic.op13_periodic_run_detection,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {
    "op4_url_filters": url_rules.OP4_SQL,
}
