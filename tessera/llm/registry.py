"""The corpus queries, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from tessera.llm import decontaminate, langid, licenses, mixing, ngramjoin, oracles, quality, rollup, suffixdedup, toxicity, urlgraph


def queries():
    return {
        "op1_quality_rules": quality.query,
        "op2_suffix_dedup": suffixdedup.query,
        "op3_language_id": langid.query,
        "op4_decontamination": decontaminate.query,
        "op5_url_filters": urlgraph.query,
        "op6_toxicity": toxicity.query,
        "op7_ngram_jaccard_join": ngramjoin.query,
        "op8_token_counts": rollup.query,
        "op9_source_mixing": mixing.query,
        "op10_license_scan": licenses.query,
        "token_counts_words": rollup.words_query,
        "mixing_targets": mixing.targets_query,
    }


def oracle_sql():
    return {
        "op1_quality_rules": oracles.QUALITY,
        "op2_suffix_dedup": oracles.SUFFIX,
        "op5_url_filters": oracles.URLS,
        "op7_ngram_jaccard_join": oracles.JOIN,
        "op10_license_scan": oracles.LICENSES,
        "token_counts_words": rollup.WORDS_SQL,
        "mixing_targets": oracles.TARGETS,
    }
