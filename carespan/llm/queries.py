"""Registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carespan.llm import (
    collocations,
    decontaminate,
    mixture,
    ngram_join,
    personal_data,
    periodic_runs,
    piece_counts,
    quality_rules,
    rule_ensemble,
    shard_shuffle,
    suffix_dedup,
    token_files,
    url_lists,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": ngram_join.op1_ngram_jaccard_join,
    "op2_token_files": token_files.op2_token_files,
    "op3_suffix_array_quality": quality_rules.op3_suffix_array_quality,
    "op4_rule_ensemble_quality": rule_ensemble.op4_rule_ensemble_quality,
    "op5_temporal_url_lists": url_lists.op5_temporal_url_lists,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_longest_match_counts": piece_counts.op7_longest_match_counts,
    "op8_string_tiling_leaks": decontaminate.op8_string_tiling_leaks,
    "op9_two_pass_shards": shard_shuffle.op9_two_pass_shards,
    "op10_source_mixture": mixture.op10_source_mixture,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_phrase_collocations": collocations.op12_phrase_collocations,
    "op13_personal_data": personal_data.op13_personal_data,
}

ORACLES: dict[str, str] = {
    "op5_temporal_url_lists": url_lists.ORACLE,
    "op10_source_mixture": mixture.ORACLE,
    "op12_phrase_collocations": collocations.ORACLE,
}
