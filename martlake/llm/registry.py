"""Registered queries of the operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martlake.llm import ann, bpe, hard_negatives, lattice_lm, line_dedup, minhash_join, mixing, ngram_join, outliers, quality, suffix_dedup, \
    token_files, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": quality.op1_quality_classifier,
    "op2_lattice_lm": lattice_lm.op2_lattice_lm,
    "op3_quality_rules": outliers.op3_quality_rules,
    "op4_mixing": mixing.op4_mixing,
    "op5_byte_bpe": bpe.op5_byte_bpe,
    "op6_ngram_jaccard": ngram_join.op6_ngram_jaccard,
    "op7_token_files": token_files.op7_token_files,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_ann": ann.op10_ann,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_minhash": minhash_join.op12_minhash,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op4_mixing": mixing.ORACLE_SQL,
    "op6_ngram_jaccard": ngram_join.ORACLE_SQL,
    "op8_line_dedup": line_dedup.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
    "op12_minhash": minhash_join.ORACLE_SQL,
}
