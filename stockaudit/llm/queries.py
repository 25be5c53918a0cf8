"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stockaudit.llm import (
    alignment, bpe, decontaminate, exact_dedup, importance, language, secrets, simhash, sketch, suffix_dedup, token_files, toxicity,
    url_rules,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_secret_scan": secrets.op3_secret_scan,
    "op4_simhash_duplicates": simhash.op4_simhash_duplicates,
    "op5_language_id": language.op5_language_id,
    "op6_token_files": token_files.op6_token_files,
    "op7_bpe_round_trip": bpe.op7_bpe_round_trip,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_url_rules": url_rules.op9_url_rules,
    "op10_sketch": sketch.op10_sketch,
    "op11_importance_resampling": importance.op11_importance_resampling,
    "op12_exact_dedup": exact_dedup.op12_exact_dedup,
    "op13_tokenizer_alignment": alignment.op13_tokenizer_alignment,
}
SQL: dict[str, str] = {
    "op1_decontamination": decontaminate.SQL,
    "op2_suffix_dedup": suffix_dedup.SQL,
    "op9_url_rules": url_rules.SQL,
    "op11_importance_resampling": importance.SQL,
    "op12_exact_dedup": exact_dedup.SQL,
}
