"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from urbanlens.llm import bpe, decontam, dialogue, fingerprint, jaccard, langid, negatives, pii, simhash, substring, tokenfile, toxicity, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_rules": urls.query,
    "op2_toxicity": toxicity.query,
    "op3_decontamination": decontam.query,
    "op4_substring_dedup": substring.query,
    "op5_pii": pii.query,
    "op6_token_file": tokenfile.query,
    "op7_language_id": langid.query,
    "op8_bpe": bpe.query,
    "op9_fingerprints": fingerprint.query,
    "op10_simhash": simhash.query,
    "op11_conversations": dialogue.query,
    "op12_hard_negatives": negatives.query,
    "op13_jaccard_join": jaccard.query,
}
ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": decontam.ORACLE,
    "op11_conversations": dialogue.ORACLE,
    "op12_hard_negatives": negatives.ORACLE,
    "op13_jaccard_join": jaccard.ORACLE,
}
