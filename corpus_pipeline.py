"""Corpus pipeline: every stage reads what its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from urbanlens.llm import bpe, decontam, langid, pii, simhash
from urbanlens.llm.common import materialize, read
from urbanlens.session import ship_package

STAGES = [
    ("language id", langid.reject_unidentified),
    ("simhash near-dedup", simhash.keep_one_of_each),
    ("benchmark decontamination", decontam.drop_contaminated),
    ("personal data", pii.mask_personal_data),
    ("byte-level bpe", bpe.encode_documents),
]

# Fitted models, fingerprints and merges have no SQL form; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply ``STAGES`` to ``documents``."""
    ship_package(spark)
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
