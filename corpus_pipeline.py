"""Corpus pipeline: toxicity, near duplicates, repeated strings, personal data, packing.

Each stage works on all that the one before it kept; all but the last return
the columns of documents. ``run`` writes every stage's rows as Parquet in the
shared folder and reads them back as the next one's documents.

1. toxicity: texts scored 0.7 or more are rejected.
2. ngram_jaccard: of each component of near duplicates (five-word shingles,
   likeness 0.8 or more) the first document stays.
3. suffix_dedup: bytes covered by a 100-byte string that starts earlier go.
4. pii: every span becomes its kind in brackets.
5. packing: the rest as pieces in sequences of at most 1024 tokens.

Rows: a null text passes every stage as a row without words (it is no near
copy of anything, loses nothing and is packed as its end id); null and repeated
ids are rows of their own; columns beside those of documents travel with their
rows, whatever their names; an empty table gives an empty result.

Toxicity scores, packings and the components of near duplicates have no SQL;
tests/llm/test_pipeline.py compares the stages with brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabrail.llm.common import release, stage, table
from tabrail.llm.jaccard import jaccard_stage
from tabrail.llm.packing import packing_stage
from tabrail.llm.pii import pii_stage
from tabrail.llm.suffix_dedup import dedup_stage
from tabrail.llm.toxicity import toxicity_stage

STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard", jaccard_stage),
    ("suffix_dedup", dedup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; returns the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            release(before)
        before = docs
    return docs
