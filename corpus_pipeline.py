"""Filter, de-duplicate, decontaminate and encode a corpus: four training-data operators in a row.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but the last
return the columns of their input, whatever they are; ids may be NULL or repeated.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import bpe, decontaminate, quality, simhash
from tickloom.llm.common import stored, table
from tickloom.llm.registry import BPE_RANKS


def keep_good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose quality score reaches the threshold. The model is fitted on labelled rows of ``docs``."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints: the one with the smallest id, if any has one."""
    return simhash.deduplicate(docs)


def drop_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any window of a test item."""
    return decontaminate.remove_rows(docs, table(spark, sf_dir, "benchmark"))


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number and digest of the token ids, digest of the decoded text, and the ids."""
    coded = bpe.round_trip(docs, BPE_RANKS, public_tokenizers.PATTERN)
    return bpe.digests(coded, "ids")


STAGES = [
    ("quality", keep_good_text),
    ("simhash", drop_near_copies),
    ("decontaminate", drop_benchmark_text),
    ("byte_bpe", encode_text),
]

# A trained classifier and encoding by ranks cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
