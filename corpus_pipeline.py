"""A corpus through five operators: quality, near-duplicates, personal data, mix of sources, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again
for the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenderloom.llm import mixing, packing, pii, quality, simhash, similar
from tenderloom.llm.common import table
from tenderloom.llm.queries import WORD_VOCABULARY, vocabulary
from tenderloom.session import stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents linked by SimHash as in ``op6_simhash`` or sharing a MinHash bucket, verified by exact similarity."""
    return similar.keep_first(docs, linked=simhash.components)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, vocabulary(WORD_VOCABULARY))


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", one_of_near_duplicates),
    ("personal_data", without_personal_data),
    ("mix", mixed_sources),
    ("packing", packed_sequences),
]

#: Fingerprints, models and tokenizers are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
