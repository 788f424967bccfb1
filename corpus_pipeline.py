"""A corpus pipeline of five stages over the table ``documents``.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; all but the last return the
columns of ``documents``.  ``run`` writes each stage's rows to the shared folder and reads
them again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermatch.llm import bpe, common, mixing, pii, quality, simhash

#: Scores come from a fit, mixing from a hashed draw and ids from a vocabulary file: no SQL.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, common.read_table(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: texts of which 0.8 of all five-word shingles are shared."""
    return simhash.drop_near_duplicates(docs, similarity=0.8, shingle=5)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    return pii.mask(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with all their columns, and their token ids as ``ids`` (with "_" before it if documents have such a column)."""
    return bpe.tokens(docs, column=common.free_name("ids", docs.columns))


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", without_near_copies),
    ("PII", without_personal_data),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        before = common.mark()
        docs = common.store(stage(spark, docs, sf_dir), f"stage{i}")
        common.release(spark, before, keep=(docs,))
    return docs
