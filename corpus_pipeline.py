"""Corpus pipeline: from documents to packed training sequences.

Quality classifier, exact dedup, SimHash near-dedup, substring dedup, packing. Each stage gets all
that the one before kept; all but the last return the columns of the documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import edited_copies, exact_dedup, packing, quality, substrings
from tillstream.llm.common import read, stored, text_key


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.accepted(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one document stays."""
    return _only(docs, exact_dedup.deduplicate(docs).where("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at Jaccard 0.8 the smallest doc_id stays."""
    found = edited_copies.components(docs)
    return _only(docs, found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also stand in a document with a smaller doc_id are taken out."""
    return substrings.cleaned(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of binary length with their token ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", drop_low_quality),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("substring dedup", drop_repeated_passages),
    ("packing", pack_sequences),
]

# Classifier, SimHash and tokenizer are beyond SQL.
ORACLE_SQL = None


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The documents whose doc_id and text key are in `kept`."""
    same = (F.col("docs.doc_id").cast("bigint").eqNullSafe(F.col("kept.doc_id"))
            & (text_key(F.col("docs.text")) == F.col("kept.text_key")))
    kept = kept.select("doc_id", "text_key").distinct()
    return docs.alias("docs").join(kept.alias("kept"), same, "left_semi")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stage's result written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
