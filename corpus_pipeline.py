"""From raw documents to packed sequences: five stages, each on all that the
one before it kept.

1. language ID: documents without a language (without a letter) go, mixed ones stay;
2. n-gram Jaccard join: of documents that share four fifths of their five-word
   shingles one stays, the one with the smallest id;
3. suffix-array dedup: passages that an earlier document has are cut;
4. benchmark decontamination: passages of benchmark items are cut, documents
   that are mostly such passages go;
5. packing into sequences of 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagesift.llm import decontam, langid, packing, sigtree, suffixdedup
from pagesift.llm.queries import word_bpe
from pagesift.llm.tasks import staged, table

SHINGLE_WORDS = 5
MIN_PERCENT = 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sigtree.keep_one(docs, SHINGLE_WORDS, MIN_PERCENT)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixdedup.remove(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, word_bpe()))


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

# SQL has neither the language model nor the tokenizer; tests compare the stages
# with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
