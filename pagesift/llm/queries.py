"""The operators' queries over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagesift.llm import (
    bloomlm, decontam, langid, licenses, packing, piececodec, prefixtrie, quality, sharding, sigtree, spelling, suffixdedup, urlfilter,
)
from pagesift.llm.sql import ORACLE  # noqa: F401
from pagesift.llm.tasks import table

# 3 regions of 2 racks of 4 shards.
TREE = sharding.ShardTree.even(3, 2, 4)


def word_bpe() -> str:
    """The packing vocabulary, a public file outside the repository."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def piece_bpe() -> str:
    """The SentencePiece model, a public file outside the repository."""
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op1_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"), TREE)


def op2_suffix_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.dedup(table(spark, sf_dir, "documents"))


def op3_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), word_bpe()))


def op4_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloomlm.score(table(spark, sf_dir, "documents"))


def op5_script_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.judge(table(spark, sf_dir, "documents"))


def op6_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.judge(table(spark, sf_dir, "documents"))


def op7_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_host_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op9_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sigtree.judge(table(spark, sf_dir, "documents"))


def op10_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op11_rollup_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.nodes(table(spark, sf_dir, "conversations"))


def op12_bloom_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(table(spark, sf_dir, "documents"))


def op13_offset_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piececodec.digest(table(spark, sf_dir, "documents"), piececodec.read_model(piece_bpe()))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_shard_tree": op1_shard_tree,
    "op2_suffix_shards": op2_suffix_shards,
    "op3_harmonic_packing": op3_harmonic_packing,
    "op4_bloom_lm": op4_bloom_lm,
    "op5_script_viterbi": op5_script_viterbi,
    "op6_license_diagonals": op6_license_diagonals,
    "op7_suffix_automaton": op7_suffix_automaton,
    "op8_host_words": op8_host_words,
    "op9_signature_trees": op9_signature_trees,
    "op10_distribution_divergence": op10_distribution_divergence,
    "op11_rollup_trie": op11_rollup_trie,
    "op12_bloom_spelling": op12_bloom_spelling,
    "op13_offset_pieces": op13_offset_pieces,
}
