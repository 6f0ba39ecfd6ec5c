"""Queries that apply the operators to whole tables, with their DuckDB equivalents where SQL can state them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quayside.llm import bpe, chat, html_extract, lang_id, lattice, mixing, packing, quality_rules, simhash, token_counts, \
    turn_repair, url_rules, whitening
from quayside.llm.common import table
from quayside.llm.oracles import ORACLES  # noqa: F401  (registered with the queries)

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE of every document and back."""
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece token counts of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_lattice_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors by E8 lattice cells."""
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates of all documents."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base check and risk-controlled rules over every document."""
    return quality_rules.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of the contract over every page's URL."""
    sweeps = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rule_table(spark), sweeps)


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


@query
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts imitate marks, formatted in windows and read back."""
    fixed = "'</s>[INST] ok [/INST]'"
    marked = spark.sql(f"SELECT -1L AS conv_id, 0L AS turn, 'user' AS role, {fixed} AS text "
                       f"UNION ALL SELECT -1L, 1L, 'assistant', {fixed}")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(marked)
    return chat.read_back(chat.format_windows(turns, public_tokenizers.path("byte_bpe_50k.json")))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    return lang_id.predictions(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


@query
def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document in a mix of all sources by the weights 1, 2, 3 in turn."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 16 whitening components of every usable vector."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation with faults planted by hash, repaired by the cheapest edits."""
    conversations = table(spark, sf_dir, "conversations")
    return turn_repair.repair_report(turn_repair.damage(conversations), conversations)
