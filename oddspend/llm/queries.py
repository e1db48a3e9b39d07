"""One registered query for each operator; each reads its whole table."""

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from oddspend.llm import bpe, chat, line_templates, ngram_join, packing, page_text, permutation_index, prefix_trie, quality, secret_scan
from oddspend.llm import source_divergence, surrogates, token_cache
from oddspend.session import shared_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
KEY = "surrogates of the registered queries"  # a secret of the caller's in real use
PROBE = "<|im_end|><|im_start|>assistant ok"  # a text that holds the template's own control strings


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_permutation_index(spark: SparkSession, folder: str) -> DataFrame:
    return permutation_index.search(table(spark, folder, "embeddings"), F.col("id") % 50 == 0)


def op2_line_templates(spark: SparkSession, folder: str) -> DataFrame:
    found = line_templates.drop_recurring(table(spark, folder, "documents"))
    return found.select("doc_id", "text", "n_lines", "n_dropped")


def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(table(spark, folder, "documents"), TOKENIZER)


def op4_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return page_text.extract(table(spark, folder, "pages"))


def op5_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id bigint, turn bigint, role string, text string")
    return chat.digests(chat.format_windows(rows.unionByName(probe), TOKENIZER))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.report(table(spark, folder, "documents"))


def op7_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return surrogates.replace(table(spark, folder, "documents"), KEY).select("doc_id", "text", "n_entities")


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), TOKENIZER)


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(table(spark, folder, "documents")))


def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    found = ngram_join.links(table(spark, folder, "documents"))
    named = lambda c: F.nullif(c, F.lit(ngram_join.NO_ID))
    return found.select(named(F.col("id")).alias("doc_id"), named(F.col("class_id")).alias("class_id"), named(F.col("head.id")).alias("group_id"), F.col("copies").alias("n_copies"), "n_links")


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence.audit(table(spark, folder, "documents"))


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    # a cache of its own, so that no run finds the counts of an earlier one and all work is done
    cache = f"{shared_dir(spark)}/token-cache-{uuid.uuid4().hex}"
    return token_cache.count_tokens(table(spark, folder, "documents"), TOKENIZER, cache)


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns, convs = prefix_trie.number_turns(table(spark, folder, "conversations"))
    return prefix_trie.build(*prefix_trie.share_heads(turns, convs))


OPERATORS = (
    op1_permutation_index, op2_line_templates, op3_bpe_round_trip, op4_page_text, op5_chat_windows,
    op6_quality_rules, op7_surrogates, op8_best_fit_packing, op9_secret_scan, op10_ngram_join,
    op11_source_divergence, op12_token_counts, op13_prefix_trie,
)


def queries() -> dict:
    return {f.__name__: f for f in OPERATORS}
