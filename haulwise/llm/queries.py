"""The registered queries of the operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwise.llm import attention_lm, bitslice, bpe, decontam, langid, merkle, neighbours, quality, secret_scan, sharding, simhash, spelling, url_filter
from haulwise.llm.common import in_hash_class
from haulwise.sources.tables import read_input

# The rule list of the URL filter
RULES = (url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"),
         url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/"))
# Host labels that are listed where no rule fits
LISTED_LABELS = ("ads-track", "spam-farm", "casino-win", "adult-x", "cheap-pills", "free-bets")
RANKS = "byte_bpe_50k.tiktoken"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_input(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_input(spark, sf_dir, "documents")
    held_out = in_hash_class("doc_id", 3, 1)
    model = langid.fit(docs, ~held_out)
    return langid.predict(docs, *model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(read_input(spark, sf_dir, "documents"), shards=40, overhead=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read_input(spark, sf_dir, "pages"), RULES, LISTED_LABELS)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(read_input(spark, sf_dir, "documents"),
                                     public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return secret_scan.digest_spans(found)


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(read_input(spark, sf_dir, "documents"), read_input(spark, sf_dir, "benchmark"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(read_input(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0, k=5, scale=256)


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_documents(read_input(spark, sf_dir, "documents"),
                                        public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(read_input(spark, sf_dir, "documents"), public_tokenizers.path(RANKS),
                                  public_tokenizers.PATTERN, decoded=True))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.importance_resample(read_input(spark, sf_dir, "documents"), read_input(spark, sf_dir, "labels"),
                                       stratum="lang")


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(read_input(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0, k=5)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_input(spark, sf_dir, "documents"), modulus=97, least_letters=5, least_count=3, ratio=2)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(read_input(spark, sf_dir, "documents"), in_hash_class("doc_id", 3, 0))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash, op2_langid, op3_sharding, op4_url_filter, op5_secrets, op6_decontam,
                                    op7_topk, op8_lm_score, op9_bpe, op10_quality, op11_neighbours, op12_spelling, op13_merkle)}
