"""A cleaning pipeline over ``documents``: quality, near-duplicates, benchmark
leaks, secrets, and byte-level BPE of what is left.

Every stage is ``function(spark, docs, sf_dir) -> DataFrame``; :func:`run`
writes what a stage returns as a table, which the next one reads. Stages that
drop rows number them first, in a stored copy, and find them again by that
number: every row is judged for itself, whether its doc_id is null, repeated
or its own.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulwise.llm import bpe, decontam, quality, secret_scan, simhash
from haulwise.llm.queries import RANKS
from haulwise.session import cut_lineage, scratch_path
from haulwise.sources.tables import read_input


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """A stored copy of ``docs`` with a number for each row, in a column whose
    name none of theirs has (case does not tell names apart)."""
    key = "_row_key"
    while key in {c.lower() for c in docs.columns}:
        key += "_"
    return cut_lineage(docs.withColumn(key, F.monotonically_increasing_id()), "pipeline-rows"), key


def _by_key(keyed: DataFrame, key: str) -> DataFrame:
    """Row numbers in place of the doc_ids."""
    return keyed.select(F.col(key).alias("doc_id"), "text")


def _only(keyed: DataFrame, key: str, keys: DataFrame, how: str) -> DataFrame:
    """The rows whose number is (left_semi) or is not (left_anti) in ``keys``."""
    return keyed.join(keys, key, how).drop(key)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the classifier rejects by the cuts that labels gave it (the
    draw of the resampling plays no part). Without usable labels every document
    stays."""
    keyed, key = _keyed(docs)
    judged = quality.importance_resample(keyed, read_input(spark, sf_dir, "labels"), stratum="lang", row_key=key)
    return _only(keyed, key, judged.where("not keep").select(key), "left_anti").select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near-duplicates one row, of the least doc_id; a
    null one comes last."""
    keyed, key = _keyed(docs)
    groups = simhash.near_duplicates(_by_key(keyed, key), shingle=3, max_bits=2)
    groups = groups.select(F.col("doc_id").alias(key), "component_id").join(keyed.select(key, "doc_id"), key)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.col(key).alias("at"))).alias("first")
    kept = groups.groupBy("component_id").agg(first).select(F.col("first.at").alias(key))
    return _only(keyed, key, kept, "left_semi").select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a copy, exact or edited, of a benchmark item."""
    keyed, key = _keyed(docs)
    leaks = decontam.find_leaks(_by_key(keyed, key), read_input(spark, sf_dir, "benchmark"))
    return _only(keyed, key, leaks.select(F.col("doc_id").alias(key)), "left_anti").select(docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts by ``[secret]``; the documents stay."""
    return secret_scan.scan_secrets(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, redact="[secret]")


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    return bpe.digests(bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, decoded=True))


STAGES = [("quality classifier", quality_stage), ("simhash near-dedup", near_duplicate_stage),
          ("benchmark decontamination", decontamination_stage), ("secret scans", secret_stage),
          ("byte-level bpe", bpe_stage)]

# SQL expresses none of shingle hashes, trained weights, alignment and merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_input(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = os.path.join(scratch_path(spark, "pipeline"), f"stage{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
